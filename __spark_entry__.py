"""Registered queries: one for each operator, over whole tables, with SQL to compare against."""

from __future__ import annotations

import importlib
import importlib.util
import sys
import uuid
from collections.abc import Callable
from functools import reduce
from pathlib import Path
from types import ModuleType

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession, Window, functions as F  # noqa: E402

import oracles  # noqa: E402
from twinsieve.functions.minhash import signature_value  # noqa: E402
from twinsieve.functions.text import shingle_hashes, shingles, token_count  # noqa: E402
from twinsieve.operators.audits import (  # noqa: E402
    foreign_key_audit,
    key_report,
    primary_key_audit,
)
from twinsieve.operators.banding import bands, buckets, star_edges  # noqa: E402
from twinsieve.operators.checks import (  # noqa: E402
    failed_checks,
    is_at_least,
    is_at_most,
    is_complete,
    is_non_negative,
    is_unique,
    run_checks,
)
from twinsieve.operators.components import (  # noqa: E402
    connected_components,
    large_star,
    small_star,
    symmetric_difference,
)
from twinsieve.operators.gates import (  # noqa: E402
    row_count_gate,
    schema_gate,
    structural_schema_gate,
)
from twinsieve.operators.profile import (  # noqa: E402
    ProfileSpec,
    metric,
    profile,
)
from twinsieve.operators.profile_state import (  # noqa: E402
    merged,
    profile_of,
    profile_state,
)
from twinsieve.operators.removal import keep_one, removed  # noqa: E402
from twinsieve.operators.skew import with_group_min  # noqa: E402
from twinsieve.operators.uniqueness import uniqueness_row  # noqa: E402
from twinsieve.plans.bucketed import BucketedTables, bucketed_view, write_bucketed  # noqa: E402
from twinsieve.plans.incremental import incremental_duplicates  # noqa: E402
from twinsieve.plans.near_dedup import (  # noqa: E402
    DedupParams,
    Duplicates,
    find_duplicates,
    near_dedup,
    near_dedup_files,
    run_job,
    run_job_on_files,
    stage_signatures,
)
from twinsieve.plans.snowflake import (  # noqa: E402
    file_facts,
    language_dimension,
    load_snowflake,
    repository_dimension,
    wide_view,
)
from twinsieve.sources.folders import Folders  # noqa: E402
from twinsieve.sources.layout import clustered, range_bucket, write_layout  # noqa: E402
from twinsieve.sources.publication import Published  # noqa: E402
from twinsieve.sources.tables import (  # noqa: E402
    attach_row_id,
    fill_cluster,
    read_table,
    read_with_row_id,
    write_table,
)
from twinsieve.sources.workspace import Workspace  # noqa: E402

PARAMS = DedupParams()
SIZES = ProfileSpec()
# With these lines few parts share an order, so there are many components.
LARGE_LINE = 48
DOCUMENTS_PROFILE = ProfileSpec(("doc_id", "text"), ("n_chars",), ("doc_id",))
LINES_PROFILE = ProfileSpec(
    complete=("l_orderkey", "l_returnflag", "no_such_column"),
    numeric=("l_quantity", "l_extendedprice"),
    unique_key=("l_orderkey", "l_linenumber"),
)


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf}/{name}.parquet", "parquet")


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    return _table(spark, sf, "documents")


def _texts(spark: SparkSession, sf: str) -> DataFrame:
    return fill_cluster(_documents(spark, sf).select("doc_id", "text"), "doc_id")


# Sources, sinks and layout


def table_scan(spark: SparkSession, sf: str) -> DataFrame:
    return _documents(spark, sf)


def row_id_attach(spark: SparkSession, sf: str) -> DataFrame:
    rows = attach_row_id(_table(spark, sf, "lineitem"), Workspace(spark))
    return rows.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct("row_id").alias("n_ids"),
        F.count_if(F.col("row_id").isNull()).alias("n_null"),
    )


def row_id_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Ids in the order of the key, whether the table is one file in that order or not."""
    path, columns = f"{sf}/documents.parquet", ["doc_id", "n_chars"]
    return read_with_row_id(spark, path, Workspace(spark), columns=columns, order_by=["doc_id"])


def staged_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Written under a run's name, and read by that name from another workspace."""
    first = Workspace(spark, run=f"roundtrip-{uuid.uuid4().hex}")
    first.stage_once("documents", sf, lambda: _documents(spark, sf))
    second = Workspace(spark, run=first.run)
    return second.stage_once("documents", sf, _not_again)


def staged_versions(spark: SparkSession, sf: str) -> DataFrame:
    """What readers of three versions see, and of a write that never became one."""
    place = Published(spark, Workspace(spark).path("published"))
    rows = _documents(spark, sf)
    place.replace(rows.where("lang = 'en'"))
    place.append(rows.where("lang <> 'en'"))
    place.write(rows)
    place.replace(rows.where("n_chars > 1000"))
    counts = [
        place.read(number)
        .groupBy(F.lit(number).cast("bigint").alias("version"), "lang")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("n_chars"))
        for number in place.numbers()
    ]
    return reduce(DataFrame.unionByName, counts)


def _not_again() -> DataFrame:
    raise AssertionError("a finished step is made again")


def range_bucket_layout(spark: SparkSession, sf: str) -> DataFrame:
    path = Workspace(spark).path("documents_by_size")
    bucket = range_bucket("n_chars", 0, 10_000, 1_000)
    write_layout(_documents(spark, sf), path, bucket, ["source"], ["doc_id"])
    written = spark.read.parquet(path)
    return written.groupBy(F.col("bucket").cast("bigint").alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"), F.min("n_chars").alias("low"), F.max("n_chars").alias("high")
    )


def clustered_layout(spark: SparkSession, sf: str) -> DataFrame:
    """Files in ranges of the clustering column: none starts before another one's end."""
    orders = _table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    written = Workspace(spark).stage(clustered(orders, ["o_custkey"], ["o_orderkey"]), "orders")
    path = F.col("_metadata.file_path").alias("path")
    files = written.select("*", path).groupBy("path").agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.struct("o_custkey", "o_orderkey")).alias("low"),
        F.max(F.struct("o_custkey", "o_orderkey")).alias("high"),
    )
    before = F.max("high").over(
        Window.orderBy("low").rowsBetween(Window.unboundedPreceding, -1)
    )
    return files.withColumn("overlaps", F.coalesce(F.col("low") <= before, F.lit(False))).agg(
        F.sum("n").alias("n"),
        F.count_if("overlaps").alias("overlaps"),
        F.min("low.o_custkey").alias("lowest"),
        F.max("high.o_custkey").alias("highest"),
    )


# Text, hashes and bands


def token_counts(spark: SparkSession, sf: str) -> DataFrame:
    count = token_count("text").cast("bigint").alias("n_tokens")
    return _texts(spark, sf).select("doc_id", count)


def ngrams(spark: SparkSession, sf: str) -> DataFrame:
    grams = F.explode_outer(shingles("text")).alias("ngram")
    return _texts(spark, sf).select("doc_id", grams).where("ngram IS NOT NULL")


def shingle_hash_rows(spark: SparkSession, sf: str) -> DataFrame:
    hashes = F.explode_outer(shingle_hashes("text")).alias("hash")
    return _texts(spark, sf).select("doc_id", hashes).where("hash IS NOT NULL")


def _signed(spark: SparkSession, sf: str, workspace: Workspace) -> DataFrame:
    return stage_signatures(_documents(spark, sf), "doc_id", "text", PARAMS, workspace)


def _banded(spark: SparkSession, sf: str, workspace: Workspace) -> DataFrame:
    return bands(_signed(spark, sf, workspace), PARAMS.banding())


def minhash_signatures(spark: SparkSession, sf: str) -> DataFrame:
    places = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(PARAMS.banding().used - 1)))
    rows = _signed(spark, sf, Workspace(spark)).select("id", "signature", places.alias("k"))
    value = signature_value(F.col("signature"), F.col("k").cast("int"))
    return rows.select(F.col("id").alias("doc_id"), "k", value.alias("v"))


def lsh_bands(spark: SparkSession, sf: str) -> DataFrame:
    return _banded(spark, sf, Workspace(spark)).select(
        F.col("id").alias("doc_id"),
        F.col("band").cast("bigint").alias("band"),
        F.hex("band_key").alias("band_key"),
    )


def lsh_buckets(spark: SparkSession, sf: str) -> DataFrame:
    return buckets(_banded(spark, sf, Workspace(spark))).select(
        F.col("band").cast("bigint").alias("band"),
        F.hex("band_key").alias("band_key"),
        "min_id",
        "n",
    )


def lsh_edges(spark: SparkSession, sf: str) -> DataFrame:
    workspace = Workspace(spark)
    signed, banding = _signed(spark, sf, workspace), PARAMS.banding()
    at_most = signed.count() * banding.bands
    return star_edges(bands(signed, banding), workspace, at_most=at_most)


def lsh_edges_hot(spark: SparkSession, sf: str) -> DataFrame:
    """The edges by way of the search for heavy buckets, with a low bound."""
    workspace = Workspace(spark)
    banded = bands(_signed(spark, sf, workspace), PARAMS.banding())
    return star_edges(banded, workspace, hot_rows=8)


# Graph


def _part_edges(
    spark: SparkSession, sf: str, workspace: Workspace, least: int = 0
) -> DataFrame:
    """Parts linked to the smallest part of the same order, by lines of some quantity at least."""
    lines = _table(spark, sf, "lineitem").where(F.col("l_quantity") >= least)
    lines = lines.select("l_orderkey", F.col("l_partkey").alias("src"))
    linked = with_group_min(
        lines, ["l_orderkey"], "src", "dst", workspace, at_most=lines.count()
    )
    return workspace.stage(linked.where("src > dst").select("src", "dst").distinct(), "edges")


def large_star_step(spark: SparkSession, sf: str) -> DataFrame:
    workspace = Workspace(spark)
    edges = _part_edges(spark, sf, workspace)
    return large_star(edges, workspace, at_most=edges.count())


def small_star_step(spark: SparkSession, sf: str) -> DataFrame:
    workspace = Workspace(spark)
    edges = _part_edges(spark, sf, workspace)
    return small_star(edges, workspace, at_most=edges.count())


def edge_symmetric_diff(spark: SparkSession, sf: str) -> DataFrame:
    workspace = Workspace(spark)
    edges = _part_edges(spark, sf, workspace)
    at_most = edges.count()
    large = workspace.stage(large_star(edges, workspace, at_most=at_most), "large")
    return symmetric_difference(large, small_star(large, workspace, at_most=at_most))


def _duplicates(spark: SparkSession, sf: str) -> Duplicates:
    return find_duplicates(_documents(spark, sf), "doc_id", "text", Workspace(spark), PARAMS)


def components(spark: SparkSession, sf: str) -> DataFrame:
    return _duplicates(spark, sf).components


def components_large(spark: SparkSession, sf: str) -> DataFrame:
    """The components by way of the loop for large graphs, with a low bound."""
    found = find_duplicates(
        _documents(spark, sf), "doc_id", "text", Workspace(spark), PARAMS, hot_rows=8
    )
    return found.components


def components_sorted(spark: SparkSession, sf: str) -> DataFrame:
    return components(spark, sf).select("component", "id").orderBy("component", "id")


def components_top(spark: SparkSession, sf: str) -> DataFrame:
    return components_sorted(spark, sf).limit(100)


def contracted_components(spark: SparkSession, sf: str) -> DataFrame:
    """The components of parts that large lines of an order share, from edges that are contracted
    in each task."""
    workspace = Workspace(spark)
    edges = _part_edges(spark, sf, workspace, LARGE_LINE)
    return connected_components(edges, workspace, hot_rows=1024, contract=True)


def incremental_signatures(spark: SparkSession, sf: str) -> DataFrame:
    """Edges of the documents, of which one part was signed earlier, in files that have stayed.

    The first run sees files that are gone in the second one, and their rows with them."""
    workspace = Workspace(spark)
    source, state = workspace.path("source"), workspace.path("state")
    rows = _documents(spark, sf)
    later = F.col("doc_id") > 2 * F.col("n_chars")
    parts = {
        "early": rows.where(~later),
        "gone": rows.withColumn("doc_id", -F.col("doc_id") - 1),
        "late": rows.where(later),
    }
    for run in (("early", "gone"), ("late",)):
        for name in run:
            write_table(parts[name], f"{source}/{name}")
        scan = spark.read.option("recursiveFileLookup", "true").parquet(source)
        found, _ = incremental_duplicates(scan, state, "doc_id", "text", workspace, PARAMS)
        Folders(spark).delete(f"{source}/gone")
    return found.edges


# Removal and the whole job


def near_dedup_keep(spark: SparkSession, sf: str) -> DataFrame:
    return keep_one(_documents(spark, sf), components(spark, sf), "doc_id")


def near_dedup_removed(spark: SparkSession, sf: str) -> DataFrame:
    return removed(_documents(spark, sf), components(spark, sf), "doc_id")


def near_dedup_by_place(spark: SparkSession, sf: str) -> DataFrame:
    return near_dedup_files(spark, f"{sf}/documents.parquet", "text", Workspace(spark), PARAMS)


def near_dedup_published(spark: SparkSession, sf: str) -> DataFrame:
    """The whole job on files without a key, into a versioned table that has a version already."""
    workspace = Workspace(spark)
    place = Published(spark, workspace.path("published"))
    place.replace(_documents(spark, sf))
    run_job_on_files(
        spark,
        f"{sf}/documents.parquet",
        place.root,
        workspace,
        text="text",
        params=PARAMS,
        profile_spec=DOCUMENTS_PROFILE,
        rules=(is_complete("doc_id"), is_unique("doc_id"), is_non_negative("n_chars")),
        check="documents",
        publish=True,
    )
    return place.read()


def near_dedup_job(spark: SparkSession, sf: str) -> DataFrame:
    workspace = Workspace(spark)
    result = run_job(
        _documents(spark, sf),
        workspace.path("output"),
        workspace,
        text="text",
        key="doc_id",
        profile_spec=DOCUMENTS_PROFILE,
        rules=(is_complete("doc_id"), is_unique("doc_id"), is_non_negative("n_chars")),
        check="documents",
    )
    return result.kept


# Data quality


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    return _table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.nullif("l_returnflag", F.lit("N")).alias("l_returnflag"),
        "l_quantity",
        "l_extendedprice",
    )


def dq_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return _long_metrics(profile(_lines(spark, sf), LINES_PROFILE))


def _long_metrics(metrics: DataFrame) -> DataFrame:
    is_text = F.col("name") == "schema"
    number = F.round(F.col("value").try_cast("double"), 6)
    return metrics.select(
        "entity",
        "instance",
        "name",
        F.when(~is_text, number).alias("number"),
        F.when(is_text, F.col("value")).alias("text"),
    )


def dq_uniqueness(spark: SparkSession, sf: str) -> DataFrame:
    """By hashes first, which larger tables take by themselves."""
    keys = {"lineitem": ["l_orderkey", "l_linenumber"], "conversations": ["conv_id", "turn"]}
    shares = [
        uniqueness_row(_table(spark, sf, name), key, Workspace(spark), small=0).select(
            F.lit(name).alias("tbl"), F.round("value", 9).alias("uniqueness")
        )
        for name, key in keys.items()
    ]
    return shares[0].unionByName(shares[1])


def dq_checks(spark: SparkSession, sf: str) -> DataFrame:
    rows = _documents(spark, sf).withColumn("lang", F.nullif("lang", F.lit("de")))
    rules = [
        is_complete("doc_id"),
        is_complete("lang", 0.95),
        is_complete("no_such_column"),
        is_unique("doc_id"),
        is_non_negative("n_chars"),
    ]
    return run_checks(rows, rules, "documents")


def failed(spark: SparkSession, sf: str) -> DataFrame:
    return failed_checks(dq_checks(spark, sf))


def dq_range_check(spark: SparkSession, sf: str) -> DataFrame:
    rules = [
        is_complete("s_name", 0.99, only_if_present=True),
        is_at_most("s_acctbal", 5000.0, only_if_present=True),
        is_at_least("s_acctbal", -1000.0, only_if_present=True),
        is_at_most("similarity_score", 1.0, only_if_present=True),
    ]
    return run_checks(_table(spark, sf, "supplier"), rules, "suppliers")


def metric_lookup(spark: SparkSession, sf: str) -> DataFrame:
    return metric(profile(_lines(spark, sf), LINES_PROFILE), "Size")


def schema_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    metrics = profile(_lines(spark, sf), LINES_PROFILE)
    shape = "struct<fields: array<struct<name: string, type: string>>>"
    whole = metrics.agg(
        F.max(F.when(F.col("name") == "schema", F.col("value"))).alias("schema"),
        F.max(F.when(F.col("name") == "Size", F.col("value").try_cast("double"))).alias("n"),
    )
    fields = F.inline(F.from_json("schema", shape)["fields"]).alias("name", "type")
    return whole.select(fields, F.col("n").cast("bigint").alias("n_rows"))


def row_counts(spark: SparkSession, sf: str) -> DataFrame:
    before = profile(_documents(spark, sf), SIZES)
    return row_count_gate(before, profile(near_dedup_keep(spark, sf), SIZES))


def schema_changes(spark: SparkSession, sf: str) -> DataFrame:
    rows = _documents(spark, sf)
    changed = rows.drop("lang").withColumns(
        {
            "n_chars": F.col("n_chars").cast("double"),
            "source": F.nullif("source", F.lit("src3")),
            "is_long": F.nullif(F.col("n_chars") > 1000, F.lit(False)),
        }
    )
    path = Workspace(spark).path("changed")
    write_table(changed, path)
    written = spark.read.parquet(path)
    gate = schema_gate(profile(rows, DOCUMENTS_PROFILE), profile(written, DOCUMENTS_PROFILE))
    before, after = _filled_counts(rows, "n_before"), _filled_counts(written, "n_after")
    return gate.join(before, "column", "left").join(after, "column", "left")


def schema_gate_nested(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with nested columns against a written table, in which some of them differ."""
    rows = _documents(spark, sf)
    about = [F.col("lang"), F.col("source")]
    sizes = F.array(F.struct(F.col("n_chars").alias("n")))
    before = rows.select("doc_id", F.struct(*about, sizes.alias("sizes")).alias("about"))
    wider = F.array(F.struct(F.col("n_chars").alias("n"), F.length("text").alias("points")))
    fewer = F.struct(about[0], wider.alias("sizes"), F.lit("new").alias("license"))
    path = Workspace(spark).path("nested")
    write_table(rows.select(F.col("doc_id").cast("string"), fewer.alias("about")), path)
    written = spark.read.parquet(path)
    gate = structural_schema_gate(profile(before, SIZES), profile(written, SIZES))
    sizes = [
        F.lit(metric(profile(df, SIZES), "Size").first()["value"]).cast("double").cast("bigint")
        for df in (before, written)
    ]
    return gate.select(
        "path",
        "type_before",
        "type_after",
        F.when(F.col("change") == "nullability", "same").otherwise(F.col("change")).alias("change"),
        sizes[0].alias("rows_before"),
        sizes[1].alias("rows_after"),
    )


def profile_merge(spark: SparkSession, sf: str) -> DataFrame:
    """The profile of a table from the kept states of its two halves."""
    place = Published(spark, Workspace(spark).path("profiles"))
    lines = _lines(spark, sf)
    for half in ("l_linenumber <= 3", "l_linenumber > 3"):
        place.append(profile_state(lines.where(half), LINES_PROFILE, ranges=64))
    return _long_metrics(profile_of(merged(place.read()), LINES_PROFILE))


def _filled_counts(df: DataFrame, name: str) -> DataFrame:
    """(column, number of rows that are not null), a row for each column."""
    counts = df.agg(*[F.count(c).alias(c) for c in df.columns])
    parts = [F.struct(F.lit(c).alias("column"), F.col(c).alias(name)) for c in df.columns]
    return counts.select(F.inline(F.array(*parts)))


def pk_audit(spark: SparkSession, sf: str) -> DataFrame:
    return primary_key_audit(_table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


def fk_audit(spark: SparkSession, sf: str) -> DataFrame:
    parents = _table(spark, sf, "customer")
    return foreign_key_audit(_orphaned(spark, sf), "o_custkey", parents, "c_custkey")


def _orphaned(spark: SparkSession, sf: str) -> DataFrame:
    """Orders of which some refer to customers that are not there."""
    customer = F.col("o_custkey")
    return _table(spark, sf, "orders").withColumn(
        "o_custkey", F.when(customer % 10 == 0, -customer).otherwise(customer)
    )


def dedup_key_check(spark: SparkSession, sf: str) -> DataFrame:
    return key_report(_lines(spark, sf), ["l_orderkey", "l_linenumber", "l_returnflag"])


# Modelling


def _flat(spark: SparkSession, sf: str) -> DataFrame:
    return _documents(spark, sf).withColumn("main_language", F.nullif("lang", F.lit("de")))


def dim_languages(spark: SparkSession, sf: str) -> DataFrame:
    return language_dimension(_flat(spark, sf), "doc_id", Workspace(spark))


def dim_repositories(spark: SparkSession, sf: str) -> DataFrame:
    flat = _flat(spark, sf)
    languages = language_dimension(flat, "doc_id", Workspace(spark))
    return repository_dimension(
        flat, "doc_id", languages, repo_id="source", columns=["doc_id", "n_chars"]
    )


def fact_files(spark: SparkSession, sf: str) -> DataFrame:
    flat = _flat(spark, sf).withColumn("position", -F.col("doc_id"))
    return file_facts(
        flat,
        Workspace(spark),
        "position",
        repo_id="source",
        columns=["doc_id", "text"],
        distribution=F.create_map("lang", "n_chars"),
    )


def snowflake_view(spark: SparkSession, sf: str) -> DataFrame:
    files = _orphaned(spark, sf).select(
        F.col("o_custkey").alias("repo_id"),
        F.col("o_orderpriority").alias("path"),
        F.col("o_orderkey").cast("string").alias("content"),
        F.col("o_orderkey").alias("size"),
        F.col("o_orderstatus").alias("commit_sha"),
        F.col("o_orderstatus").alias("languages_distribution"),
    )
    repositories = _table(spark, sf, "customer").select(
        F.col("c_custkey").alias("repo_id"),
        F.nullif("c_nationkey", F.lit(3)).alias("language_id"),
        F.col("c_mktsegment").alias("owner"),
        F.col("c_name").alias("name"),
        (F.col("c_acctbal") < 5000).alias("is_fork"),
        F.col("c_nationkey").alias("forks"),
        (F.col("c_custkey") % 7).alias("stars"),
        F.col("c_acctbal").alias("issues"),
        F.col("c_mktsegment").alias("license"),
    )
    languages = _table(spark, sf, "nation").select(
        F.col("n_nationkey").alias("language_id"), F.col("n_name").alias("language_name")
    )
    wide = wide_view(files, repositories, languages, "files_wide")
    # Unmatched rows hold nulls: one type on both engines keeps the comparison plain.
    return wide.withColumns(
        {
            "is_fork": F.col("is_fork").cast("string"),
            **{name: F.col(name).cast("double") for name in ("repo_id", "forks", "stars")},
        }
    )


def _flat_files(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as a flat table of files with the columns of the wide view."""
    repo = F.regexp_extract("source", "[0-9]+", 0).cast("bigint")
    return _documents(spark, sf).select(
        F.concat("source", F.lit("/"), "doc_id").alias("path"),
        F.concat(F.lit("owner"), repo % 7).alias("owner"),
        repo.alias("repo_id"),
        (repo % 3 == 0).alias("is_fork"),
        F.when(F.col("doc_id") % 5 > 0, F.create_map("lang", "n_chars")).alias(
            "languages_distribution"
        ),
        F.col("text").alias("content"),
        repo.cast("double").alias("issues"),
        F.when(repo % 4 > 0, F.concat(F.lit("L"), repo % 4)).alias("main_language"),
        (repo * 3).alias("forks"),
        (repo * 9000).alias("stars"),
        F.col("lang").alias("commit_sha"),
        (F.col("n_chars") * 100).alias("size"),
        F.col("source").alias("name"),
        F.nullif(F.col("source"), F.lit("src1")).alias("license"),
        "doc_id",
    )


def snowflake_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """A flat table of files, written as three tables and read through the view."""
    workspace = Workspace(spark)
    flat = _flat_files(spark, sf)
    *_, wide = load_snowflake(flat, workspace.path("snowflake"), workspace, "doc_id")
    return wide.withColumn("is_fork", F.col("is_fork").cast("string"))


def bucketed_snowflake(spark: SparkSession, sf: str) -> DataFrame:
    """The same view over tables that are bucketed alike and joined without an exchange."""
    flat, workspace = _flat_files(spark, sf), Workspace(spark)
    languages = workspace.stage(language_dimension(flat, "doc_id", workspace), "languages")
    repositories = repository_dimension(flat, "doc_id", languages)
    files = workspace.stage(file_facts(flat, workspace), "facts")
    tag = workspace.root.rsplit("-", 1)[-1]
    names = BucketedTables(*[f"{n}_{tag}" for n in ("files", "repositories", "languages")])
    write_bucketed(files, repositories, languages, names, workspace, 16, workspace.path("bucketed"))
    return bucketed_view(spark, names).withColumn("is_fork", F.col("is_fork").cast("string"))


def entry(spark: SparkSession) -> DataFrame:
    """Documents without near-duplicates."""
    rows = _documents(spark, "/root/testdata/sf0.001")
    return near_dedup(rows, "doc_id", "text", Workspace(spark), PARAMS)


def _optional(name: str) -> ModuleType | None:
    """A module that may be left out of a copy of the repository; its own import errors are raised."""
    try:
        found = importlib.util.find_spec(name)
    except ModuleNotFoundError:
        found = None
    return importlib.import_module(name) if found else None


_LLM = _optional("twinsieve.llm.queries")
_PIPELINE = _optional("corpus_pipeline") if _LLM else None


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    extra = {"pipeline": _PIPELINE.run} if _PIPELINE else {}
    return own_queries() | (_LLM.queries() if _LLM else {}) | extra


def own_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "table_scan": table_scan,
        "row_id_attach": row_id_attach,
        "row_id_scan": row_id_scan,
        "staged_roundtrip": staged_roundtrip,
        "staged_versions": staged_versions,
        "range_bucket": range_bucket_layout,
        "clustered_layout": clustered_layout,
        "token_counts": token_counts,
        "ngrams": ngrams,
        "shingle_hashes": shingle_hash_rows,
        "minhash_signatures": minhash_signatures,
        "lsh_bands": lsh_bands,
        "lsh_buckets": lsh_buckets,
        "lsh_edges": lsh_edges,
        "lsh_edges_hot": lsh_edges_hot,
        "large_star_step": large_star_step,
        "small_star_step": small_star_step,
        "edge_symmetric_diff": edge_symmetric_diff,
        "connected_components": components,
        "connected_components_large": components_large,
        "contracted_components": contracted_components,
        "incremental_signatures": incremental_signatures,
        "components_sorted": components_sorted,
        "components_top": components_top,
        "near_dedup_keep": near_dedup_keep,
        "near_dedup_removed": near_dedup_removed,
        "near_dedup_job": near_dedup_job,
        "near_dedup_by_place": near_dedup_by_place,
        "near_dedup_published": near_dedup_published,
        "dq_metrics": dq_metrics,
        "dq_uniqueness": dq_uniqueness,
        "dq_checks": dq_checks,
        "failed_checks": failed,
        "dq_range_check": dq_range_check,
        "metric_lookup": metric_lookup,
        "schema_snapshot": schema_snapshot,
        "row_count_gate": row_counts,
        "schema_gate": schema_changes,
        "schema_gate_nested": schema_gate_nested,
        "profile_merge": profile_merge,
        "pk_audit": pk_audit,
        "fk_audit": fk_audit,
        "dedup_key_check": dedup_key_check,
        "dim_languages": dim_languages,
        "dim_repositories": dim_repositories,
        "fact_files": fact_files,
        "snowflake_view": snowflake_view,
        "snowflake_roundtrip": snowflake_roundtrip,
        "bucketed_view": bucketed_snowflake,
    }


def oracle_sql() -> dict[str, str]:
    sql = _PIPELINE.ORACLE_SQL if _PIPELINE else None
    extra = {"pipeline": sql} if sql else {}
    return oracles.statements() | (_LLM.oracle_sql() if _LLM else {}) | extra
