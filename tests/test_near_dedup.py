import numpy as np
import pytest
from pyspark.sql import functions as F

import plain
from twinsieve import DedupParams, find_duplicates, near_dedup, run_job
from twinsieve.functions.minhash import permutations
from twinsieve.operators.banding import signatures
from twinsieve.operators.audits import KeyNotUnique
from twinsieve.operators.checks import is_complete, is_unique
from twinsieve.operators.gates import GateFailed
from twinsieve.operators.profile import ProfileSpec
from twinsieve.plans import near_dedup as near_dedup_plan
from twinsieve.sources.tables import read_with_row_id, write_table
from twinsieve.sources.workspace import Workspace

PARAMS = DedupParams(num_perm=64)
RULES = (is_complete("key"), is_unique("key"))


def corpus():
    """Random texts, edited copies of some, a third exact copies of one, and edge cases."""
    rng = np.random.default_rng(11)
    texts = plain.random_texts(120, 4, vocabulary=2000)
    for i in range(20):
        words = texts[i].split(" ")
        words[int(rng.integers(len(words)))] = "edited"
        texts.append(" ".join(words))
    texts += [texts[0]] * 80 + plain.EDGE_TEXTS + plain.EDGE_TEXTS
    return [texts[i] for i in rng.permutation(len(texts))]


@pytest.fixture(scope="module")
def texts():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "key long, content string")


def expected_components(texts, params):
    banding = params.banding()
    pairs = permutations(params.num_perm).tolist()[: banding.used]
    signed = {i: plain.signature(t, pairs) for i, t in enumerate(texts)}
    signed = {i: s for i, s in signed.items() if s is not None}
    return plain.components(plain.star_edges(signed, banding.bands, banding.rows))


@pytest.mark.parametrize("hot_rows", [10**9, 10])
def test_components_match_the_definition(docs, texts, workspace, hot_rows):
    found = find_duplicates(docs, "key", "content", workspace, PARAMS, hot_rows=hot_rows)
    got = {r.id: r.component for r in found.components.collect()}
    assert got == expected_components(texts, PARAMS)
    assert len(got) > 80


def test_one_of_each_component_is_kept(docs, texts, workspace):
    kept = near_dedup(docs, "key", "content", workspace, PARAMS)
    assert kept.columns == docs.columns
    removed = set(expected_components(texts, PARAMS))
    assert sorted(r.key for r in kept.collect()) == [
        i for i in range(len(texts)) if i not in removed
    ]


def test_a_second_run_removes_nothing(docs, workspace):
    first = workspace.stage(near_dedup(docs, "key", "content", workspace, PARAMS), "first")
    again = near_dedup(first, "key", "content", workspace, PARAMS)
    assert again.count() == first.count()


def test_survivors_do_not_depend_on_partitioning(docs, workspace):
    answers = set()
    for parts in (1, 3, 16):
        kept = near_dedup(docs.repartition(parts), "key", "content", workspace, PARAMS)
        answers.add(tuple(sorted(r.key for r in kept.collect())))
    assert len(answers) == 1


def test_two_results_of_one_workspace_do_not_mix(docs, sparse, workspace):
    one = near_dedup(docs, "key", "content", workspace, PARAMS)
    two = near_dedup(sparse, "key", "content", workspace, PARAMS)
    assert two.count() == 100
    assert one.count() == docs.count() - len(expected_components(corpus(), PARAMS))


def test_short_and_null_texts_are_kept(spark, workspace):
    rows = [(i, t) for i, t in enumerate([None, "", "a b c d", None, "", "a b c d"])]
    docs = spark.createDataFrame(rows, "key long, content string")
    assert near_dedup(docs, "key", "content", workspace, PARAMS).count() == 6


def job(docs, workspace, params=PARAMS, **options):
    spec = ProfileSpec(("content",), (), ("key",))
    options = {"key": "key", "profile_spec": spec, "rules": RULES, **options}
    return run_job(docs, workspace.path("out"), workspace, params=params, **options)


@pytest.fixture(scope="module")
def sparse(spark):
    """Few duplicates, so the row-count gate passes."""
    texts = plain.random_texts(100, 8, vocabulary=5000)
    texts = [t + " padding one two three four" + str(i) for i, t in enumerate(texts)]
    texts += texts[:10]
    return spark.createDataFrame(list(enumerate(texts)), "key long, content string")


def test_job(spark, sparse, workspace):
    result = job(sparse, workspace)
    assert sorted(r.key for r in result.kept.collect()) == list(range(100))
    written = spark.read.parquet(workspace.path("out"))
    assert written.columns == ["key", "content"] and written.count() == 100
    assert plain.pairs(result.components, "id", "component") == {(100 + i, i) for i in range(10)}
    row = result.row_count.first()
    assert (row.rows_before, row.rows_after, row.passed) == (110, 100, True)
    assert {r.change for r in result.schema.collect()} == {"same"}
    assert {r.check_status for r in result.checks_after.collect()} == {"Success"}
    stored = spark.read.parquet(workspace.path("reports/profile_before"))
    assert {r.name for r in stored.collect()} == {"Size", "schema", "Completeness", "Uniqueness"}


def test_job_without_a_key(sparse, workspace):
    """Generated ids stay inside the job, and one row of each pair is left."""
    result = job(sparse, workspace, key=None)
    assert result.kept.columns == ["key", "content"]
    assert result.kept.count() == result.kept.select("content").distinct().count() == 100
    assert '"__row_id"' not in str(result.profile_before.collect())


def test_job_on_files_without_a_key(spark, sparse, workspace):
    """Ids of the scan serve the job and are left out of the output, without a copy."""
    path = workspace.path("input")
    sparse.select("content").repartition(4).write.parquet(path)
    docs = read_with_row_id(spark, path, workspace)
    spec = ProfileSpec(("content",))
    rules = (is_complete("content"),)
    result = job(docs, workspace, key="row_id", keep_key=False, profile_spec=spec, rules=rules)
    assert result.kept.columns == ["content"] and result.kept.count() == 100
    assert '"row_id"' not in str(result.profile_before.collect())


def test_gate_fails_when_nothing_is_removed(sparse, workspace):
    with pytest.raises(GateFailed, match="row count"):
        job(sparse.where("key < 100"), workspace)


def test_gate_fails_when_too_much_is_removed(docs, workspace):
    with pytest.raises(GateFailed, match="row count"):
        job(docs, workspace)


def test_output_without_components_has_the_same_schema(spark, sparse, workspace):
    with pytest.raises(GateFailed):
        job(sparse.where("key < 100"), workspace, key=None)
    written = spark.read.parquet(workspace.path("out"))
    assert written.columns == ["key", "content"] and written.count() == 100


def test_failed_checks_raise_only_if_strict(sparse, workspace):
    bad = (is_complete("absent"),)
    result = job(sparse, workspace, rules=bad)
    assert {r.check_status for r in result.checks_before.collect()} == {"Error"}
    with pytest.raises(GateFailed, match="before"):
        job(sparse, workspace, rules=bad, strict=True)


def test_signature_step_reads_two_columns_once(spark, workspace, docs):
    stored = workspace.stage(docs.withColumn("other", F.lit("x" * 10)), "docs")
    plan = signatures(stored, "key", "content")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and plan.count("FileScan") == 1
    assert "ReadSchema: struct<key:bigint,content:string>" in plan


@pytest.mark.parametrize("ids", [[1, 5, 5, 7], [1, None, 5, 7]])
def test_repeated_and_null_keys_are_refused(spark, workspace, ids):
    """A row of its own must not go along with a row that shares its key."""
    texts = ["a b c d e f", "a b c d e f", "another text with words of its own", "g h i j k l"]
    rows = spark.createDataFrame(list(zip(ids, texts, strict=True)), "key long, content string")
    with pytest.raises(KeyNotUnique, match="key is no key"):
        near_dedup(rows, "key", "content", workspace, PARAMS)
    with pytest.raises(KeyNotUnique):
        job(rows, workspace)
    kept = near_dedup(rows, "key", "content", workspace, PARAMS, proven_unique=True)
    assert kept.columns == ["key", "content"]


CHANGES = {
    "dropped": lambda df: df.drop("content"),
    "added": lambda df: df.withColumn("more", F.lit(1)),
    "retyped": lambda df: df.withColumn("key", F.col("key").cast("string")),
}


@pytest.mark.parametrize("change", CHANGES)
def test_gate_fails_when_the_writer_changes_the_schema(sparse, workspace, monkeypatch, change):
    def writer(df, path):
        write_table(CHANGES[change](df), path)

    monkeypatch.setattr(near_dedup_plan, "write_table", writer)
    with pytest.raises(GateFailed, match=f"schema.*{change}"):
        job(sparse, workspace)


def test_a_named_run_goes_on_after_an_error(spark, sparse, workspace, monkeypatch):
    """Signatures are not computed again, other parameters start anew."""

    def fails(*args, **options):
        raise RuntimeError("lost")

    expected = sorted(
        r.key for r in near_dedup(sparse, "key", "content", workspace, PARAMS).collect()
    )
    with monkeypatch.context() as patch, pytest.raises(RuntimeError, match="lost"):
        patch.setattr(near_dedup_plan, "star_edges", fails)
        with Workspace(spark, workspace.root, run="test") as space:
            near_dedup(sparse, "key", "content", space, PARAMS)
    with monkeypatch.context() as patch:
        patch.setattr(near_dedup_plan, "signatures", fails)
        space = Workspace(spark, workspace.root, run="test")
        kept = near_dedup(sparse, "key", "content", space, PARAMS)
        assert sorted(r.key for r in kept.collect()) == expected
        patch.setattr(near_dedup_plan, "star_edges", fails)
        patch.setattr(near_dedup_plan, "connected_components", fails)
        again = near_dedup(sparse, "key", "content", space, PARAMS)
        assert sorted(r.key for r in again.collect()) == expected
        with pytest.raises(RuntimeError, match="lost"):
            near_dedup(sparse, "key", "content", space, DedupParams(num_perm=32))
