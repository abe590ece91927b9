"""A flat table of files as languages, repositories and files, and back as one wide view."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from twinsieve.operators.keys import dense_key, dense_scan_key
from twinsieve.sources.layout import range_bucket, write_layout
from twinsieve.sources.tables import write_table
from twinsieve.sources.workspace import Workspace

# The fill for a missing language and the columns of the three tables.
NOT_AVAILABLE = "N/A"
REPOSITORY_COLUMNS = ("owner", "name", "is_fork", "forks", "stars", "issues", "license")
FILE_COLUMNS = ("path", "content", "size", "commit_sha")
WIDE_COLUMNS = (
    "path",
    "owner",
    "repo_id",
    "is_fork",
    "languages_distribution",
    "content",
    "issues",
    "main_language",
    "forks",
    "stars",
    "commit_sha",
    "size",
    "name",
    "license",
)


def language_dimension(
    flat: DataFrame, position: str, workspace: Workspace, language: str = "main_language"
) -> DataFrame:
    """(language_id, language_name): 1..n by first appearance in the order of ``position``."""
    first_seen = flat.groupBy(_filled(language).alias("language_name")).agg(
        F.min(position).alias("__first")
    )
    numbered = dense_key(
        first_seen, ["__first", "language_name"], "language_id", workspace, "languages"
    )
    return numbered.select(F.col("language_id").cast("bigint"), "language_name")


def repository_dimension(
    flat: DataFrame,
    position: str,
    languages: DataFrame,
    repo_id: str = "repo_id",
    language: str = "main_language",
    columns: Sequence[str] = REPOSITORY_COLUMNS,
) -> DataFrame:
    """The first row of each repository by ``position``, with its language id.

    Positions are unique; rows without one come last. The first positions come from a hash
    aggregate, which is combined before the shuffle, and pick their rows in a join. Where a
    repository has no position at all, the row with the least values is the first.
    """
    place = F.coalesce(F.col(position).cast("bigint"), F.lit((1 << 63) - 1))
    names = [f"__c{i}" for i in range(len(columns))]
    rows = flat.select(
        F.col(repo_id).alias("__repo"),
        place.alias("__place"),
        _filled(language).alias("language_name"),
        *[F.col(c).alias(n) for c, n in zip(columns, names, strict=True)],
    )
    first = rows.groupBy(F.col("__repo").alias("__key")).agg(F.min("__place").alias("__first"))
    picked = rows.join(
        first, F.col("__repo").eqNullSafe(F.col("__key")) & (F.col("__place") == F.col("__first"))
    )
    # One row for each repository, but for those without any position.
    least = picked.groupBy("__repo").agg(F.min(F.struct("language_name", *names)).alias("__row"))
    return least.select("__repo", "__row.*").join(languages, "language_name", "left").select(
        F.col("__repo").alias(repo_id),
        "language_id",
        *[F.col(n).alias(c) for c, n in zip(columns, names, strict=True)],
    )


def file_facts(
    flat: DataFrame,
    workspace: Workspace,
    position: str | None = None,
    repo_id: str = "repo_id",
    columns: Sequence[str] = FILE_COLUMNS,
    distribution: Column | None = None,
) -> DataFrame:
    """(file_id, repo_id, columns, languages_distribution as JSON) with file_id 1..n.

    The ids follow the order of the scan, which takes no shuffle, and for a whole scan of files no
    copy either, or that of ``position``, which takes a shuffle of all facts by range. A missing
    distribution is the JSON text ``null``.
    """
    value = F.col("languages_distribution") if distribution is None else distribution
    order = [F.col(position).alias("__position")] if position else []
    rows = flat.select(
        repo_id,
        *columns,
        F.coalesce(F.to_json(value), F.lit("null")).alias("languages_distribution"),
        *order,
    )
    numbered = None if position else dense_scan_key(rows, "file_id", workspace, "file-counts")
    if numbered is None:
        order = ["__position"] if position else []
        numbered = dense_key(rows, order, "file_id", workspace, "files")
    return numbered.drop("__position")


def wide_view(
    files: DataFrame,
    repositories: DataFrame,
    languages: DataFrame,
    name: str | None = None,
    also: Sequence[str] = (),
) -> DataFrame:
    """Files with their repository and its language; optionally registered as a view.

    The two dimensions are joined to each other first, so the wide fact rows take part in one
    join only. ``also`` names further columns of files and repositories that have to be equal.
    """
    dimension = repositories.join(languages, "language_id", "left").withColumnRenamed(
        "language_name", "main_language"
    )
    same = F.col("__file_repo") == F.col("repo_id")
    for column in also:
        files = files.withColumnRenamed(column, f"__file_{column}")
        same &= F.col(f"__file_{column}") == F.col(column)
    wide = (
        files.withColumnRenamed("repo_id", "__file_repo")
        .join(dimension, same, "left")
        .select(*WIDE_COLUMNS)
    )
    if name:
        wide.createOrReplaceTempView(name)
    return wide


# The ranges that partition two of the tables, as (column, start, stop, step), and the
# columns that cluster them.
REPOSITORY_LAYOUT = (("stars", 0, 100_000, 10_000), ("owner",), ("repo_id",))
FILE_LAYOUT = (("size", 0, 1_000_000, 100_000), ("repo_id",), ("file_id",))


def load_snowflake(
    flat: DataFrame,
    folder: str,
    workspace: Workspace,
    position: str,
    view: str | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Write a flat table as languages, repositories and files, each replaced, and read them back.

    Repositories and files have their fixed layouts, so a filter on the bucket reads only some
    folders. Returns the three tables and the wide view over them, registered if it has a name.
    ``position`` orders the first appearance of languages and repositories; file ids follow the
    scan.
    """
    spark, folder = workspace.spark, folder.rstrip("/")
    languages = language_dimension(flat, position, workspace)
    write_table(languages, f"{folder}/languages")
    languages = spark.read.parquet(f"{folder}/languages")
    repositories = repository_dimension(flat, position, languages)
    files = file_facts(flat, workspace)
    tables = [languages]
    for table, name, (bounds, cluster, key) in (
        (repositories, "repositories", REPOSITORY_LAYOUT),
        (files, "files", FILE_LAYOUT),
    ):
        write_layout(table, f"{folder}/{name}", range_bucket(*bounds), cluster, key)
        tables.append(spark.read.parquet(f"{folder}/{name}"))
    languages, repositories, files = tables
    plain = repositories.drop("bucket"), files.drop("bucket")
    return (*tables, wide_view(plain[1], plain[0], languages, view))


def _filled(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(NOT_AVAILABLE))
