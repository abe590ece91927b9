"""Files and repositories bucketed alike, so that the wide view joins them without an exchange.

Both tables are written in buckets of (repository, part). An ordinary repository is one part. One
that holds more files than a bucket should is split: its files are dealt to several parts by their
id, and its row is repeated once for each part, so no bucket and no task of the join grows with
one repository. The repeated rows are fewer than twice the buckets.

Buckets belong to tables of the catalog. The text is shuffled once, when it is written; after
that each view over it is free of that, however often it is read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from twinsieve.plans.snowflake import wide_view
from twinsieve.sources.tables import MAX_RECORDS_PER_FILE
from twinsieve.sources.workspace import Workspace

PART = "repo_part"
# More languages than this are joined as the planner likes; fewer are broadcast, some 100 bytes each.
BROADCAST_ROWS = 200_000


@dataclass(frozen=True)
class BucketedTables:
    """Names in the catalog."""

    files: str
    repositories: str
    languages: str

    def drop(self, spark: SparkSession) -> None:
        for name in (self.files, self.repositories, self.languages):
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def bucket_count(size_bytes: int, bucket_bytes: int = 1 << 30, most: int = 100_000) -> int:
    """Buckets for so many bytes of files, a power of two so that tables of other sizes fit."""
    wanted = max(1, -(-size_bytes // bucket_bytes))
    return min(1 << (wanted - 1).bit_length(), 1 << (most.bit_length() - 1))


def repository_parts(
    files: DataFrame, buckets: int, workspace: Workspace, repo_id: str = "repo_id"
) -> DataFrame:
    """(repository, parts) staged, for the repositories with more files than a bucket's share.

    There are fewer such repositories than buckets, so the table may be broadcast. Files without a
    repository need no entry, see ``with_part``.
    """
    known = files.where(F.col(repo_id).isNotNull())
    counts = workspace.stage(
        known.groupBy(F.col(repo_id).alias("__repo")).agg(F.count(F.lit(1)).alias("__n")),
        "repository-files",
    )
    total = counts.agg(F.sum("__n")).first()[0] or 0
    share = max(1, -(-total // buckets))
    large = counts.where(F.col("__n") > share)
    return workspace.stage(
        large.select("__repo", F.ceil(F.col("__n") / share).cast("int").alias("__parts")),
        "repository-parts",
    )


def with_part(
    files: DataFrame,
    parts: DataFrame,
    buckets: int,
    repo_id: str = "repo_id",
    file_id: str = "file_id",
) -> DataFrame:
    """``files`` with the part of its repository that each belongs to.

    Files without a repository match nothing, so they are spread over all parts there may be.
    """
    several = F.when(F.col(repo_id).isNull(), F.lit(buckets)).otherwise(
        F.coalesce(F.col("__parts"), F.lit(1))
    )
    dealt = F.pmod(F.xxhash64(file_id), several.cast("bigint")).cast("int")
    joined = files.join(F.broadcast(parts), F.col(repo_id) == F.col("__repo"), "left")
    return joined.select(*files.columns, dealt.alias(PART))


def with_every_part(
    repositories: DataFrame, parts: DataFrame, repo_id: str = "repo_id"
) -> DataFrame:
    """``repositories`` with each row once for each part."""
    joined = repositories.join(F.broadcast(parts), F.col(repo_id) == F.col("__repo"), "left")
    last = F.coalesce(F.col("__parts"), F.lit(1)) - 1
    return joined.select(*repositories.columns, F.explode(F.sequence(F.lit(0), last)).alias(PART))


def write_bucketed(
    files: DataFrame,
    repositories: DataFrame,
    languages: DataFrame,
    names: BucketedTables,
    workspace: Workspace,
    buckets: int,
    folder: str | None = None,
) -> BucketedTables:
    """Write the three tables under their names, replaced; ``folder`` holds them outside the warehouse.

    The id of a file is unique and that of a repository too, but for null, as those of
    ``load_snowflake``. A repository without an id is left out, for no file can match it.
    """
    parts = repository_parts(files, buckets, workspace)
    dealt = with_part(files, parts, buckets)
    whole = with_every_part(repositories.where(F.col("repo_id").isNotNull()), parts)
    for rows, name in ((dealt, names.files), (whole, names.repositories)):
        # The tasks of this shuffle are the buckets, so each bucket is written by one task.
        rows = rows.repartition(buckets, "repo_id", PART)
        writer = rows.write.mode("overwrite").format("parquet")
        writer = writer.option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
        if folder:
            writer = writer.option("path", f"{folder.rstrip('/')}/{name.split('.')[-1]}")
        writer.bucketBy(buckets, "repo_id", PART).saveAsTable(name)
    writer = languages.write.mode("overwrite").format("parquet")
    if folder:
        writer = writer.option("path", f"{folder.rstrip('/')}/{names.languages.split('.')[-1]}")
    writer.saveAsTable(names.languages)
    return names


def bucketed_view(
    spark: SparkSession,
    names: BucketedTables,
    view: str | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """The wide view over bucketed tables: the rows of ``wide_view``, with no exchange of files.

    Nor are repositories exchanged, as long as the languages, which are counted, may be broadcast.
    """
    languages = spark.table(names.languages)
    if languages.count() <= broadcast_rows:
        languages = F.broadcast(languages)
    files, repositories = spark.table(names.files), spark.table(names.repositories)
    return wide_view(files, repositories, languages, view, also=(PART,))
