"""Removing rows of Parquet files by their place: bitmaps of the rows of each file that go.

A row's id is the number of its file and its place in the file (``read_with_row_id``). The removed
ids become bitmaps over the places, 2^15 rows each. They reach the scan by the hash of the file's
path, so the text is read once and neither shuffled nor joined by a key. A bitmap that no row of which
goes is not made.

Bitmaps are broadcast, ``MOST_BYTES`` at a time. If there are more, the files are dealt into groups by
the hash of their path, and each group is scanned with its own bitmaps; each file is still read once.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from twinsieve.operators.key_filter import bit_is_set
from twinsieve.sources.tables import PLACE_BITS, numbered_files
from twinsieve.sources.workspace import Workspace

# Rows that one bitmap tells of, as ``bitmap_construct_agg`` makes them, and its bytes.
_ROWS = 1 << 15
_BYTES = _ROWS // 8
MOST_BYTES = 256 << 20


def deletion_bitmaps(removed: DataFrame, files: DataFrame, column: str = "id") -> DataFrame:
    """(path_hash, part, bits, n): the removed places of each file, in parts of 2^15 rows.

    ``files`` are (__path, __file), see ``numbered_files``. Ids are combined before the shuffle.
    """
    place = F.col(column).bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    parts = removed.where(F.col(column).isNotNull()).groupBy(
        F.shiftright(column, PLACE_BITS).alias("__file"), F.floor(place / _ROWS).alias("part")
    )
    bits = parts.agg(F.bitmap_construct_agg(place % _ROWS).alias("bits"))
    return bits.join(files, "__file").select(
        F.col("__path").alias("path_hash"), "part", "bits", F.bitmap_count("bits").alias("n")
    )


def without_places(
    spark: SparkSession,
    source: str,
    removed: DataFrame,
    workspace: Workspace,
    columns: Sequence[str] | None = None,
    column: str = "id",
    most_bytes: int = MOST_BYTES,
) -> DataFrame:
    """The rows of Parquet files whose id is not among ``removed``, with the files' columns."""
    files = numbered_files(spark, source, workspace)
    bitmaps = workspace.stage(deletion_bitmaps(removed, files, column), "deletion-bitmaps")
    groups = -(-bitmaps.count() * _BYTES // most_bytes)
    parts = [
        _scan_without(spark, source, bitmaps, columns, group, groups)
        for group in range(max(groups, 1))
    ]
    return reduce(DataFrame.unionByName, parts)


def _scan_without(
    spark: SparkSession,
    source: str,
    bitmaps: DataFrame,
    columns: Sequence[str] | None,
    group: int,
    groups: int,
) -> DataFrame:
    """The rows left of one group of files. Which files those are is settled on the file list."""
    scan = spark.read.parquet(source)
    names = list(columns or scan.columns)
    path = F.xxhash64(F.col("_metadata.file_path"))
    if groups > 1:
        scan = scan.where(_group(path, groups) == group)
        bitmaps = bitmaps.where(_group(F.col("path_hash"), groups) == group)
    place = F.col("_metadata.row_index")
    located = scan.select(
        *names,
        path.alias("__path"),
        F.floor(place / _ROWS).alias("__part"),
        (place % _ROWS).alias("__bit"),
    )
    known = bitmaps.select(
        F.col("path_hash").alias("__path"), F.col("part").alias("__part"), "bits"
    )
    joined = located.join(F.broadcast(known), ["__path", "__part"], "left")
    return joined.where(~bit_is_set("bits", F.col("__bit"))).select(*names)


def _group(path_hash: Column, groups: int) -> Column:
    return F.pmod(path_hash, F.lit(groups))
