"""Dense surrogate keys 1..n that no single task has to number."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window, functions as F

from twinsieve.sources.workspace import Workspace

# monotonically_increasing_id keeps the row number of a partition in its low 33 bits.
_LOCAL_BITS = 33


def dense_key(
    df: DataFrame, order_by: Sequence[str], column: str, workspace: Workspace, name: str
) -> DataFrame:
    """Number the rows 1..n in the order of ``order_by``, which must be unique to be stable.

    The rows are range-partitioned, sorted inside each partition and staged with their place
    in it; with no ``order_by`` they are staged as scanned, without a shuffle. Then only one
    count for each partition is needed to shift the places: the window that adds those counts
    up, and the broadcast of its result, see one row for each partition and never the data.
    """
    if column in df.columns:
        raise ValueError(f"column {column} exists already")
    if order_by:
        ordered = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    else:
        ordered = df
    placed = workspace.stage(ordered.withColumn("__place", F.monotonically_increasing_id()), name)
    placed = placed.withColumn("__part", F.shiftright("__place", _LOCAL_BITS))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("__part")
        .agg(F.count(F.lit(1)).alias("__n"))
        .select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))
    )
    local = F.col("__place").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    return (
        placed.join(F.broadcast(offsets), "__part")
        .withColumn(column, F.col("__offset") + local + 1)
        .select(column, *df.columns)
    )


def dense_scan_key(
    df: DataFrame, column: str, workspace: Workspace, name: str
) -> DataFrame | None:
    """Number the rows of a scan of Parquet files 1..n, by path and place, without a copy.

    One count for each file is staged, added up in the order of the paths, and reaches the rows
    by the hash of the path; the place in the file does the rest. No other column is read for it
    and nothing is shuffled. None if ``df`` is no such scan, or does not have all rows of its
    files, which would leave gaps.
    """
    if column in df.columns:
        raise ValueError(f"column {column} exists already")
    try:
        places = df.select(
            F.col("_metadata.file_path").alias("__path"), F.col("_metadata.row_index").alias("__at")
        )
    except AnalysisException:
        return None
    counted = places.groupBy("__path").agg(
        F.count(F.lit(1)).alias("__n"), (F.max("__at") + 1).alias("__rows")
    )
    counted = workspace.stage(counted.withColumn("__hash", F.xxhash64("__path")), name)
    files, different, gaps = counted.agg(
        F.count(F.lit(1)), F.count_distinct("__hash"), F.count_if(F.col("__n") != F.col("__rows"))
    ).first()
    if gaps or files != different:
        return None
    before = Window.orderBy("__path").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counted.select(
        "__hash", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset")
    )
    located = df.select(
        "*",
        F.xxhash64(F.col("_metadata.file_path")).alias("__hash"),
        F.col("_metadata.row_index").alias("__at"),
    )
    number = (F.col("__offset") + F.col("__at") + 1).alias(column)
    return located.join(F.broadcast(offsets), "__hash").select(number, *df.columns)
