"""Physical layout: range-bucket partitions and clustering."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from twinsieve.sources.tables import MAX_RECORDS_PER_FILE


def range_bucket(value: Column | str, start: int, stop: int, step: int) -> Column:
    """Bucket number of a value: 1.. inside [start, stop), 0 below, the last one above.

    Null stays null, so partitioning on the result keeps null rows in a partition of their own.
    """
    if step < 1 or stop <= start or (stop - start) % step:
        raise ValueError(f"no whole buckets in [{start}, {stop}) by {step}")
    buckets = (stop - start) // step
    return F.width_bucket(value, F.lit(start), F.lit(stop), F.lit(buckets))


def clustered(df: DataFrame, cluster_by: Sequence[str], unique_key: Sequence[str]) -> DataFrame:
    """Rows in range partitions of the clustering columns, sorted inside each.

    The unique key is part of the range, so a value that many rows share is split over
    several partitions.
    """
    order = [*cluster_by, *[c for c in unique_key if c not in cluster_by]]
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


def write_layout(
    df: DataFrame,
    path: str,
    bucket: Column,
    cluster_by: Sequence[str],
    unique_key: Sequence[str],
    bucket_name: str = "bucket",
    fmt: str = "parquet",
) -> None:
    """Write a directory for each bucket, with clustered files inside.

    A filter on the bucket column then reads only the directories it selects, and one on a
    clustering column skips files and row groups by their minimum and maximum.
    """
    rows = clustered(df.withColumn(bucket_name, bucket), [bucket_name, *cluster_by], unique_key)
    writer = rows.write.mode("overwrite").format(fmt).partitionBy(bucket_name)
    writer.option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).save(path)
