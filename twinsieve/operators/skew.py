"""Group minimum on every row, safe when one group holds a large share of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from twinsieve.sources.workspace import Workspace

# A group up to this size is cheap for one task to sort.
HOT_ROWS = 4_000_000
# Counters of the first pass. A constant, which bounds what is broadcast, see ``heavy_groups``.
BINS = 1 << 18


def heavy_groups(
    rows: DataFrame,
    keys: Sequence[str],
    value: str,
    out: str,
    workspace: Workspace,
    name: str,
    hot_rows: int = HOT_ROWS,
) -> DataFrame | None:
    """Keys and minimum of the groups above ``hot_rows`` rows, staged, or None if there are none.

    First all rows are counted in a fixed number of hash bins, which needs next to no shuffle.
    A group is at most as large as its bin, so small bins rule out nearly all groups at once
    and only the rows of large bins are grouped by key. A heavy group has more than four times
    the rows of an average bin, so there are less than a quarter as many as there are bins.
    """
    bin_of = F.pmod(F.xxhash64(*keys), F.lit(BINS))
    bins = rows.groupBy(bin_of.alias("__bin")).agg(F.count(F.lit(1)).alias("__n"))
    bins = workspace.stage(bins, f"{name}-bins")
    total, largest = bins.agg(F.sum("__n"), F.max("__n")).first()
    limit = max(hot_rows, 4 * (total or 0) // BINS)
    if total is None or largest <= limit:
        workspace.drop(bins)
        return None
    large_bins = F.broadcast(bins.where(F.col("__n") > limit).select("__bin"))
    heavy = (
        rows.withColumn("__bin", bin_of)
        .join(large_bins, "__bin", "left_semi")
        .groupBy(*keys)
        .agg(F.min(value).alias(out), F.count(F.lit(1)).alias("__n"))
        .where(F.col("__n") > limit)
        .drop("__n")
    )
    heavy = workspace.stage(heavy, name)
    workspace.drop(bins)
    return None if heavy.isEmpty() else heavy


def with_group_min(
    rows: DataFrame,
    keys: Sequence[str],
    value: str,
    out: str,
    workspace: Workspace,
    name: str = "heavy",
    hot_rows: int = HOT_ROWS,
    at_most: int | None = None,
) -> DataFrame:
    """Add to each row the smallest ``value`` among the rows with the same ``keys``.

    Ordinary groups take one shuffle and a window. Heavy groups are reduced to one row each by
    a partial aggregate and reach their rows by broadcast, so their rows are not shuffled at
    all. ``rows`` should be cheap to read again (a staged table); ``at_most`` is a known bound
    on its row count, which saves the search for heavy groups if it is small enough.
    """
    minimum = F.min(value).over(Window.partitionBy(*keys))
    heavy = None
    if at_most is None or at_most > hot_rows:
        heavy = heavy_groups(rows, keys, value, out, workspace, name, hot_rows)
    if heavy is None:
        return rows.withColumn(out, minimum)
    hot = rows.join(F.broadcast(heavy), list(keys))
    cold = rows.join(F.broadcast(heavy.select(*keys)), list(keys), "left_anti")
    return cold.withColumn(out, minimum).unionByName(hot)
