"""Sharding: contiguous ranges of text groups, the largest as small as can be.

Rows with equal texts form an atomic group. Groups are ordered by a 60-bit hash of the text (texts
that share the hash go together), and this order is cut into shards. The capacity is the smallest
for which cutting greedily needs no more shards than asked for, found by binary search.

The groups stay in Spark. The driver holds cells, ranges of hashes with their total: at first a
fixed number over all hashes. Where a cut can fall in a cell with several groups, the cell is
divided by another aggregate over the groups, until every cut for every capacity still possible is
known to fall between groups. The number of cells depends on shards and splits, not on rows. A
shard is then a plain comparison of a row's hash with the cuts, so no text is shuffled.

Null texts form a group of their own with size 1; an empty text has size 1 too. Repeated rows are
rows of their own. An empty table gives an empty result, and shards may stay empty.
"""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from twinsieve.sources.workspace import Workspace

KEY_BITS = 60
FIRST_BITS = 12
SPLIT_BITS = 6
# Rows that one numbering window takes; a constant, so no task grows with the table.
SLOT_ROWS = 50_000


@dataclass(frozen=True)
class Cell:
    """Hashes ``low`` to ``high`` and the size, number and largest of the groups there."""

    low: int
    high: int
    size: int
    groups: int


def text_key(text: Column) -> Column:
    """A hash from 0 to 2^60 - 1; nulls share one."""
    return F.shiftrightunsigned(F.xxhash64(text), 64 - KEY_BITS)


def cuts(groups: DataFrame, shards: int) -> list[int]:
    """The last hash of each shard but the last, for staged groups (key, size)."""
    cells = _cells(groups, FIRST_BITS, [(0, (1 << KEY_BITS) - 1)])
    total = sum(cell.size for cell in cells)
    largest = groups.agg(F.max("size")).first()[0] or 0
    low = max(largest, -(-total // shards))
    while True:
        high = _smallest([c.size for c in cells], shards, low)
        unsure = _unsure(cells, shards, low, high)
        if not unsure:
            return _greedy_cuts(cells, shards, high)
        split = _cells(groups, SPLIT_BITS, [(cells[i].low, cells[i].high) for i in sorted(unsure)])
        kept = [cell for i, cell in enumerate(cells) if i not in unsure]
        cells = sorted(kept + split, key=lambda cell: cell.low)


def _cells(groups: DataFrame, bits: int, ranges: list[tuple[int, int]]) -> list[Cell]:
    """Totals of 2^bits equal parts of each range; empty parts are left out."""
    rows = groups
    if len(ranges) > 1:
        spark = groups.sparkSession
        width = ranges[0][1] - ranges[0][0] + 1
        widths = {high - low + 1 for low, high in ranges}
        chosen = spark.createDataFrame(
            [(low, high - low + 1) for low, high in ranges], "start bigint, width bigint"
        )
        parts = None
        for width in sorted(widths):
            starts = chosen.where(F.col("width") == width).select("start")
            inside = groups.withColumn("start", F.col("key") - F.pmod("key", F.lit(width)))
            found = inside.join(F.broadcast(starts), "start").select(
                "key", "size", F.lit(max(width >> bits, 1)).alias("step")
            )
            parts = found if parts is None else parts.unionByName(found)
        rows = parts
    else:
        low, high = ranges[0]
        width = high - low + 1
        rows = groups.where(F.col("key").between(low, high)).select(
            "key", "size", F.lit(max(width >> bits, 1)).alias("step")
        )
    found = (
        rows.withColumn("low", F.col("key") - F.pmod("key", "step"))
        .groupBy("low", "step")
        .agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("groups"))
        .collect()
    )
    return sorted(
        (Cell(r["low"], r["low"] + r["step"] - 1, r["size"], r["groups"]) for r in found),
        key=lambda cell: cell.low,
    )


def _ends(sizes: list[int], capacity: int) -> list[int]:
    """Greedy cuts: the number of leading items at the end of each shard but the last."""
    ends, room = [], capacity
    for i, size in enumerate(sizes):
        if size > room:
            ends.append(i)
            room = capacity
        room -= size
    return ends


def _smallest(sizes: list[int], shards: int, low: int) -> int:
    """The smallest capacity of at least ``low`` for which greedy cutting gives enough shards."""
    low, high = max([low, *sizes]), max(low, sum(sizes))
    while low < high:
        middle = (low + high) // 2
        if len(_ends(sizes, middle)) < shards:
            high = middle
        else:
            low = middle + 1
    return low


def _unsure(cells: list[Cell], shards: int, low: int, high: int) -> set[int]:
    """Cells of several groups in which a greedy cut may fall, for a capacity in [low, high].

    Each capacity fills a shard to a point that lies no earlier than with whole cells at ``low``,
    where a shard holds at least what the cells before its first unfitting one hold, and no later
    than with divisible cells at ``high``.
    """
    ends, total = [], 0
    for cell in cells:
        total += cell.size
        ends.append(total)
    first = last = 0
    unsure: set[int] = set()
    for _ in range(shards - 1):
        # Earliest: the cell that does not fit is left whole for the next shard.
        start = bisect_right(ends, first + low)
        first = max(first, ends[start - 1] if start else 0)
        last = min(total, last + high)
        if last >= total and start >= len(cells):
            break
        stop = min(bisect_right(ends, last), len(cells) - 1)
        unsure.update(i for i in range(min(start, stop), stop + 1) if cells[i].groups > 1)
    return unsure


def _greedy_cuts(cells: list[Cell], shards: int, capacity: int) -> list[int]:
    ends = _ends([cell.size for cell in cells], capacity)
    found = [cells[end - 1].high if end else -1 for end in ends]
    return found + [(1 << KEY_BITS) - 1] * (shards - 1 - len(found))


def sharded(
    df: DataFrame, workspace: Workspace, shards: int = 16, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(key, size, text_crc32, law, shard, slot, grown_shard) for each row.

    ``slot`` numbers the rows of a shard without gaps: rows are dealt to bins by their place in the
    staged table, and a bin's numbers start after those of the bins before it.
    """
    content = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = workspace.stage(
        df.select(
            F.col(key).alias("__id"),
            (F.octet_length(content) + 1).cast("bigint").alias("size"),
            F.crc32(F.encode(content, "UTF-8")).alias("text_crc32"),
            text_key(F.col(text)).alias("key"),
        ).withColumn("place", F.monotonically_increasing_id()),
        "sizes",
    )
    groups = workspace.stage(rows.groupBy("key").agg(F.sum("size").alias("size")), "groups")
    number = F.lit(0)
    for cut in cuts(groups, shards):
        number = number + F.when(F.col("key") > cut, 1).otherwise(0)
    bins = max(1, rows.count() // SLOT_ROWS)
    placed = rows.withColumns(
        {"shard": number.cast("int"), "bin": F.pmod(F.xxhash64("place"), F.lit(bins))}
    )
    before = Window.partitionBy("shard").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    first = (
        placed.groupBy("shard", "bin")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("shard", "bin", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    )
    inside = Window.partitionBy("shard", "bin").orderBy("place")
    numbered = placed.withColumn("slot", F.row_number().over(inside) - 1)
    return numbered.join(first, ["shard", "bin"]).select(
        F.col("__id").alias(key),
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("first") + F.col("slot")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
