"""How often keys repeat, without a shuffle of the keys.

First only hashes are compared. A task keeps the different hashes of its rows, cut to as many bits as
the number of rows asks for, sorts them and passes on the steps between them, two or three bytes a row,
and which of them it has met twice. The hashes that two tasks have, or one has twice, are suspect:
those of repeated keys, and one in a thousand others. A bit array of the suspect hashes lets nearly all
other rows go, and only what is left is grouped by its exact key. A key that repeats very often is
two entries of each task at most, so no task gets more than its share.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from twinsieve.functions.packing import packed, unpacked
from twinsieve.operators.key_filter import with_maybe
from twinsieve.sources.workspace import Workspace

# Up to so many rows, grouping by the key at once is as cheap.
SMALL = 1 << 20
# Rows of a task whose hashes are sorted together, and hashes that are compared together.
CHUNK, PART = 1 << 20, 1 << 21
# Bits of a hash beyond those that number the rows: one row in 2^10 is suspect by chance.
_MORE_BITS = 10


@dataclass(frozen=True)
class KeyCounts:
    """Rows, those whose key has a null or only nulls, and rows and keys that occur repeatedly.

    ``shared_rows`` may have nulls in some of the key's columns, ``repeated_rows`` in none.
    """

    rows: int
    null_rows: int
    empty_rows: int
    repeated_keys: int
    repeated_rows: int
    shared_rows: int

    def uniqueness(self) -> float | None:
        """The share of rows whose key occurs once; a key of nulls is none."""
        if not self.rows:
            return None
        return (self.rows - self.empty_rows - self.shared_rows) / self.rows


def key_counts(
    df: DataFrame, key: Sequence[str], workspace: Workspace, small: int = SMALL
) -> KeyCounts:
    nulls = [F.col(c).isNull() for c in key]
    some, every = F.greatest(*nulls, F.lit(False)), F.least(*nulls, F.lit(True))
    rows, null_rows, empty_rows = df.agg(
        F.count(F.lit(1)), F.count_if(some), F.count_if(every)
    ).first()
    filled = df.select(*key).where(~every)
    if rows > small:
        filled = _suspect_rows(filled, key, rows, workspace)
    groups = filled.groupBy(*key).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1")
    keys, repeated, shared = groups.agg(
        F.count_if(~some), F.sum(F.when(~some, F.col("__n"))), F.sum("__n")
    ).first()
    return KeyCounts(rows, null_rows, empty_rows, keys, repeated or 0, shared or 0)


def uniqueness_row(
    df: DataFrame, key: Sequence[str], workspace: Workspace, small: int = SMALL
) -> DataFrame:
    """One row, ``value``: what ``key_uniqueness`` gives, by ``key_counts``."""
    value = key_counts(df, key, workspace, small).uniqueness()
    one = workspace.spark.range(1, numPartitions=1)
    return one.select(F.lit(value).cast("double").alias("value"))


def _suspect_rows(
    df: DataFrame, key: Sequence[str], rows: int, workspace: Workspace
) -> DataFrame:
    bits = min(64, rows.bit_length() + _MORE_BITS)
    hashed = df.withColumn("__hash", _short_hash(key, bits))
    suspects = workspace.stage(
        seen_twice(hashed.select("__hash"), bits, rows).toDF("__hash"), "suspects"
    )
    marked = with_maybe(hashed, "__hash", suspects, suspects.count())
    return marked.where("__maybe").drop("__hash", "__maybe")


def _short_hash(key: Sequence[str], bits: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*key), 64 - bits)


def seen_twice(hashes: DataFrame, bits: int, rows: int) -> DataFrame:
    """(hash): the numbers of ``bits`` bits in a one-column frame that occur more than once."""
    low_bits = np.uint64(bits - min(bits, max(rows // PART, 1).bit_length()))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[np.ndarray] = []
        for batch in batches:
            column = batch.column(0).to_numpy().view(np.uint64)
            for at in range(0, len(column), CHUNK):
                waiting.append(column[at : at + CHUNK])
                if sum(map(len, waiting)) >= CHUNK:
                    yield _parts(np.concatenate(waiting), low_bits)
                    waiting.clear()
        if waiting:
            yield _parts(np.concatenate(waiting), low_bits)

    def compare(table: pa.Table) -> pa.Table:
        own = [unpacked(data) for data in table["once"].to_pylist()]
        twice = [unpacked(data) for data in table["twice"].to_pylist()]
        every = np.sort(np.concatenate(own))
        found = np.unique(np.concatenate([every[1:][every[1:] == every[:-1]], *twice]))
        return pa.table({"hash": pa.array(found.view(np.int64))})

    packs = hashes.mapInArrow(scan, "part bigint, once binary, twice binary")
    return packs.groupBy("part").applyInArrow(compare, "hash bigint")


def _parts(hashes: np.ndarray, low_bits: np.uint64) -> pa.RecordBatch:
    """The different hashes of each part, and those of them that are there repeatedly."""
    different, counts = np.unique(hashes, return_counts=True)
    repeated = counts > 1
    number = different >> low_bits
    heads = np.flatnonzero(np.concatenate([[True], number[1:] != number[:-1]]))
    once, twice = [], []
    for start, stop in zip(heads, np.append(heads[1:], len(different)), strict=True):
        own = different[start:stop]
        once.append(packed(own))
        twice.append(packed(own[repeated[start:stop]]))
    columns = [
        pa.array(number[heads].astype(np.int64)),
        pa.array(once, pa.binary()),
        pa.array(twice, pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["part", "once", "twice"])
