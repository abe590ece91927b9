"""Profiles that can be added up: states of parts of a table, kept, and merged without its rows.

A state is a few rows: the number of rows, for each measured column the number of values, their sum,
minimum and maximum, and for the key, by range of its hash, the hashes that occur once and those that
occur more often. The last are sorted and kept as the steps between them, some three to six bytes a
key. Merging adds, takes the least and the greatest, and moves a hash that two states hold to those
that occur more often. Keys are told apart by 64 bits of hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from twinsieve.functions.packing import packed, unpacked
from twinsieve.operators.profile import ProfileSpec, numbered_rows

# Ranges of hashes; a power of two, and the same for all states that are to be merged. One range of one
# state is one binary value and one group of a merge, so it should have some million keys at most.
RANGES = 1 << 12
# Hashes that a task sorts together.
_CHUNK = 1 << 20
STATE = (
    "kind string, name string, n bigint, total double, low double, high double, "
    "part bigint, once binary, more binary"
)
_NAMES = [field.split(" ")[0] for field in STATE.split(", ")]


def _row(kind: str, name: str, n: Column, *numbers: Column) -> Column:
    values = [*numbers, *[F.lit(None)] * (3 - len(numbers))]
    fields = [F.lit(kind), F.lit(name), n, *[v.cast("double") for v in values]]
    rest = [F.lit(None).cast(t) for t in ("bigint", "binary", "binary")]
    return F.struct(*[f.alias(c) for f, c in zip([*fields, *rest], _NAMES, strict=True)])


def profile_state(df: DataFrame, spec: ProfileSpec, ranges: int = RANGES) -> DataFrame:
    """The state of a table, or of a part of one."""
    rows = [
        _row("rows", "", F.count(F.lit(1))),
        _row("schema", df.schema.json(), F.count(F.lit(None))),
    ]
    for name in spec.complete:
        if name in df.columns:
            rows.append(_row("filled", name, F.count(name)))
    for name in spec.numeric:
        if name in df.columns:
            value = F.col(name).cast("double")
            measures = F.count(value), F.sum(value), F.min(value), F.max(value)
            rows.append(_row("number", name, *measures))
    state = df.agg(F.array(*rows).alias("s")).select(F.inline("s"))
    key = list(spec.unique_key)
    if key and set(key) <= set(df.columns):
        state = state.unionByName(_key_state(df, key, ranges))
    return state


def _key_state(df: DataFrame, key: list[str], ranges: int) -> DataFrame:
    """Tasks sort and combine their own hashes first, so a frequent key is two entries of each."""
    low_bits = np.uint64(64 - (ranges.bit_length() - 1))
    if ranges & (ranges - 1) or not ranges:
        raise ValueError(f"{ranges} is no power of two")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[np.ndarray] = []
        for batch in batches:
            waiting.append(batch.column(0).to_numpy().view(np.uint64))
            if sum(map(len, waiting)) >= _CHUNK:
                yield _ranges(np.concatenate(waiting), low_bits)
                waiting.clear()
        if waiting:
            yield _ranges(np.concatenate(waiting), low_bits)

    every = F.least(*[F.col(c).isNull() for c in key], F.lit(True))
    found = df.where(~every).select(F.xxhash64(*key)).mapInArrow(
        scan, "part bigint, once binary, more binary"
    )
    name = ",".join(key)
    return _merged_keys(found.withColumns({"kind": F.lit("key"), "name": F.lit(name)}))


def _ranges(hashes: np.ndarray, low_bits: np.uint64) -> pa.RecordBatch:
    different, counts = np.unique(hashes, return_counts=True)
    number = different >> low_bits if low_bits < 64 else np.zeros(len(different), np.uint64)
    heads = np.flatnonzero(np.concatenate([[True], number[1:] != number[:-1]]))
    parts, once, more = [], [], []
    for start, stop in zip(heads, np.append(heads[1:], len(different)), strict=True):
        own, single = different[start:stop], counts[start:stop] == 1
        parts.append(int(number[start]))
        once.append(packed(own[single]))
        more.append(packed(own[~single]))
    return pa.RecordBatch.from_arrays(
        [pa.array(parts, pa.int64()), pa.array(once, pa.binary()), pa.array(more, pa.binary())],
        names=["part", "once", "more"],
    )


def _merged_keys(states: DataFrame) -> DataFrame:
    def combine(table: pa.Table) -> pa.Table:
        single = np.sort(np.concatenate([unpacked(d) for d in table["once"].to_pylist()]))
        often = np.concatenate([unpacked(d) for d in table["more"].to_pylist()])
        again = single[1:][single[1:] == single[:-1]]
        often = np.unique(np.concatenate([often, again]))
        left = np.setdiff1d(single, often, assume_unique=False)
        row = {c: [table[c][0].as_py()] for c in ("kind", "name", "part")}
        row |= {"n": [len(left)], "once": [packed(left)], "more": [packed(often)]}
        return pa.table(
            {c: pa.array(row.get(c, [None]), t) for c, t in zip(_NAMES, _ARROW, strict=True)}
        )

    parts = states.select("kind", "name", "part", "once", "more")
    return parts.groupBy("kind", "name", "part").applyInArrow(combine, STATE)


_ARROW = [
    *[pa.string()] * 2,
    pa.int64(),
    *[pa.float64()] * 3,
    pa.int64(),
    *[pa.binary()] * 2,
]


def merged(states: DataFrame) -> DataFrame:
    """One state of any number of them, such as those read from where they were kept."""
    plain = states.where("kind <> 'key'").groupBy("kind", "name").agg(
        F.sum("n").alias("n"),
        F.sum("total").alias("total"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
    )
    kinds = {"part": "bigint", "once": "binary", "more": "binary"}
    rest = {c: F.lit(None).cast(t) for c, t in kinds.items()}
    return plain.withColumns(rest).unionByName(_merged_keys(states.where("kind = 'key'")))


def profile_of(state: DataFrame, spec: ProfileSpec) -> DataFrame:
    """The rows that ``profile`` gives for the table, from its state alone.

    States of tables with different schemas have no common one; the schema row is then left out.
    """
    def kind(name: str) -> Column:
        return F.col("kind") == name

    def pick(what: str, name: str, column: str) -> Column:
        return F.max(F.when(kind(what) & (F.col("name") == name), F.col(column)))

    rows = F.max(F.when(kind("rows"), F.col("n")))
    metrics = [("Dataset", "*", "Size", rows)]
    for name in spec.complete:
        share = F.try_divide(pick("filled", name, "n"), rows)
        metrics.append(("Column", name, "Completeness", share))
    for name in spec.numeric:
        mean = F.try_divide(pick("number", name, "total"), pick("number", name, "n"))
        metrics.append(("Column", name, "Mean", mean))
        metrics.append(("Column", name, "Maximum", pick("number", name, "high")))
        metrics.append(("Column", name, "Minimum", pick("number", name, "low")))
    if spec.unique_key:
        key = ",".join(spec.unique_key)
        is_key = kind("key") & (F.col("name") == key)
        single = F.coalesce(F.sum(F.when(is_key, F.col("n"))), F.lit(0))
        metrics.append(("Multicolumn", key, "Uniqueness", F.try_divide(single, rows)))
    schema = F.when(F.count_if(kind("schema")) == 1, F.max(F.when(kind("schema"), F.col("name"))))
    return numbered_rows(state, [(*m[:3], m[3].cast("double")) for m in metrics], schema)
