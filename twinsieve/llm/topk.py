"""Exact top-k search by distributed histogram selection.

Every query is scored against every candidate by the inner product of scaled integer vectors. The
k-th best score of a query is located by histograms of scores over all candidates: each round, all
tasks count the scores of their candidates in equal bins between the bounds still possible, the
counts are added up, and the bin with the k-th best score becomes the next bounds, until it holds
one score only. Then the candidates at or above that score are listed, and ties go to the smaller
id. A task lists only its own k best of them, which all of the k best are among, so a score shared
by a third of all rows costs k rows per task.

Queries and candidates meet in a grid: candidates are dealt to cells and queries to groups, both of
bounded size, and each pair of a cell and a group is one numpy product. Scores are recomputed each
round and never stored.

Vectors that are null or hold a null, NaN or infinite component take no part. Components become
floor(scale * x) and are kept within 64 bits; sums are those of 64-bit integers. Vectors of
different length are never compared. Rows that share the query's id are not its candidates; other
repeated rows are candidates of their own. Of several query rows with one id, the smallest vector is
asked for. A query with fewer than k candidates gets them all, one without any gets no row, and an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from twinsieve.sources.workspace import Workspace


@dataclass(frozen=True)
class TopKParams:
    """``cell`` and ``group`` are components of candidates or queries in one product."""

    k: int = 10
    scale: int = 1024
    bins: int = 1024
    cell: int = 1 << 21
    group: int = 1 << 21
    least_cells: int = 32


_STEP = 1024  # rows of queries in one product


def scaled(df: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """(id, dim, values) of the rows that take part; values are little-endian 64-bit integers."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            sizes = np.diff(column.offsets.to_numpy())
            flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
            whole = np.floor(scale * flat)
            limit = float(1 << 63)
            whole = np.where(whole >= limit, np.nextafter(limit, 0), np.maximum(whole, -limit))
            data = pa.py_buffer(whole.astype("<i8").tobytes())
            offsets = np.concatenate([[0], np.cumsum(sizes)]) * 8
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes.astype(np.int32)),
                    pa.Array.from_buffers(
                        pa.binary(),
                        len(sizes),
                        [None, pa.py_buffer(offsets.astype(np.int32).tobytes()), data],
                    ),
                ],
                names=["id", "dim", "values"],
            )

    bad = F.exists(
        F.col(vector), lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    )
    whole = F.col(vector).isNotNull() & F.col(key).isNotNull() & ~F.coalesce(bad, F.lit(True))
    rows = df.where(whole).select(F.col(key).cast("bigint"), F.col(vector).cast("array<double>"))
    return rows.mapInArrow(scan, "id bigint, dim int, values binary")


def _matrix(values: pa.ChunkedArray, dim: int) -> np.ndarray:
    data = b"".join(values.to_pylist())
    return np.frombuffer(data, "<i8").reshape(len(values), dim)


def _products(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Integer inner products; by way of floats where those are exact."""
    most = [float(np.abs(m.astype(float)).max(initial=0)) for m in (queries, candidates)]
    if most[0] * most[1] * queries.shape[1] < float(1 << 53):
        return (queries.astype(float) @ candidates.astype(float).T).astype(np.int64)
    return queries @ candidates.T


class Grid:
    """Candidates in cells against queries in groups."""

    def __init__(self, candidates: DataFrame, queries: DataFrame, params: TopKParams):
        size = candidates.agg(
            F.count(F.lit(1)).alias("n"), F.max("dim").alias("dim")
        ).first()
        asked = queries.count()
        dim = max(size["dim"] or 1, 1)
        self.params = params
        self.cells = max(-(-size["n"] * dim // params.cell), params.least_cells)
        self.groups = max(-(-asked * dim // params.group), 1)
        self.candidates = candidates.select(
            "id",
            "dim",
            "values",
            F.pmod(F.xxhash64("id"), F.lit(self.cells)).cast("int").alias("cell"),
            F.explode(F.sequence(F.lit(0), F.lit(self.groups - 1))).alias("grp"),
        )
        self.queries = queries

    def apply(self, function, schema: str, bounds: DataFrame) -> DataFrame:
        """``function(query table, query ids, scores, candidate ids)`` for each part of the grid."""
        asked = self.queries.join(bounds, "id").select(
            "*",
            F.pmod(F.xxhash64("id"), F.lit(self.groups)).cast("int").alias("grp"),
            F.explode(F.sequence(F.lit(0), F.lit(self.cells - 1))).alias("cell"),
        )

        def both(asked: pa.Table, given: pa.Table) -> pa.Table:
            out = [_empty(schema)]
            if asked.num_rows and given.num_rows:
                dim = asked["dim"][0].as_py()
                ids = given["id"].to_numpy()
                candidates = _matrix(given["values"], dim)
                for i in range(0, asked.num_rows, _STEP):
                    part = asked.slice(i, _STEP)
                    scores = _products(_matrix(part["values"], dim), candidates)
                    out.append(function(part, scores, ids))
            return pa.concat_tables(out)

        keys = ["dim", "grp", "cell"]
        return (
            asked.groupBy(*keys).cogroup(self.candidates.groupBy(*keys)).applyInArrow(both, schema)
        )


def _empty(schema: str) -> pa.Table:
    kinds = {"bigint": pa.int64(), "int": pa.int32()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.table({n: pa.array([], kinds[k]) for n, k in fields})


_COUNTS = "id bigint, bin bigint, n bigint"
_HITS = "query_id bigint, vec_id bigint, score bigint"


def _histogram(params: TopKParams):
    """Counts of scores by bin. Bins below a task's own k-th best cannot hold the k-th best."""

    def count(part: pa.Table, scores: np.ndarray, ids: np.ndarray) -> pa.Table:
        out: list[list[np.ndarray]] = [[], [], []]
        names = ("id", "low", "width")
        for row, (query, low, width) in enumerate(
            zip(*(part[n].to_pylist() for n in names), strict=True)
        ):
            found = scores[row][ids != query]
            # As unsigned numbers, differences of 64-bit integers do not overflow.
            above = (found[found >= low] - low).view(np.uint64) // np.uint64(width)
            bins = np.minimum(above, np.uint64(params.bins)).astype(np.int64)
            bin_ids, counts = np.unique(bins, return_counts=True)
            better = np.cumsum(counts[::-1])[::-1] - counts
            kept = better < params.k
            out[0].append(np.full(kept.sum(), query))
            out[1].append(bin_ids[kept])
            out[2].append(counts[kept])
        columns = [np.concatenate(c).astype(np.int64) for c in out]
        return pa.table(dict(zip(("id", "bin", "n"), columns, strict=True)))

    return count


def _hits(params: TopKParams):
    def list_hits(part: pa.Table, scores: np.ndarray, ids: np.ndarray) -> pa.Table:
        out: list[list[np.ndarray]] = [[], [], []]
        for row, (query, low) in enumerate(
            zip(part["id"].to_pylist(), part["low"].to_pylist(), strict=True)
        ):
            at = np.flatnonzero((scores[row] >= low) & (ids != query))
            at = at[np.lexsort((ids[at], -scores[row][at]))[: params.k]]
            out[0].append(np.full(len(at), query))
            out[1].append(ids[at])
            out[2].append(scores[row][at])
        columns = [np.concatenate(c).astype(np.int64) for c in out]
        return pa.table(dict(zip(("query_id", "vec_id", "score"), columns, strict=True)))

    return list_hits


def _start(queries: DataFrame, candidates: DataFrame, params: TopKParams) -> DataFrame:
    """(id, low, width, done): bins over all scores that a query can have.

    No score exceeds the product of the lengths; lengths are rounded up.
    """
    longest = candidates.groupBy("dim").agg(F.max("length").alias("longest"))
    most = F.ceil(F.col("length") * F.col("longest") * 1.000001) + 1
    # Sums that leave 64 bits wrap around, so then every score is possible.
    wide = F.col("length") * F.col("longest") >= float(1 << 61)
    low = F.when(wide, F.lit(-(1 << 63))).otherwise(-most.cast("bigint"))
    span = F.when(wide, F.lit((1 << 63) // (params.bins // 2))).otherwise(
        F.floor(2 * most / params.bins).cast("bigint") + 1
    )
    return queries.join(longest, "dim").select(
        "id", low.alias("low"), span.alias("width"), F.lit(False).alias("done")
    )


def _narrowed(bounds: DataFrame, counts: DataFrame, params: TopKParams) -> DataFrame:
    """Bounds at the bin that holds the k-th best score, or from its start if that is enough."""
    above = (
        Window.partitionBy("id")
        .orderBy(F.col("bin").desc())
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    kth = (
        counts.groupBy("id", "bin")
        .agg(F.sum("n").alias("n"))
        .withColumn("upto", F.sum("n").over(above))
        .groupBy("id")
        .agg(
            F.max(F.when(F.col("upto") >= params.k, F.col("bin"))).alias("bin"),
            F.min("bin").alias("lowest"),
        )
    )
    # With fewer than k candidates every score is wanted.
    bin_, low, width = (
        c.cast("decimal(20,0)") for c in (F.coalesce("bin", "lowest"), F.col("low"), F.col("width"))
    )
    low = (low + bin_ * width).cast("bigint")
    next_width = F.floor((F.col("width") - 1) / params.bins) + 1
    return bounds.join(kth, "id").select(
        "id",
        F.when(F.col("done"), F.col("low")).otherwise(low).alias("low"),
        next_width.cast("bigint").alias("width"),
        (F.col("width") == 1).alias("done"),
    )


def top_k(
    df: DataFrame,
    is_query: Column,
    workspace: Workspace,
    key: str = "vec_id",
    vector: str = "embedding",
    params: TopKParams = TopKParams(),
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best candidates of each row for which ``is_query``."""
    rows = workspace.stage(scaled(df, key, vector, params.scale), "vectors")
    lengths = rows.mapInArrow(_with_length, "id bigint, dim int, values binary, length double")
    candidates = workspace.stage(lengths, "candidates")
    queries = candidates.where(is_query).groupBy("id").agg(
        F.min(F.struct("dim", "values", "length")).alias("v")
    )
    queries = workspace.stage(queries.select("id", "v.*"), "queries")
    grid = Grid(candidates.drop("length"), queries.drop("length"), params)
    bounds = workspace.stage(_start(queries, candidates, params), "bounds")
    while not bounds.where("NOT done").isEmpty():
        counts = grid.apply(_histogram(params), _COUNTS, bounds)
        bounds = workspace.stage(_narrowed(bounds, counts, params), "bounds")
    hits = grid.apply(_hits(params), _HITS, bounds)
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        hits.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= params.k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _with_length(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lengths = [
            float(np.sqrt((np.frombuffer(v, "<i8").astype(float) ** 2).sum()))
            for v in batch.column(2).to_pylist()
        ]
        yield batch.append_column("length", pa.array(lengths, pa.float64()))
