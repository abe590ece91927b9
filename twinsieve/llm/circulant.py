"""Near-duplicates by circulant MinHash, banding and exact Jaccard similarity.

A document's set holds its distinct shingles of five words, with A to Z in lower case; words are
runs of bytes other than space and U+0009 to U+000D. Fewer words make one shingle of all of them.
Shingles are 64-bit hashes. The signature comes from two permutations of 2^22 places: the first one
moves each shingle, the second one is shifted by one place for each coordinate, so a coordinate is
the smallest value in the shifted permutation over the moved shingles.

1. One scan gives each text its set size, a digest of the set, band keys and a byte per coordinate.
   Texts with equal sets become a class, named by its smallest id.
2. Classes that share a band are a bucket, each paired with the smallest class of the bucket. Pairs
   that agree in far fewer coordinates than linked sets do are left out; the others are checked on
   full sets, recomputed for the classes in such a pair only. Links make components.
3. Where a bucket still holds several components, its members get a longer signature, and members
   of different components are compared with each other, in blocks of bounded size. What agrees in
   enough coordinates is checked on full sets. So all pairs that share a bucket are linked or known
   not to be, and a large group costs its size, not its square, where it is one component.

"Far fewer" is six standard deviations below what sets at the limit agree in. With 32 bands of five
coordinates, sets of similarity 0.85 share no band in 1 of 10^8 cases, and those of 0.8 in 3 of 10^6.

Defined results: null or empty texts, and texts of white space, have an empty set and are alone.
Rows with the same id are one node. Rows without an id are linked with nothing and kept. Very long
texts are read in stretches. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from twinsieve.llm.text import blocks, column_bytes, mixed, word_hashes
from twinsieve.operators.components import connected_components
from twinsieve.operators.key_filter import with_maybe
from twinsieve.sources.workspace import Workspace

PLACES = 1 << 22
MOST_COORDINATES = 1 << 12
# Rows of one block when the members of a bucket are compared with each other.
BLOCK = 2048


@dataclass(frozen=True)
class NearParams:
    """Sets are linked if 100 * shared >= percent * union. ``fine`` is the length of the longer
    signature, for members of buckets with several components."""

    percent: int = 85
    words: int = 5
    bands: int = 32
    rows: int = 5
    fine: int = 2048
    seed: int = 20

    @property
    def coordinates(self) -> int:
        return self.bands * self.rows

    def floor(self, coordinates: int) -> float:
        """The least share of equal coordinates of a pair that is checked on full sets."""
        p = self.percent / 100
        return p - 6 * (p * (1 - p) / coordinates) ** 0.5


_SIGNED = "id bigint, n_shingles bigint, digest binary, buckets array<bigint>, bytes binary"
_FULL = "id bigint, n_shingles bigint, shingles array<bigint>, bytes binary"


def shingles(hashes: np.ndarray, words: int) -> np.ndarray:
    """Hashes of the distinct windows of ``words`` word hashes, ascending."""
    if not len(hashes):
        return hashes
    size = min(words, len(hashes))
    out = np.full(len(hashes) - size + 1, size, np.uint64)
    for i in range(size):
        out = mixed(out + hashes[i : len(hashes) - size + 1 + i], 0x9E3779B97F4A7C15)
    out.sort()
    return out[np.concatenate([[True], out[1:] != out[:-1]])]


@lru_cache(maxsize=1)
def _permutations(seed: int) -> tuple[np.ndarray, np.ndarray]:
    """The first permutation, and the second one with its end repeated before its start."""
    random = np.random.default_rng(seed)
    first = random.permutation(PLACES).astype(np.int32)
    second = random.permutation(PLACES).astype(np.int32)
    return first, np.concatenate([second[-MOST_COORDINATES:], second])


def signature(found: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Coordinate i < k: the smallest second[(first[x] - i) mod places] over the shingles x."""
    first, second = _permutations(seed)
    shifted = np.lib.stride_tricks.sliding_window_view(second[MOST_COORDINATES - k :], k)
    starts = first[(found & np.uint64(PLACES - 1)).astype(np.int64)] + 1
    least = np.full(k, PLACES, np.int32)
    step = max(1, (1 << 18) // k)
    for i in range(0, len(starts), step):
        np.minimum(least, shifted[starts[i : i + step]].min(axis=0), out=least)
    return least[::-1]


def _band_keys(values: np.ndarray, params: NearParams) -> np.ndarray:
    """A 64-bit key for each band, made of its number and its coordinates."""
    parts = values.astype(np.uint64).reshape(params.bands, params.rows)
    keys = np.arange(1, params.bands + 1, dtype=np.uint64)
    for i in range(params.rows):
        keys = mixed(keys * np.uint64(31) + parts[:, i], 0x2545F4914F6CDD1D)
    return keys.view(np.int64)


def _sets_of(batch: pa.RecordBatch, params: NearParams) -> Iterator[np.ndarray]:
    data, bounds = column_bytes(batch.column(1))
    for begin, end in blocks(bounds):
        part = bounds[begin : end + 1] - bounds[begin]
        hashes, ends = word_hashes(data[bounds[begin] : bounds[end]], part)
        for i in range(end - begin):
            yield shingles(hashes[ends[i] : ends[i + 1]], params.words)


def signed(df: DataFrame, key: str, text: str, params: NearParams) -> DataFrame:
    """(id, n_shingles, digest, buckets, bytes) of each row; the last three are null without words."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, bands, low = [], [], [], []
            for found in _sets_of(batch, params):
                sizes.append(len(found))
                if not len(found):
                    digests.append(None), bands.append(None), low.append(None)
                    continue
                values = signature(found, params.coordinates, params.seed)
                sums = [mixed(found, salt).sum(dtype=np.uint64) for salt in (1, 2)]
                digests.append(np.array(sums, np.uint64).tobytes())
                bands.append(_band_keys(values, params))
                low.append(values.astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).cast(pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array(bands, pa.list_(pa.int64())),
                    pa.array(low, pa.binary()),
                ],
                names=["id", "n_shingles", "digest", "buckets", "bytes"],
            )

    return df.select(F.col(key).cast("bigint"), F.col(text)).mapInArrow(scan, _SIGNED)


def full_sets(
    df: DataFrame, key: str, text: str, ids: DataFrame, params: NearParams, fine: bool = False
) -> DataFrame:
    """(id, n_shingles, shingles, bytes) of the rows whose id may be one of the staged ``ids``;
    ``bytes`` is the longer signature, or null if it is not asked for."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(_sets_of(batch, params))
            low = [
                signature(x, params.fine, params.seed).astype(np.uint8).tobytes() if fine else None
                for x in found
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(x) for x in found], pa.int64()),
                    pa.array([x.view(np.int64) for x in found], pa.list_(pa.int64())),
                    pa.array(low, pa.binary()),
                ],
                names=["id", "n_shingles", "shingles", "bytes"],
            )

    texts = df.select(F.col(key).cast("bigint").alias("id"), F.col(text).alias("text"))
    marked = with_maybe(texts, "id", ids, ids.count())
    return marked.where("__maybe").select("id", "text").mapInArrow(scan, _FULL)


def _close_sizes(a: Column, b: Column, params: NearParams) -> Column:
    return 100 * F.least(a, b) >= params.percent * F.greatest(a, b)


def _linked(pairs: DataFrame, sets: DataFrame, params: NearParams) -> DataFrame:
    """The pairs (src, dst) whose full sets are similar enough."""
    left = sets.select(F.col("id").alias("src"), F.col("shingles").alias("__a"))
    right = sets.select(F.col("id").alias("dst"), F.col("shingles").alias("__b"))
    both = pairs.join(left, "src").join(right, "dst")
    shared = F.size(F.array_intersect("__a", "__b"))
    total = F.size("__a") + F.size("__b")
    return both.where(100 * shared >= params.percent * (total - shared)).select("src", "dst")


def _shared_buckets(classes: DataFrame) -> DataFrame:
    """(bucket, id, low, n): the members of the buckets with several, and the smallest of them."""
    members = classes.select("id", F.explode("buckets").alias("bucket"))
    several = (
        members.groupBy("bucket")
        .agg(F.min("id").alias("low"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
    )
    return members.join(several, "bucket")


def _star_pairs(shared: DataFrame, classes: DataFrame, params: NearParams) -> DataFrame:
    """(src, dst): each class and the smallest one of a bucket it is in, if their signatures and
    sizes may be those of linked sets."""
    pairs = shared.where("id > low").select(F.col("id").alias("src"), F.col("low").alias("dst"))
    parts = ["n_shingles", "bytes"]
    left = classes.select(F.col("id").alias("src"), *[F.col(c).alias(f"{c}_a") for c in parts])
    right = classes.select(F.col("id").alias("dst"), *[F.col(c).alias(f"{c}_b") for c in parts])
    both = pairs.distinct().join(left, "src").join(right, "dst")
    both = both.where(_close_sizes(F.col("n_shingles_a"), F.col("n_shingles_b"), params))
    floor = params.floor(params.coordinates)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = (_bytes_matrix(batch.column(i)) for i in (2, 3))
                near = pa.array((a == b).mean(axis=1) >= floor)
                yield batch.select(["src", "dst"]).filter(near)

    return both.select("src", "dst", "bytes_a", "bytes_b").mapInArrow(
        compare, "src bigint, dst bigint"
    )


def _bytes_matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)


def _open_members(shared: DataFrame, found: DataFrame) -> DataFrame:
    """(bucket, id, component, blocks): members of the buckets that hold several components.

    In a bucket of two the pair has been checked.
    """
    labelled = shared.where("n > 2").join(found, "id", "left").select(
        "bucket", "id", F.coalesce("component", "id").alias("component")
    )
    several = (
        labelled.groupBy("bucket")
        .agg(
            F.min("component").alias("least"),
            F.max("component").alias("most"),
            F.count(F.lit(1)).alias("n"),
        )
        .where("least < most")
        .select("bucket", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    )
    return labelled.join(several, "bucket")


def _cross_pairs(members: DataFrame, sets: DataFrame, params: NearParams) -> DataFrame:
    """Pairs of a bucket in different components whose longer signatures may be those of linked
    sets. Members are dealt to blocks; each two blocks are a group, compared in numpy."""
    block = F.pmod(F.xxhash64("id"), "blocks").cast("int")
    others = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    dealt = members.withColumn("block", block).select("*", others)
    signatures = sets.select("id", "n_shingles", "bytes")
    cells = dealt.join(signatures, "id").select(
        "bucket",
        F.least("block", "other").alias("i"),
        F.greatest("block", "other").alias("j"),
        "id",
        "n_shingles",
        "component",
        "block",
        "bytes",
    )
    floor, percent = params.floor(params.fine), params.percent

    def compare(table: pa.Table) -> pa.Table:
        ids, sizes, labels, blocks_of = (
            table[c].to_numpy() for c in ("id", "n_shingles", "component", "block")
        )
        values = _bytes_matrix(table["bytes"])
        across = table["i"][0].as_py() != table["j"][0].as_py()
        out = [np.empty((2, 0), np.int64)]
        for at in range(len(ids)):
            apart = (labels != labels[at]) & (ids < ids[at])
            if across:
                apart &= blocks_of != blocks_of[at]
            apart &= 100 * np.minimum(sizes, sizes[at]) >= percent * np.maximum(sizes, sizes[at])
            near = np.flatnonzero(apart)
            if len(near):
                near = near[(values[near] == values[at]).mean(axis=1) >= floor]
                out.append(np.stack([np.full(len(near), ids[at]), ids[near]]))
        pairs = np.concatenate(out, axis=1)
        return pa.table({"src": pairs[0], "dst": pairs[1]})

    grouped = cells.groupBy("bucket", "i", "j")
    return grouped.applyInArrow(compare, "src bigint, dst bigint").distinct()


def components(
    df: DataFrame,
    workspace: Workspace,
    key: str = "doc_id",
    text: str = "text",
    params: NearParams = NearParams(),
) -> DataFrame:
    """(key, n_shingles, component_id, kept) of each row."""
    rows = workspace.stage(signed(df, key, text, params), "signed")
    classes = workspace.stage(
        rows.where("digest IS NOT NULL AND id IS NOT NULL")
        .groupBy("digest", "n_shingles")
        .agg(
            F.min("id").alias("id"),
            F.first("buckets").alias("buckets"),
            F.first("bytes").alias("bytes"),
        ),
        "classes",
    )
    named = classes.select("digest", "n_shingles", F.col("id").alias("class"))
    placed = rows.select("id", "n_shingles", "digest").join(named, ["digest", "n_shingles"], "left")
    placed = workspace.stage(placed.drop("digest"), "placed")
    shared = workspace.stage(_shared_buckets(classes), "shared-buckets")
    pairs = workspace.stage(_star_pairs(shared, classes, params), "pairs")
    ids = workspace.stage(_ends(pairs), "pair-ids")
    # Rows that share an id may have several sets; a pair is linked if one of them is similar.
    sets = workspace.stage(full_sets(df, key, text, ids, params), "sets")
    links = _linked(pairs, sets, params).unionByName(_shared_ids(placed))
    links = workspace.stage(links.distinct(), "links")
    found = _labels(links, workspace)
    members = workspace.stage(_open_members(shared, found), "open-members")
    if not members.isEmpty():
        ids = workspace.stage(members.select("id").distinct(), "open-ids")
        sets = workspace.stage(full_sets(df, key, text, ids, params, fine=True), "open-sets")
        pairs = workspace.stage(_cross_pairs(members, sets, params), "cross-pairs")
        more = workspace.stage(_linked(pairs, sets, params), "cross-links")
        found = _labels(links.unionByName(more).distinct(), workspace)
    found = found.select(F.col("id").alias("class"), "component")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "class", "id"))
    return placed.join(found, "class", "left").select(
        F.col("id").alias(key),
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("src", "dst")).alias("id")).distinct()


def _shared_ids(placed: DataFrame) -> DataFrame:
    """Links between the classes of rows that share an id."""
    several = (
        placed.groupBy("id")
        .agg(F.min("class").alias("dst"), F.max("class").alias("high"))
        .where("dst < high")
    )
    return (
        placed.join(several.select("id", "dst"), "id")
        .where("class > dst")
        .select(F.col("class").alias("src"), "dst")
    )


def _labels(links: DataFrame, workspace: Workspace) -> DataFrame:
    return workspace.stage(connected_components(links, workspace), "components")
