"""Toxicity: Kneser-Ney word-pair models of toxic and of ordinary texts.

Words are runs of ASCII letters and digits and of other non-ASCII bytes, A to Z in lower case, and
enter by a 64-bit hash. Counts are of training texts: a text counts a pair once, and texts that are
equal count once. For class c, word w after v, and discount D,

    p_c(w | v) = max(n_c(v, w) - D, 0) / n_c(v) + g(v) * p_c(w)
    p_c(w)     = max(n_c(w) - D, 0) / n_c + g * p(w)
    p(w)       = different words before w / different pairs

where p, g(v) = D * different words after v / n(v) and g are counted over both classes. What a class
has hardly seen thus falls back on counts that both classes share, with the same weight. The log
ratios of the two chances are then shrunk by their evidence, e = (t / (t + ``evidence``))^2 for the
log-likelihood ratio test t of the class counts:

    r(w)    = e(w) * log(p_1(w) / p_0(w))
    r(v, w) = e(v, w) * log(p_1(w | v) / p_0(w | v)) + (1 - e(v, w)) * r(w)

so that a rare word or pair says little and not nothing, and a pair without evidence says what its
word says. Unshrunk, the chance differences of hundreds of rare words outweigh a few telling ones.

A text's score comes from the sum of its r, with each different pair taken once, divided by its
length and by the root of its length, through a logistic curve. The curve is fitted on the training
rows, each half scored by a model of the other half.

The models are fitted on at most ``rows`` labelled rows per class (those with the smallest hash of
the id), so what they count is bounded. Words and pairs below ``least_test`` weigh less than
(least_test / evidence)^2 of their ratio and are left out; of more than ``entries`` words or pairs,
those with the most evidence are broadcast. All texts are scored, and whole.

Defined results: null and empty texts are scored as texts without words. A label that is null or
belongs to no document takes no part; a document with several labels counts once for each. Rows are
scored each for itself. If a class has no training row, every score is 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from twinsieve.llm.text import LOWER, WORD_BYTES, blocks, column_bytes, mixed, word_hashes
from twinsieve.sources.workspace import Workspace

START = np.uint64(1)


@dataclass(frozen=True)
class ToxicityParams:
    rows: int = 10_000
    entries: int = 1 << 18
    least_test: float = 1.0
    evidence: float = 25.0
    discount: float = 0.75
    threshold: float = 0.7


@dataclass(frozen=True)
class Ratios:
    """Shrunk log ratios of words and pairs, by ascending hash."""

    words: np.ndarray
    word_ratio: np.ndarray
    pairs: np.ndarray
    pair_ratio: np.ndarray

    def features(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Per text: the summed ratio over the length, and over the root of the length."""
        parts = [
            self._features(data[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i])
            for i, j in blocks(bounds)
        ]
        return np.concatenate([np.empty((0, 2)), *parts])

    def _features(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        now, ends = word_hashes(data, bounds, WORD_BYTES, LOWER)
        pair = _pair(_before(now, ends), now)
        ratio = _found(self.words, self.word_ratio, now, 0.0)
        ratio = _found(self.pairs, self.pair_ratio, pair, ratio)
        telling = np.flatnonzero(ratio)
        text = np.searchsorted(ends, telling, side="right") - 1
        once = _first_of_each(text, pair[telling])
        sums = np.bincount(text[once], ratio[telling[once]], minlength=len(ends) - 1)
        sizes = np.maximum(np.diff(ends), 1)
        # The curve flattens where the class is plain: a few such texts shall not set the scale.
        return np.stack([np.arctan(sums / sizes / 0.2), np.arctan(sums / np.sqrt(sizes))], axis=1)


@dataclass(frozen=True)
class Model:
    ratios: Ratios
    weights: np.ndarray

    def score(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        features = self.ratios.features(data, bounds)
        return 1 / (1 + np.exp(-np.clip(_with_one(features) @ self.weights, -30, 30)))


def _before(now: np.ndarray, ends: np.ndarray) -> np.ndarray:
    before = np.empty_like(now)
    before[1:] = now[:-1]
    starts = ends[:-1]
    before[starts[starts < len(now)]] = START
    return before


def _pair(before: np.ndarray, now: np.ndarray) -> np.ndarray:
    return mixed(before * np.uint64(0x9E3779B97F4A7C15) + now)


def _found(
    keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, other: np.ndarray | float
) -> np.ndarray:
    if not len(keys):
        return np.broadcast_to(other, wanted.shape).astype(float)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], other)


def _with_one(features: np.ndarray) -> np.ndarray:
    return np.concatenate([features, np.ones((len(features), 1))], axis=1)


def held_out(key: Column) -> Column:
    """Rows that no label is learned from: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.pmod(F.crc32(key.cast("string")), F.lit(3)) == 1, F.lit(False))


def training_rows(
    df: DataFrame, labels: DataFrame, key: str, text: str, label: str, params: ToxicityParams
) -> DataFrame:
    """(text, toxic, copy, half) of a bounded number of labelled rows of each class."""
    known = labels.select(F.col(key).alias("__id"), F.col(label).alias("toxic")).where(
        F.col("toxic").isin(0, 1) & F.col("__id").isNotNull() & ~held_out(F.col("__id"))
    )
    place = F.xxhash64("__id")
    chosen = [
        known.where(F.col("toxic") == c).orderBy(place, "__id").limit(params.rows) for c in (0, 1)
    ]
    ids = chosen[0].unionByName(chosen[1])
    texts = df.select(F.col(key).alias("__key"), F.col(text).cast("string").alias("text"))
    copy = F.xxhash64("text")
    return texts.join(F.broadcast(ids), F.col("__key") == F.col("__id")).select(
        "text",
        F.col("toxic").cast("int").alias("toxic"),
        copy.alias("copy"),
        F.pmod(copy, F.lit(2)).cast("int").alias("half"),
    )


_GROUPS = ["n00", "n01", "n10", "n11"]  # ordinary and toxic, first and second half


def _first_of_each(text: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Places of the first row of each different (text, key), by text and key."""
    order = np.lexsort((keys, text))
    text, keys = text[order], keys[order]
    new = np.ones(len(order), bool)
    new[1:] = (text[1:] != text[:-1]) | (keys[1:] != keys[:-1])
    return order[new]


def _block_counts(
    data: np.ndarray, bounds: np.ndarray, group: np.ndarray, pairs: bool
) -> pa.RecordBatch:
    now, ends = word_hashes(data, bounds, WORD_BYTES, LOWER)
    before = _before(now, ends) if pairs else np.zeros_like(now)
    key = _pair(before, now)
    text = np.repeat(np.arange(len(group)), np.diff(ends))
    once = _first_of_each(text, key)
    once = once[np.argsort(key[once], kind="stable")]
    keys, groups = key[once], group[text[once]]
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    at = np.cumsum(new) - 1
    size = int(new.sum())
    counts = [np.bincount(at[groups == g], minlength=size).astype(np.int64) for g in range(4)]
    first = once[new]
    columns = [before[first].view(np.int64), now[first].view(np.int64), *counts]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["v", "w", *_GROUPS])


def _counted(rows: DataFrame, pairs: bool) -> DataFrame:
    """(v, w) of the different pairs, or (v = 0, w) of the different words, with the number of
    texts of each class and half."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = column_bytes(batch.column(0))
            group = 2 * batch.column(1).to_numpy() + batch.column(2).to_numpy()
            for i, j in blocks(bounds):
                part = data[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i]
                yield _block_counts(*part, group[i:j], pairs)

    schema = "v bigint, w bigint, " + ", ".join(f"{g} bigint" for g in _GROUPS)
    found = rows.select("text", "toxic", "half").mapInArrow(scan, schema)
    return found.groupBy("v", "w").agg(*[F.sum(g).alias(g) for g in _GROUPS])


def _test(texts: list[int]) -> Column:
    """The log-likelihood ratio test for a share of texts that differs between the classes."""
    ordinary, toxic = F.col("n00") + F.col("n01"), F.col("n10") + F.col("n11")
    total = sum(texts)

    def part(count: Column, size: int) -> Column:
        expected = (ordinary + toxic) * F.lit(size / total)
        return F.when(count > 0, count * F.log(count / expected)).otherwise(0.0)

    return 2 * (part(ordinary, texts[0]) + part(toxic, texts[1]))


def _telling(table: DataFrame, texts: list[int], params: ToxicityParams) -> dict:
    """The rows with evidence, those with the most first, as arrays."""
    test = _test(texts)
    kept = table.where(test >= params.least_test).orderBy(test.desc(), "v", "w")
    found = kept.limit(params.entries).toArrow()
    return {n: c.to_numpy() for n, c in zip(found.column_names, found.columns, strict=True)}


def fit(
    df: DataFrame,
    labels: DataFrame,
    workspace: Workspace,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    params: ToxicityParams = ToxicityParams(),
) -> Model | None:
    """The model, or None if a class has no training row."""
    rows = training_rows(df, labels, key, text, label, params)
    rows = workspace.stage(rows.dropDuplicates(["copy", "toxic"]), "labelled")
    by_group = rows.groupBy("toxic", "half").count().collect()
    texts = {(r["toxic"], r["half"]): r["count"] for r in by_group}
    if len({c for c, _ in texts}) < 2:
        return None
    sizes = [sum(n for (c, _), n in texts.items() if c == k) for k in (0, 1)]
    pairs = workspace.stage(_counted(rows, True), "pair-counts")
    lefts = F.count(F.lit(1)).alias("lefts")
    words = _counted(rows, False).join(pairs.groupBy("w").agg(lefts), "w", "left")
    words = workspace.stage(words, "word-counts")
    rights = F.count(F.lit(1)).alias("rights")
    befores = pairs.groupBy("v").agg(*[F.sum(g).alias(f"v{g}") for g in _GROUPS], rights)
    afters = words.select("w", "lefts", *[F.col(g).alias(f"w{g}") for g in _GROUPS])
    telling_pairs = pairs.where(_test(sizes) >= params.least_test)
    total = words.agg(
        *[F.sum(g).alias(g) for g in _GROUPS],
        F.sum("lefts").alias("lefts"),
        F.count(F.lit(1)).alias("kinds"),
    )
    found = (
        _telling(words, sizes, params),
        _telling(telling_pairs.join(befores, "v").join(afters, "w"), sizes, params),
        {name: max(value or 0, 1) for name, value in total.first().asDict().items()},
        texts,
    )
    halves = [_ratios(*found, params, [half]) for half in (0, 1)]
    return Model(_ratios(*found, params, [0, 1]), _curve(rows, halves))


def _of(table: dict, name: str, c: int, halves: list[int]) -> np.ndarray:
    return sum(np.asarray(table[f"{name}{c}{h}"], float) for h in halves)


def _ratios(
    words: dict, pairs: dict, totals: dict, texts: dict, params: ToxicityParams, halves: list[int]
) -> Ratios:
    """The shrunk log ratios of a model of the given halves."""
    sizes = [sum(texts.get((c, h), 0) for h in halves) for c in (0, 1)]
    discount = params.discount
    whole = [_of(totals, "n", c, halves) for c in (0, 1)]
    share = min(1.0, discount * totals["kinds"] / sum(whole))

    def word_chance(table: dict, name: str, c: int) -> np.ndarray:
        own = np.maximum(_of(table, name, c, halves) - discount, 0) / whole[c]
        return own + share * table["lefts"] / totals["lefts"]

    def pair_chance(c: int) -> np.ndarray:
        before = _of(pairs, "vn", c, halves)
        both = sum(_of(pairs, "vn", k, halves) for k in (0, 1))
        fall = np.minimum(1.0, discount * pairs["rights"] / np.maximum(both, 1))
        own = np.maximum(_of(pairs, "n", c, halves) - discount, 0) / np.maximum(before, 1)
        return own + fall * word_chance(pairs, "wn", c)

    def evidence(table: dict, name: str) -> np.ndarray:
        counts = [_of(table, name, c, halves) for c in (0, 1)]
        test = np.zeros(len(counts[0]))
        for count, size in zip(counts, sizes, strict=True):
            expected = np.maximum(sum(counts) * size / max(sum(sizes), 1), 1e-12)
            test += 2 * count * np.log(np.maximum(count, 1e-12) / expected)
        test = np.maximum(test, 0)
        # A half has half the evidence for the same difference.
        return (test / (test + params.evidence * len(halves) / 2)) ** 2

    def word_ratio(table: dict, name: str) -> np.ndarray:
        chance = [word_chance(table, name, c) for c in (0, 1)]
        return evidence(table, name) * np.log(chance[1] / chance[0])

    own = evidence(pairs, "n")
    pair_ratio = own * np.log(pair_chance(1) / pair_chance(0))
    pair_ratio += (1 - own) * word_ratio(pairs, "wn")
    pair_keys = _pair(pairs["v"].view(np.uint64), pairs["w"].view(np.uint64))
    return Ratios(
        *_ordered(words["w"].view(np.uint64), word_ratio(words, "n")),
        *_ordered(pair_keys, pair_ratio),
    )


def _ordered(keys: np.ndarray, ratio: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    return keys[order], ratio[order]


def _curve(rows: DataFrame, halves: list[Ratios]) -> np.ndarray:
    """Logistic weights of the features, each half scored by the model of the other one."""
    shared = rows.sparkSession.sparkContext.broadcast(halves)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = column_bytes(batch.column(0))
            half = batch.column(2).to_numpy()
            by_model = np.stack([m.features(data, bounds) for m in shared.value])
            features = by_model[1 - half, np.arange(len(half))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array(features[:, 0]), pa.array(features[:, 1])],
                names=["toxic", "a", "b"],
            )

    scored = rows.select("text", "toxic", "half").mapInArrow(scan, "toxic int, a double, b double")
    table = scored.toArrow()
    target = table["toxic"].to_numpy().astype(float)
    features = np.stack([table["a"].to_numpy(), table["b"].to_numpy()], axis=1)
    # More evidence must not lower a score: a feature with a negative weight is left out.
    for used in ([0, 1], [1], [0], []):
        found = _logistic(features[:, used], target)
        if (found[:-1] >= 0).all():
            break
    weights = np.zeros(3)
    weights[[*used, 2]] = found
    return weights


def _logistic(features: np.ndarray, target: np.ndarray, ridge: float = 1e-4) -> np.ndarray:
    """Newton steps for logistic regression in which both classes weigh the same."""
    scale = np.maximum(np.abs(features).max(axis=0), 1e-9)
    x = _with_one(features / scale)
    share = target.mean()
    weight = np.where(target == 1, 0.5 / share, 0.5 / (1 - share)) / len(target)
    w = np.zeros(x.shape[1])
    penalty = np.diag([ridge] * (len(w) - 1) + [0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (p - target)) + penalty @ w
        bend = (x * (weight * p * (1 - p))[:, None]).T @ x + penalty + 1e-9 * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return np.append(w[:-1] / scale, w[-1])


def scored(
    df: DataFrame,
    model: Model | None,
    key: str = "doc_id",
    text: str = "text",
    params: ToxicityParams = ToxicityParams(),
) -> DataFrame:
    """(key, score, predicted) of each row."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = column_bytes(batch.column(1))
            score = np.zeros(batch.num_rows)
            if shared.value is not None:
                score = shared.value.score(data, bounds)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(score)], names=["__key", "score"]
            )

    kind = df.schema[key].dataType
    rows = df.select(F.col(key).alias("__key"), F.col(text).cast("string"))
    schema = f"__key {kind.simpleString()}, score double"
    return rows.mapInArrow(scan, schema).select(
        F.col("__key").alias(key),
        "score",
        (F.col("score") >= params.threshold).cast("int").alias("predicted"),
    )


def keep_ordinary(
    df: DataFrame,
    model: Model | None,
    text: str = "text",
    params: ToxicityParams = ToxicityParams(),
) -> DataFrame:
    """The rows whose text is not predicted to be toxic, with the columns of ``df`` as they are."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    at = df.columns.index(text)
    kind = df.schema.fields[at].dataType.simpleString()
    if kind != "string":
        raise TypeError(f"{text} holds {kind}, not text")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if shared.value is not None:
                score = shared.value.score(*column_bytes(batch.column(at)))
                batch = batch.filter(pa.array(score < params.threshold))
            yield batch

    return df.mapInArrow(scan, df.schema)
