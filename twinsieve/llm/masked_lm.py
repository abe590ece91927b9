"""LM scoring by masked pseudo-likelihood: each token is predicted from both of its sides.

Tokens are the bytes of the UTF-8 text with A to Z in lower case, so there are no unknown ones and
no vocabulary grows with the data. A network sees the two tokens before and the two after a place
(a mark stands for what lies outside the text) and predicts the token there:

    hidden = tanh(sum of a vector per place and token + bias)
    log p(token | both sides) = log softmax(hidden @ out + out bias)

A text's score is the sum of these logarithms over all of its places.

1. The corpus becomes its windows with their counts: every place of every text counts, and equal
   windows are added up, so what training reads grows with the different windows only.
2. The windows are dealt to slices of bounded size by hash. In each round every slice improves the
   shared weights by minibatch Adam in numpy, weighing windows by their counts, and the results are
   averaged, weighted by the counts, in two steps. The driver holds one set of weights.
3. Scoring computes each window's logarithm once per Python worker while it is remembered.

Defined results: null and empty texts have no tokens, a score of 0 and no mean. Rows are scored each
for itself; repeated rows count as often as they are there. Very long texts are read in blocks whose
windows overlap. A corpus without tokens leaves the network as it started, which scores all
tokens alike. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from twinsieve.llm.text import LOWER, STRETCH, blocks, column_bytes, mixed
from twinsieve.sources.workspace import Workspace

SIDE = 2  # tokens seen on each side
TOKENS, OUTSIDE = 256, 256
_BITS = 9
_REMEMBERED = 1 << 22


@dataclass(frozen=True)
class LmParams:
    hidden: int = 24
    rounds: int = 6
    passes: int = 2
    batch: int = 2048
    rate: float = 0.02
    slice_rows: int = 1 << 16
    seed: int = 5


def windows(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The window of each byte as a number: the tokens around it, then its own token."""
    count = len(bounds) - 1
    sizes = np.diff(bounds)
    at = np.arange(len(data)) + SIDE * (np.repeat(np.arange(count), sizes) + 1)
    padded = np.full(len(data) + SIDE * (count + 1), OUTSIDE, np.uint64)
    padded[at] = LOWER[data]
    whole = np.zeros(len(padded), np.uint64)
    for shift in (-2, -1, 1, 2):
        whole = (whole << np.uint64(_BITS)) | np.roll(padded, -shift)
    return ((whole << np.uint64(_BITS)) | padded)[at]


def _window_blocks(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first text, text after, windows, bounds); a text longer than a block comes in parts."""
    data, bounds = column_bytes(column)
    for begin, end in blocks(bounds, STRETCH):
        start, stop = bounds[begin], bounds[end]
        if stop - start <= 2 * STRETCH:
            inner = bounds[begin : end + 1] - start
            yield begin, end, windows(data[start:stop], inner), inner
            continue
        for low in range(start, stop, STRETCH):
            high = min(low + STRETCH, stop)
            first, last = max(low - SIDE, start), min(high + SIDE, stop)
            part = windows(data[first:last], np.array([0, last - first]))
            part = part[low - first : high - first]
            yield begin, end, part, np.array([0, len(part)])


def window_counts(df: DataFrame, text: str) -> DataFrame:
    """(window, n) over all texts."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, found, _ in _window_blocks(batch.column(0)):
                keys, counts = np.unique(found, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.view(np.int64)), pa.array(counts)], names=["window", "n"]
                )

    counted = df.select(F.col(text).cast("string")).mapInArrow(scan, "window bigint, n bigint")
    return counted.groupBy("window").agg(F.sum("n").alias("n"))


class Network:
    """The weights as one vector, and views of its parts."""

    def __init__(self, flat: np.ndarray, hidden: int):
        self.flat, self.hidden = flat, hidden
        self.parts = []
        at = 0
        for shape in self.shapes(hidden):
            size = int(np.prod(shape))
            self.parts.append(flat[at : at + size].reshape(shape))
            at += size

    @staticmethod
    def shapes(hidden: int) -> list[tuple[int, ...]]:
        return [(2 * SIDE, TOKENS + 1, hidden), (hidden,), (hidden, TOKENS), (TOKENS,)]

    @classmethod
    def start(cls, hidden: int, seed: int) -> Network:
        random = np.random.default_rng(seed)
        size = sum(int(np.prod(s)) for s in cls.shapes(hidden))
        made = cls(random.normal(0, 0.1, size).astype(np.float32), hidden)
        made.parts[3][:] = 0
        return made

    def forward(self, sides: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hidden values and log probabilities of all tokens, for rows of side tokens."""
        vectors, bias, out, out_bias = self.parts
        hidden = np.tanh(sum(vectors[i][sides[:, i]] for i in range(2 * SIDE)) + bias)
        scores = hidden @ out + out_bias
        scores -= scores.max(axis=1, keepdims=True)
        scores -= np.log(np.exp(scores).sum(axis=1, keepdims=True))
        return hidden, scores

    def log_chance(self, keys: np.ndarray) -> np.ndarray:
        out = np.empty(len(keys), np.float32)
        for i in range(0, len(keys), 8192):
            sides, token = unpacked(keys[i : i + 8192])
            out[i : i + 8192] = self.forward(sides)[1][np.arange(len(token)), token]
        return out

    def slope(self, sides: np.ndarray, token: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """The gradient of the weighted loss, as one vector."""
        hidden, scores = self.forward(sides)
        wrong = np.exp(scores)
        wrong[np.arange(len(token)), token] -= 1
        wrong *= weight[:, None]
        back = (wrong @ self.parts[2].T) * (1 - hidden * hidden)
        found = Network(np.zeros_like(self.flat), self.hidden)
        for i in range(2 * SIDE):
            np.add.at(found.parts[0][i], sides[:, i], back)
        found.parts[1][:] = back.sum(axis=0)
        found.parts[2][:] = hidden.T @ wrong
        found.parts[3][:] = wrong.sum(axis=0)
        return found.flat


def unpacked(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64((1 << _BITS) - 1)
    parts = [(keys >> np.uint64(_BITS * i)) & mask for i in range(2 * SIDE, -1, -1)]
    return np.stack(parts[:-1], axis=1).astype(np.int64), parts[-1].astype(np.int64)


def improved(
    network: Network, keys: np.ndarray, counts: np.ndarray, turn: int, params: LmParams
) -> np.ndarray:
    """Weights after some passes of Adam over the windows of a slice."""
    network = Network(network.flat.copy(), network.hidden)
    mean, square = np.zeros_like(network.flat), np.zeros_like(network.flat)
    random = np.random.default_rng(params.seed + turn)
    rate, step = params.rate / (1 + turn), 0
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order].astype(np.float32)
    sides, token = unpacked(keys)
    for _ in range(params.passes):
        order = random.permutation(len(keys))
        for i in range(0, len(order), params.batch):
            at = order[i : i + params.batch]
            weight = counts[at] / counts[at].sum()
            slope = network.slope(sides[at], token[at], weight)
            step += 1
            mean += 0.1 * (slope - mean)
            square += 0.01 * (slope * slope - square)
            move = (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
            network.flat -= np.float32(rate) * move
    return network.flat


_SUMS = "part int, n double, weights binary"


def train(counts: DataFrame, params: LmParams = LmParams()) -> Network:
    """The network after all rounds over staged window counts."""
    rows = counts.count()
    slices = max(1, -(-rows // params.slice_rows))
    parts = min(slices, 32)
    slice_of = F.pmod(F.xxhash64("window"), F.lit(slices)).cast("int").alias("slice")
    dealt = counts.select("window", "n", slice_of)
    network = Network.start(params.hidden, params.seed)
    for turn in range(params.rounds if rows else 0):
        shared = counts.sparkSession.sparkContext.broadcast(network.flat)
        learn = _learner(shared, turn, parts, params)
        learnt = dealt.groupBy("slice").applyInArrow(learn, _SUMS)
        added = learnt.groupBy("part").applyInArrow(_added, _SUMS).toArrow()
        total = _added(added)
        network = Network(np.frombuffer(total["weights"][0].as_py(), np.float32), params.hidden)
    return network


def _learner(
    shared: Broadcast, turn: int, parts: int, params: LmParams
) -> Callable[[pa.Table], pa.Table]:
    def learn(table: pa.Table) -> pa.Table:
        keys, n = table["window"].to_numpy().view(np.uint64), table["n"].to_numpy()
        found = improved(Network(shared.value, params.hidden), keys, n, turn, params)
        return _sum_row(table["slice"][0].as_py() % parts, float(n.sum()), found)

    return learn


def _sum_row(part: int, n: float, weights: np.ndarray) -> pa.Table:
    data = pa.array([weights.astype(np.float32).tobytes()], pa.binary())
    return pa.table({"part": pa.array([part], pa.int32()), "n": [n], "weights": data})


def _added(table: pa.Table) -> pa.Table:
    """The mean of weights, weighted by n, taken in a fixed order."""
    n, rows = table["n"].to_numpy(), table["weights"].to_pylist()
    order = sorted(range(len(rows)), key=lambda i: (n[i], rows[i]))
    mean = sum(np.frombuffer(rows[i], np.float32).astype(float) * (n[i] / n.sum()) for i in order)
    return _sum_row(table["part"][0].as_py(), float(n.sum()), mean)


class Memory:
    """Logarithms of windows met before, each in the slot of its hash."""

    def __init__(self, network: Network):
        self.network = network
        self.keys = np.full(_REMEMBERED, np.uint64(1 << 63))
        self.values = np.zeros(_REMEMBERED, np.float32)

    def __call__(self, found: np.ndarray) -> np.ndarray:
        slot = (mixed(found) & np.uint64(_REMEMBERED - 1)).astype(np.int64)
        values = self.values[slot]
        missed = np.flatnonzero(self.keys[slot] != found)
        if len(missed):
            keys, where = np.unique(found[missed], return_inverse=True)
            new = self.network.log_chance(keys)
            values[missed] = new[where]
            slots = (mixed(keys) & np.uint64(_REMEMBERED - 1)).astype(np.int64)
            self.keys[slots], self.values[slots] = keys, new
            # Of keys that share a slot the last one written stays, with its own value.
        return values


def scored(
    df: DataFrame,
    network: Network,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(key, n_tokens, score, mean_score) of each row."""
    hidden = network.hidden
    shared = df.sparkSession.sparkContext.broadcast(network.flat)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = Memory(Network(shared.value, hidden))
        for batch in batches:
            sums, sizes = np.zeros(batch.num_rows), np.zeros(batch.num_rows, np.int64)
            for begin, end, found, bounds in _window_blocks(batch.column(1)):
                upto = np.concatenate([[0.0], np.cumsum(memory(found), dtype=float)])
                sums[begin:end] += np.diff(upto[bounds])
                sizes[begin:end] += np.diff(bounds)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes), pa.array(sums)], names=["id", "n", "score"]
            )

    rows = df.select(F.col(key).alias("id"), F.col(text).cast("string"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(scan, f"id {kind}, n bigint, score double").select(
        F.col("id").alias(key),
        F.col("n").alias("n_tokens"),
        "score",
        F.when(F.col("n") > 0, F.col("score") / F.col("n")).alias("mean_score"),
    )


def lm_scores(
    df: DataFrame,
    workspace: Workspace,
    key: str = "doc_id",
    text: str = "text",
    params: LmParams = LmParams(),
) -> DataFrame:
    """Train on all texts of ``df`` and score each of them."""
    counts = workspace.stage(window_counts(df, text), "windows")
    return scored(df, train(counts, params), key, text)
