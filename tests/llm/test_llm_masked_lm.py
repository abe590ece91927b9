"""Masked pseudo-likelihood: windows and sums against plain Python, learning on a small corpus."""

from collections import Counter

import edge
import numpy as np
import pyarrow as pa
import pytest
from twinsieve.llm import masked_lm, text

PARAMS = masked_lm.LmParams(hidden=8, rounds=3, passes=4, batch=32, slice_rows=500)
OUT = masked_lm.OUTSIDE


def plain_windows(content):
    """(left two, right two, token) of each byte."""
    data = [OUT, OUT, *bytes(text.LOWER[b] for b in (content or "").encode()), OUT, OUT]
    return [
        (data[i - 2], data[i - 1], data[i + 1], data[i + 2], data[i])
        for i in range(2, len(data) - 2)
    ]


def as_tuples(keys):
    sides, token = masked_lm.unpacked(np.asarray(keys).view(np.uint64))
    return [(*s, t) for s, t in zip(sides.tolist(), token.tolist(), strict=True)]


@pytest.mark.parametrize("stretch", [3, 1 << 21])
def test_windows(monkeypatch, stretch):
    monkeypatch.setattr(masked_lm, "STRETCH", stretch)
    texts = ["Hello", None, "", "a", "é😀", "x" * 20 + "YZ"]
    found = {i: [] for i in range(len(texts))}
    for begin, end, keys, bounds in masked_lm._window_blocks(pa.array(texts)):
        for i in range(begin, end):
            found[i] += as_tuples(keys[bounds[i - begin] : bounds[i - begin + 1]])
    assert found == {i: plain_windows(t) for i, t in enumerate(texts)}


def test_counts_cover_the_corpus(spark):
    frame = edge.clashing(spark, "window", "n")
    counts = masked_lm.window_counts(frame, "text").collect()
    expected = Counter(w for r in edge.ROWS for w in plain_windows(r[1]))
    got = dict(zip(as_tuples(np.array([r["window"] for r in counts])), [r["n"] for r in counts]))
    assert got == expected


def test_slope_is_the_gradient():
    random = np.random.default_rng(3)
    network = masked_lm.Network.start(6, 1)
    network = masked_lm.Network(network.flat.astype(float), 6)
    sides, token = random.integers(0, 257, (20, 4)), random.integers(0, 256, 20)
    weight = random.random(20)

    def loss(flat):
        scores = masked_lm.Network(flat, 6).forward(sides)[1]
        return -(scores[np.arange(20), token] * weight).sum()

    slope = network.slope(sides, token, weight)
    at = [*random.choice(np.flatnonzero(slope), 30, replace=False)]
    for i in at:
        step = np.zeros_like(network.flat)
        step[i] = 1e-5
        rise = (loss(network.flat + step) - loss(network.flat - step)) / 2e-5
        assert slope[i] == pytest.approx(rise, abs=1e-6, rel=1e-4)


def test_memory_gives_what_the_network_gives(monkeypatch):
    monkeypatch.setattr(masked_lm, "_REMEMBERED", 8)
    network = masked_lm.Network.start(6, 1)
    memory = masked_lm.Memory(network)
    keys = np.concatenate([k for *_, k, _ in masked_lm._window_blocks(pa.array(["some text", "more"]))])
    for part in (keys, keys[::-1], keys[:5], keys):
        assert memory(part) == pytest.approx(network.log_chance(part))


def test_training_learns_and_scores_add_up(spark, workspace):
    rows = [(i, f"the quick brown fox {i % 7} jumps over the lazy dog again and again") for i in range(60)]
    rows += [(100, "zqxj wvkp zzqx jjkw vvpq xzqk"), (101, None), (102, "")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    counts = workspace.stage(masked_lm.window_counts(frame, "text"), "windows")
    network = masked_lm.train(counts, PARAMS)
    assert (masked_lm.train(counts, PARAMS).flat == network.flat).all()
    got = {r["doc_id"]: r for r in masked_lm.scored(frame, network).collect()}
    for key, content in rows:
        sides = plain_windows(content)
        assert got[key]["n_tokens"] == len(sides)
        total = 0.0
        if sides:
            table = np.array(sides)
            scores = network.forward(table[:, :4])[1]
            total = scores[np.arange(len(table)), table[:, 4]].sum(dtype=float)
        assert got[key]["score"] == pytest.approx(total, rel=1e-4, abs=1e-6)
        if not sides:
            assert got[key]["mean_score"] is None
    start = masked_lm.Network.start(PARAMS.hidden, PARAMS.seed)
    before = {r["doc_id"]: r for r in masked_lm.scored(frame, start).collect()}
    assert got[0]["mean_score"] > before[0]["mean_score"] + 1
    assert got[0]["mean_score"] > got[100]["mean_score"] + 1


def test_edge_rows(spark, workspace):
    frame = edge.clashing(spark, "score", "n", "window", "id")
    got = edge.rows_of(masked_lm.lm_scores(frame, workspace, params=PARAMS), "doc_id", "n_tokens")
    expected = [(r[0], len((r[1] or "").encode())) for r in edge.ROWS]
    assert got == sorted(expected, key=repr)
    assert masked_lm.lm_scores(edge.empty(spark), workspace, params=PARAMS).count() == 0
