"""Top-k search against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from twinsieve.llm import topk

SCHEMA = "vec_id bigint, embedding array<float>"


def plain(rows, k, scale=1024):
    """The k best of each query with a plain loop; ids are unique."""
    whole = {}
    for key, vector in rows:
        if key is None or vector is None:
            continue
        values = np.array([np.nan if x is None else x for x in vector], np.float32).astype(float)
        if np.isfinite(values).all():
            whole[key] = [int(x) for x in np.floor(scale * values)]
    out = []
    for query in whole:
        if query % 10:
            continue
        scores = [
            (-sum(a * b for a, b in zip(whole[query], v)), key)
            for key, v in whole.items()
            if key != query and len(v) == len(whole[query])
        ]
        out += [(query, n + 1, key, -s) for n, (s, key) in enumerate(sorted(scores)[:k])]
    return sorted(out)


def found(spark, workspace, rows, params):
    frame = spark.createDataFrame(rows, SCHEMA)
    got = topk.top_k(frame, F.col("id") % 10 == 0, workspace, params=params)
    return sorted(map(tuple, got.collect()))


@pytest.mark.parametrize("bins", [4, 1024])
def test_against_brute_force(spark, workspace, bins):
    pick = random.Random(bins)
    rows = [(i * 7 % 1000, [pick.gauss(0, 0.3) for _ in range(8)]) for i in range(300)]
    rows += [(1001 + i, [0.5, 0.25] * 4) for i in range(150)]
    params = topk.TopKParams(k=5, bins=bins, cell=400, group=100, least_cells=3)
    assert found(spark, workspace, rows, params) == plain(rows, 5)


def test_edge_rows(spark, workspace):
    nan, inf = float("nan"), float("inf")
    rows = [
        (10, [1.0, -1.0]), (20, [0.0, 0.0]), (1, [1.0, -1.0]), (2, [-1.0, 1.0]),
        (3, None), (4, [nan, 1.0]), (5, [1.0, inf]), (6, [None, 1.0]), (30, [1.0, -inf]),
        (7, [1.0]), (40, [2.0]), (50, []), (8, [1e-4, 3.9e-4]), (60, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]),
    ]
    params = topk.TopKParams(least_cells=2)
    assert found(spark, workspace, rows, params) == plain(rows, 10)
    assert found(spark, workspace, [], params) == []
    assert found(spark, workspace, rows[2:4], params) == []


def test_large_components_are_exact(spark, workspace):
    rows = [(10, [2e6, 1.0]), (1, [2e6, 0.001]), (2, [2e6, 0.002]), (3, [-2e6, 1.0])]
    assert found(spark, workspace, rows, topk.TopKParams()) == plain(rows, 10)


def test_repeated_rows(spark, workspace):
    rows = [(10, [1.0]), (10, [1.0]), (1, [2.0]), (1, [2.0]), (2, [1.0])]
    got = found(spark, workspace, rows, topk.TopKParams(k=2))
    assert got == [(10, 1, 1, 2 * 1024**2), (10, 2, 1, 2 * 1024**2)]
