import subprocess
import sys
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

import plain
from twinsieve.functions import forest
from twinsieve.operators.components import connected_components, contracted

pairs = st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), max_size=60)


def lowest(edges):
    """Each node but the smallest of its component, with the smallest."""
    down = [(max(e), min(e)) for e in edges if e[0] != e[1]]
    return plain.components(down)


def batch(edges):
    return pa.RecordBatch.from_arrays(
        [pa.array([e[i] for e in edges], pa.int64()) for i in (0, 1)], names=["src", "dst"]
    )


def rows(batches):
    return [tuple(r.values()) for b in batches for r in b.to_pylist()]


@settings(max_examples=200, deadline=None)
@given(pairs, st.integers(1, 40))
def test_sets_stay_the_same(edges, most):
    """In one go, and when a task has to pass on what it holds."""
    cut = [batch(edges[i : i + 7]) for i in range(0, len(edges), 7)]
    found = rows(forest.contracting(most)(iter(cut)))
    assert lowest(found) == lowest(edges)
    assert all(src > dst for src, dst in found)


@given(pairs)
def test_a_task_has_fewer_links_than_nodes(edges):
    found = rows(forest.contracting(1 << 20)(iter([batch(edges)])))
    assert dict(found) == lowest(edges) and len(found) == len(lowest(edges))


def test_a_long_path_takes_few_rounds():
    count = 200_000
    order = np.random.default_rng(5).permutation(count)
    assert (forest.roots(count, order[1:], order[:-1]) == 0).all()
    steps = np.arange(count - 1)
    assert (forest.roots(count, steps + 1, steps) == 0).all()


@pytest.mark.parametrize("hot_rows", [10**9, 50])
@pytest.mark.parametrize("seed", range(2))
def test_random_graphs(spark, workspace, seed, hot_rows):
    rng = np.random.default_rng(seed)
    edges = [tuple(map(int, e)) for e in rng.integers(0, 400, (300, 2))]
    frame = spark.createDataFrame(edges, "src long, dst long").repartition(6)
    found = connected_components(frame, workspace, hot_rows=hot_rows, contract=True)
    assert {r.id: r.component for r in found.collect()} == lowest(edges)


def test_text_nodes_and_nulls(spark, workspace):
    edges = [("é", "b"), ("b", "a"), ("z", "y"), (None, "a"), ("q", None), ("x", "x")]
    frame = spark.createDataFrame(edges, "src string, dst string").coalesce(1)
    found = {(r.src, r.dst) for r in contracted(frame).collect()}
    assert found == {("é", "a"), ("b", "a"), ("z", "y")}
    components = connected_components(frame, workspace, contract=True)
    assert {(r.id, r.component) for r in components.collect()} == found


def shuffled_rows(spark, run):
    """Rows that the exchanges of the stages of ``run`` have written."""
    spark._jsc.sc().listenerBus().waitUntilEmpty()
    known = {s.stageId() for s in stages(spark)}
    run()
    spark._jsc.sc().listenerBus().waitUntilEmpty()
    return sum(s.shuffleWriteRecords() for s in stages(spark) if s.stageId() not in known)


def stages(spark):
    gateway = spark.sparkContext._gateway
    found = spark._jsc.sc().statusStore().stageList(
        None, False, False, gateway.new_array(gateway.jvm.double, 0), None
    )
    return [found.apply(i) for i in range(found.size())]


def test_a_path_is_contracted_before_the_first_shuffle(spark, workspace):
    """100 000 nodes in a row: next to nothing is shuffled, in few rounds."""
    path = spark.range(0, 99_999, 1, 8).selectExpr("id + 1 AS src", "id AS dst")
    assert contracted(path).count() == 99_999
    results = []

    def run(contract):
        found = connected_components(
            path, workspace, max_rounds=4 if contract else 40, contract=contract
        )
        results.append(found.where("component = 0").count())

    small = shuffled_rows(spark, lambda: run(True))
    large = shuffled_rows(spark, lambda: run(False))
    assert results == [99_999] * 2
    # The stars of the eight tasks are told apart from one another by their centres only.
    assert small < large / 3


def test_no_edges(spark, workspace):
    none = spark.createDataFrame([], "src long, dst long")
    assert contracted(none).collect() == []
    assert connected_components(none, workspace, contract=True).collect() == []


_MANY = """
import resource
import numpy as np, pyarrow as pa
from twinsieve.functions import forest

draw = np.random.default_rng(1).integers

def batches(count):
    for _ in range(count):
        sides = [pa.array(draw(0, 1 << 24, 10_000) << 33) for _ in range(2)]
        yield pa.RecordBatch.from_arrays(sides, names=["src", "dst"])

def peak():
    return resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024

for _ in forest.contracting(forest.MOST_EDGES)(batches(1)):
    pass
before = peak()
for _ in forest.contracting(forest.MOST_EDGES)(batches(400)):
    pass
print(peak() - before)
"""


def test_memory_of_a_task_with_many_links():
    """Four million links that share few nodes: most of them are passed on, not held."""
    root = Path(__file__).resolve().parents[1]
    run = subprocess.run(
        [sys.executable, "-c", _MANY], cwd=root, capture_output=True, text=True, check=True
    )
    assert int(run.stdout) < 250
