import numpy as np
import pytest

import plain
from twinsieve import connected_components
from twinsieve.operators import components
from twinsieve.operators.components import (
    NotConverged,
    large_star,
    small_star,
    symmetric_difference,
    unsettled,
)


def graph(spark, edges):
    return spark.createDataFrame(list(edges), "src long, dst long")


def solve(spark, workspace, edges, **options):
    found = connected_components(graph(spark, edges), workspace, **options).collect()
    assert len(found) == len({r.id for r in found})
    return {r.id: r.component for r in found}


PATH = [(i + 1, i) for i in range(60)]
CLIQUES = [(a, b) for base in (0, 100) for a in range(base, base + 8) for b in range(base, a)]


@pytest.mark.parametrize(
    "edges",
    [
        [(4, 3), (3, 2), (2, 1)],
        [(1, 2), (2, 3), (3, 4)],
        PATH,
        CLIQUES,
        [(9, 1), (9, 2)],
        [(5, 5)],
        [(i, 0) for i in range(1, 300)] + [(i, 300) for i in range(301, 400)],
        [(300, i) for i in range(300)],
        [(2, 1), (2, 1), (1, 2)],
    ],
    ids=["path4", "path4-up", "path60", "cliques", "two-parents", "loop", "hubs", "top-hub", "dup"],
)
@pytest.mark.parametrize("hot_rows", [10**9, 3])
def test_shapes(spark, workspace, edges, hot_rows):
    assert solve(spark, workspace, edges, hot_rows=hot_rows) == plain.components(
        [e for e in edges if e[0] != e[1]]
    )


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("hot_rows", [10**9, 3])
def test_random_graphs(spark, workspace, seed, hot_rows):
    """Many small random graphs side by side, relabelled so that no order helps."""
    rng = np.random.default_rng(seed)
    edges, base = [], 0
    for _ in range(60):
        nodes = int(rng.integers(2, 13))
        for _ in range(int(rng.integers(1, 2 * nodes))):
            edges.append((base + int(rng.integers(nodes)), base + int(rng.integers(nodes))))
        base += nodes
    names = rng.permutation(base).tolist()
    edges = [(names[a], names[b]) for a, b in edges if a != b]
    assert solve(spark, workspace, edges, hot_rows=hot_rows) == plain.components(edges)


def test_no_edges(spark, workspace):
    assert solve(spark, workspace, []) == {}


def test_string_keys(spark, workspace):
    edges = spark.createDataFrame([("c", "b"), ("b", "a"), ("x", "y")], "src string, dst string")
    found = connected_components(edges, workspace)
    assert plain.pairs(found, "id", "component") == {("b", "a"), ("c", "a"), ("y", "x")}


def test_round_limit_raises(spark, workspace):
    with pytest.raises(NotConverged):
        solve(spark, workspace, PATH, max_rounds=1)


def test_star_steps(spark, workspace):
    edges = graph(spark, [(4, 3), (3, 2), (2, 1)])
    assert plain.pairs(large_star(edges, workspace), "src", "dst") == {(2, 1), (3, 1), (4, 2)}
    assert plain.pairs(small_star(edges, workspace), "src", "dst") == {(2, 1), (3, 2), (4, 3)}
    both = graph(spark, [(9, 1), (9, 2)])
    assert plain.pairs(small_star(both, workspace), "src", "dst") == {(9, 1), (2, 1)}


def test_unsettled_nodes(spark):
    def nodes(edges):
        return sorted(r.node for r in unsettled(graph(spark, edges)).collect())

    assert nodes([(2, 1), (3, 1), (9, 8)]) == []
    assert nodes([]) == []
    assert nodes([(2, 1), (3, 2), (9, 8)]) == [2]
    assert nodes([(3, 1), (3, 2)]) == [3]


def test_finished_components_leave_the_loop(spark, workspace):
    """A star is done at once; a path and whatever touches an unsettled node are not."""
    edges = [(i, 0) for i in range(1, 50)] + [(104, 103), (103, 102), (102, 101), (109, 102)]
    state = graph(spark, edges)
    done, rest = components._split_done(state, unsettled(state), workspace, "t")
    assert plain.pairs(done, "src", "dst") == set(edges[:49])
    assert plain.pairs(rest, "src", "dst") == set(edges[49:])


def test_large_graphs_lose_finished_components_in_each_round(spark, workspace):
    edges = PATH + [(i, 500) for i in range(501, 520)]
    assert solve(spark, workspace, edges, hot_rows=3) == plain.components(edges)


def test_symmetric_difference(spark):
    left, right = graph(spark, [(1, 0), (1, 0), (2, 0)]), graph(spark, [(2, 0), (3, 0), (3, 0)])
    rows = symmetric_difference(left, right).collect()
    assert sorted(map(tuple, rows)) == [(1, 0), (3, 0)]
