"""A forest of disjoint sets over the edges that one task reads."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

# The helpers below travel with the tasks, so the executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Links that a task passes on when it holds so many after contracting them. It holds twice as many at
# most, at about 300 bytes of work space each (six million links: 158 MB; with 2^20 it is 500 MB).
MOST_EDGES = 1 << 18


def roots(count: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For each of ``count`` nodes the smallest one that edges connect it with.

    Each tree hooks onto the smallest root an edge leads it to, and each node then climbs to its
    root by doubling steps; no edge between two trees is left after few rounds.
    """
    parent = np.arange(count)
    while len(left):
        a, b = parent[left], parent[right]
        open_edges = a != b
        left, right, a, b = (x[open_edges] for x in (left, right, a, b))
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        while True:
            above = parent[parent]
            if (above == parent).all():
                break
            parent = above
    return parent


def _linked(src: pa.Array, dst: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Each node but the smallest of its set, with the smallest. Null nodes are in no set."""
    whole = pa.concat_arrays([src, dst])
    nodes = pc.drop_null(pc.unique(whole))
    nodes = nodes.take(pc.sort_indices(nodes))
    places = [pc.index_in(side, nodes).fill_null(-1).to_numpy() for side in (src, dst)]
    known = (places[0] >= 0) & (places[1] >= 0)
    root = roots(len(nodes), places[0][known], places[1][known])
    low = pa.array(np.flatnonzero(root != np.arange(len(nodes))))
    return nodes.take(low), nodes.take(pa.array(root[low.to_numpy()]))


def contracting(
    most_edges: int,
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for ``mapInArrow`` from edges (src, dst) to fewer ones with the same sets."""

    def contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        held = 0

        def links() -> pa.RecordBatch:
            sides = [pa.concat_arrays([b.column(i) for b in waiting]) for i in (0, 1)]
            return pa.RecordBatch.from_arrays(list(_linked(*sides)), names=["src", "dst"])

        for batch in batches:
            for start in range(0, batch.num_rows, most_edges):
                part = batch.slice(start, most_edges)
                waiting.append(part)
                held += part.num_rows
                if held >= 2 * most_edges:
                    found = links()
                    waiting, held = [found], found.num_rows
                    if held >= most_edges:
                        yield found
                        waiting, held = [], 0
        if waiting:
            yield links()

    return contract
