"""Ascending numbers as bytes: the steps between them, seven bits a byte."""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle

# The helpers below travel with the tasks, so the executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def packed(numbers: np.ndarray) -> bytes:
    """Ascending 64-bit numbers, each with seven bits of the step to it in a byte; the last byte
    of a step has its high bit clear."""
    if not len(numbers):
        return b""
    steps = np.diff(numbers, prepend=numbers.dtype.type(0))
    sizes = np.ones(len(steps), np.int64)
    for k in range(1, 10):
        sizes += steps >> np.uint64(7 * k) > 0
    ends = np.cumsum(sizes)
    out = np.zeros(int(ends[-1]), np.uint8)
    for k in range(int(sizes.max())):
        some = sizes > k
        septet = (steps[some] >> np.uint64(7 * k)).astype(np.uint8) & 0x7F
        more = np.where(sizes[some] > k + 1, 0x80, 0).astype(np.uint8)
        out[(ends - sizes)[some] + k] = septet | more
    return out.tobytes()


def unpacked(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    ends = np.flatnonzero(raw < 0x80)
    if not len(ends):
        return np.empty(0, np.uint64)
    starts = np.concatenate([[0], ends[:-1] + 1])
    within = np.arange(len(raw)) - np.repeat(starts, ends - starts + 1)
    terms = (raw & 0x7F).astype(np.uint64) << (7 * within).astype(np.uint64)
    return np.cumsum(np.add.reduceat(terms, starts), dtype=np.uint64)
