"""MinHash signatures, packed as four big-endian bytes for each permutation.

A packed signature is a quarter to an eighth of the size of an ARRAY<BIGINT>, and a band of
it is a plain ``substring``: no array work remains after this step.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, functions as F

from twinsieve.functions.digests import sha1_heads

# The helpers below travel with the tasks, so the executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The Mersenne prime of the permutations and the seed they are drawn from.
MERSENNE_PRIME = (1 << 61) - 1
SEED = 42

_WORD_BYTES = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz_0123456789"
_SPACE = 32
# Cells of the exact (shingles x permutations) work array, which stays inside a core's cache, and
# the shingles in a run, of which the first step finds the smallest value alone.
_CELLS, _RUN = 1 << 15, 16
# N-grams of one text that are hashed at a time.
_PART = 1 << 16
# N-grams of several texts that are digested together, and rows of a batch that leave together.
_GROUP, _ROWS = 1 << 16, 512
# Signatures a task remembers (and those of one part more), by a digest of the text, so copies of a text cost one hash.
_KNOWN = 4096


def permutations(num_perm: int, seed: int = SEED) -> np.ndarray:
    """``num_perm`` pairs (a, b) with 0 < a < p and 0 <= b < p, a pure function of the seed."""
    draw = np.random.RandomState(seed).randint
    pairs = []
    for _ in range(num_perm):
        a = draw(1, MERSENNE_PRIME, dtype=np.uint64)
        b = draw(0, MERSENNE_PRIME, dtype=np.uint64)
        pairs.append((a, b))
    return np.array(pairs, dtype=np.uint64).reshape(num_perm, 2)


def _byte_classes() -> np.ndarray:
    table = np.full(256, _SPACE, dtype=np.uint8)
    words = np.frombuffer(_WORD_BYTES, dtype=np.uint8)
    table[words] = words
    return table


def text_hashes(
    text: bytes, n: int, min_tokens: int, classes: np.ndarray
) -> Iterator[np.ndarray]:
    """32-bit hashes of all word n-grams of a UTF-8 text; repeated n-grams are not removed.

    They come in parts, so a very long text needs little more memory than itself.
    """
    flat, starts, ends = _ngrams(text, n, min_tokens, classes)
    for at in range(0, len(starts), _PART):
        some = slice(at, at + _PART)
        yield sha1_heads(flat, starts[some], ends[some]).astype(np.uint64)


def _ngrams(
    text: bytes, n: int, min_tokens: int, classes: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(flat, starts, ends): the n-grams of a text are the slices of ``flat``.

    Once each separator character is one space, an n-gram joined by spaces is a plain slice of
    the text, so no token list is built. UTF-8 continuation bytes are dropped first to leave one
    byte for a character.
    """
    raw = np.frombuffer(text, dtype=np.uint8)
    flat = classes[raw[(raw & 0xC0) != 0x80]]
    gaps = np.flatnonzero(flat == _SPACE)
    n_tokens = len(gaps) + 1
    if n_tokens < max(n, min_tokens):
        return flat, gaps[:0], gaps[:0]
    starts = np.concatenate(([0], gaps + 1))[: n_tokens - n + 1]
    ends = np.concatenate((gaps, [len(flat)]))[n - 1 :]
    return flat, starts, ends


def _group_hashes(grams: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> list[np.ndarray]:
    """The hashes of each of several texts, from their n-grams, all digested at once."""
    shifts = np.cumsum([0] + [len(flat) for flat, _, _ in grams])
    counts = np.cumsum([0] + [len(starts) for _, starts, _ in grams])
    starts = np.concatenate([g[1] + shift for g, shift in zip(grams, shifts)])
    ends = np.concatenate([g[2] + shift for g, shift in zip(grams, shifts)])
    hashes = sha1_heads(np.concatenate([g[0] for g in grams]), starts, ends).astype(np.uint64)
    return [hashes[i:j] for i, j in zip(counts, counts[1:])]


def _minima(hashes: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The minima of one text, see ``_group_minima``."""
    return _group_minima([hashes], a, b)[0]


def _group_minima(texts: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest permuted value, ((h*a + b) mod 2^64) mod p, low 32 bits, of each text (rows) and
    permutation, from the hashes of the texts.

    With x = h*a + b wrapped at 2^64 and p = 2^61 - 1, x mod p is (x mod 2^61) + (x >> 61),
    less p where that sum reaches p. So the wanted value is low32(x) and 0 to 7 more, unless
    low32(x) is one of the eight largest numbers, from where it may reach p or pass 2^32.

    With z = low32(x) + 8, which takes 32-bit arithmetic alone, a smallest z of 8 or more
    proves that no such number took part, and that the smallest value belongs to a z at most 7
    above the smallest. Few runs of hashes hold such a z, and only those are done in 64 bits.
    Texts with any other set of hashes are done with the plain remainder.
    """
    counts = np.array([-(-len(h) // _RUN) for h in texts])
    firsts = np.cumsum(counts) - counts
    text_of = np.repeat(np.arange(len(texts)), counts)
    filled = [part for h in texts for part in (h, np.repeat(h[-1:], -len(h) % _RUN))]
    runs = np.concatenate(filled).reshape(-1, _RUN)
    # Hashes of a run lie below each other, so that all steps go along whole rows.
    columns = np.ascontiguousarray(runs.T, dtype=np.uint32)
    z, low = np.empty_like(columns), np.empty(len(runs), dtype=np.uint32)
    low_a, low_b = a.astype(np.uint32), (b + np.uint64(8)).astype(np.uint32)
    best = np.full((len(a), len(texts)), 0xFFFFFFFF, dtype=np.uint32)
    unsure = np.zeros(len(texts), dtype=bool)
    for k in range(len(a)):
        np.multiply(columns, low_a[k], out=z)
        z += low_b[k]
        np.minimum.reduce(z, axis=0, out=low)
        least = np.minimum.reduceat(low, firsts)
        unsure |= least < 8
        limit = np.minimum(least, np.uint32(0xFFFFFFF8)) + np.uint32(7)
        near = np.flatnonzero(low <= limit[text_of])
        x = runs[near] * a[k] + b[k]
        x += x >> np.uint64(61)
        np.minimum.at(best[k], text_of[near], x.astype(np.uint32).min(axis=1))
    for text in np.flatnonzero(unsure):
        best[:, text] = _exact_minima(texts[text], a, b)
    return best.T


def _exact_minima(hashes: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    best = np.full(len(a), 0xFFFFFFFF, dtype=np.uint32)
    rows = max(1, _CELLS // len(a))
    for start in range(0, len(hashes), rows):
        x = hashes[start : start + rows, None] * a + b
        x %= np.uint64(MERSENNE_PRIME)
        np.minimum(best, x.astype(np.uint32).min(axis=0), out=best)
    return best


def signature_rows(
    n: int, min_tokens: int, num_perm: int, used: int | None = None, seed: int = SEED
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for ``mapInArrow`` that turns (id, text) batches into (id, signature) ones.

    A null text, or one without n-grams, gives no row. ``used`` limits the work to the first
    permutations, those that some band reads. Batches leave in parts, so that beside the batch
    Spark hands over a task holds one part of it and what it remembers.
    """
    if n < 1 or min_tokens < 0 or num_perm < 1:
        raise ValueError(f"bad sizes: n={n}, min_tokens={min_tokens}, num_perm={num_perm}")
    pairs = permutations(num_perm, seed)[: used or num_perm]
    a, b = np.ascontiguousarray(pairs[:, 0]), np.ascontiguousarray(pairs[:, 1])
    classes = _byte_classes()
    known: dict[bytes, bytes | None] = {}

    def packed(minima: np.ndarray) -> bytes:
        return minima.astype(">u4").tobytes()

    def learn(texts: dict[bytes, pa.Buffer]) -> None:
        """Signatures of new texts, whose n-grams are digested a good many at a time."""
        waiting: dict[bytes, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        held = 0

        def finish() -> None:
            hashes = _group_hashes(list(waiting.values()))
            known.update(zip(waiting, map(packed, _group_minima(hashes, a, b))))
            waiting.clear()

        for digest, data in texts.items():
            grams = _ngrams(data, n, min_tokens, classes)
            if not len(grams[1]):
                known[digest] = None
            elif len(grams[1]) > _PART:
                parts = text_hashes(data, n, min_tokens, classes)
                known[digest] = packed(np.minimum.reduce([_minima(h, a, b) for h in parts]))
            else:
                waiting[digest] = grams
                held += len(grams[1])
                if held >= _GROUP:
                    finish()
                    held = 0
        if waiting:
            finish()

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, _ROWS):
                part = batch.slice(start, _ROWS)
                buffers = [t.as_buffer() if t.is_valid else None for t in part.column("text")]
                digests = [None if t is None else hashlib.sha256(t).digest() for t in buffers]
                if len(known) > _KNOWN:
                    known.clear()
                learn({d: t for d, t in zip(digests, buffers) if d and d not in known})
                found = pa.array([known[d] if d else None for d in digests], pa.binary())
                rows = pa.RecordBatch.from_arrays([part.column("id"), found], ["id", "signature"])
                yield rows.filter(found.is_valid())

    return signed


def signature_value(packed: Column, k: Column | int) -> Column:
    """The k-th value (from 0) of a packed signature, as BIGINT."""
    start = (F.lit(k) if isinstance(k, int) else k) * 4 + 1
    return F.conv(F.hex(F.substr(packed, start, F.lit(4))), 16, 10).cast("bigint")
