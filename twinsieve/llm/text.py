"""Words of many texts at once, as 64-bit hashes in numpy.

A column of texts is one buffer of UTF-8 bytes with bounds. All of its words are hashed together,
in stretches of bounded size, so memory follows the stretch and not the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

STRETCH = 1 << 21
_MASK = (1 << 64) - 1
_POWERS = 1 << 12

WHITE = np.array([0x20, *range(0x09, 0x0E)])
NOT_WHITE = np.ones(256, bool)
NOT_WHITE[WHITE] = False
# ASCII letters and digits, and all bytes of other characters.
WORD_BYTES = np.zeros(256, bool)
WORD_BYTES[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mixed(values: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the finalizer of MurmurHash3)."""
    x = values ^ np.uint64(salt)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_LETTERS = mixed(np.arange(1, 257, dtype=np.uint64), 0x5DEECE66D)
_STEP = 0x9E3779B97F4A7C15
_WEIGHTS = np.array([pow(_STEP, i, 1 << 64) for i in range(_POWERS)], dtype=np.uint64)
_LEAPS = np.uint64(pow(_STEP, _POWERS, 1 << 64))


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the bounds of its rows; a null has none."""
    if pa.types.is_null(column.type):
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    wide = column.cast(pa.large_binary())
    if wide.null_count:
        wide = wide.fill_null(b"")
    if not len(wide):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    bounds = np.frombuffer(wide.buffers()[1], np.int64)[wide.offset : wide.offset + len(wide) + 1]
    data = np.frombuffer(wide.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]]
    return data, bounds - bounds[0]


def _stretches(data: np.ndarray, is_word: np.ndarray) -> Iterator[tuple[int, int]]:
    """Bounds of parts that do not cut a word, of about ``STRETCH`` bytes."""
    start, size = 0, len(data)
    while start < size:
        stop = min(start + STRETCH, size)
        while stop < size:
            gap = np.flatnonzero(~is_word[data[stop : stop + 4096]])
            if len(gap):
                stop += int(gap[0])
                break
            stop = min(stop + 4096, size)
        yield start, stop
        start = stop


def word_hashes(
    data: np.ndarray,
    bounds: np.ndarray,
    is_word: np.ndarray = NOT_WHITE,
    fold: np.ndarray = LOWER,
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and the bounds of each text's words among them."""
    hashes, starts, _ = word_spans(data, bounds, is_word, fold)
    return hashes, np.searchsorted(starts, bounds)


def blocks(bounds: np.ndarray, size: int = 2 * STRETCH) -> Iterator[tuple[int, int]]:
    """Ranges of texts with about ``size`` bytes in all, or one text with more."""
    start, count = 0, len(bounds) - 1
    while start < count:
        stop = int(np.searchsorted(bounds, bounds[start] + size, side="right")) - 1
        stop = min(max(stop, start + 1), count)
        yield start, stop
        start = stop


def word_spans(
    data: np.ndarray,
    bounds: np.ndarray,
    is_word: np.ndarray = NOT_WHITE,
    fold: np.ndarray = LOWER,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all words in order, and the bytes where each one starts and stops."""
    letters = _LETTERS[fold]
    hashes = [np.empty(0, np.uint64)]
    places, sizes = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for start, stop in _stretches(data, is_word):
        part = data[start:stop]
        inside = is_word[part]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        low, high = np.searchsorted(bounds, [start, stop])
        edges = bounds[low:high] - start
        first[edges] |= inside[edges]
        at = np.flatnonzero(inside)
        if not len(at):
            continue
        begins = np.flatnonzero(first)
        heads = np.searchsorted(at, begins)
        lengths = np.diff(heads, append=len(at))
        within = np.arange(len(at)) - np.repeat(heads, lengths)
        terms = letters[part[at]]
        if lengths.max() > _POWERS:
            terms *= _power(within)
        else:
            terms *= _WEIGHTS[within]
        sums = np.add.reduceat(terms, heads)
        hashes.append(mixed(sums + lengths.astype(np.uint64)))
        places.append(begins + start)
        sizes.append(lengths)
    starts = np.concatenate(places)
    return np.concatenate(hashes), starts, starts + np.concatenate(sizes)


def _power(places: np.ndarray) -> np.ndarray:
    """_STEP to the given powers, for words longer than the table."""
    high, low = np.divmod(places, _POWERS)
    leaps = np.cumprod(np.concatenate([[np.uint64(1)], np.full(int(high.max()), _LEAPS)]))
    return _WEIGHTS[low] * leaps.astype(np.uint64)[high]
