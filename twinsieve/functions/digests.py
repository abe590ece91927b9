"""First words of the SHA-1 digests of many short byte strings at once.

A call for each string costs several times the digest itself. Here each step of the digest is one
array operation over thousands of strings; those of more than one block of 64 bytes take the call.
"""

from __future__ import annotations

import hashlib
import sys

import numpy as np
from pyspark import cloudpickle

# The helpers below travel with the tasks, so the executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Bytes that fit into one block with the end mark and the length, and the size of the block.
_MOST, _BLOCK = 55, 64
# Strings that are digested at a time: the work arrays stay inside a core's cache.
_STRINGS = 1 << 14
# Strings below this number take the call, as the array steps have a fixed cost.
_FEW = 1 << 9
_START = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476, 0xC3D2E1F0)
_ROUND = tuple(np.uint32(k) for k in (0x5A827999, 0x6ED9EBA1, 0x8F1BBCDC, 0xCA62C1D6))


def _paddings() -> tuple[np.ndarray, np.ndarray]:
    """For each length the mask of the string's bytes in a block, and the bytes after them."""
    mask = np.zeros((_MOST + 1, _BLOCK), np.uint8)
    tail = np.zeros_like(mask)
    for size in range(_MOST + 1):
        mask[size, :size] = 0xFF
        tail[size, size] = 0x80
        tail[size, -2:] = divmod(8 * size, 256)
    return mask.view(np.uint64), tail.view(np.uint64)


_MASK, _TAIL = _paddings()


def sha1_heads(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The first four SHA-1 bytes of each ``data[start:end]``, as little-endian 32-bit numbers."""
    out = np.empty(len(starts), np.uint32)
    sizes = ends - starts
    short = sizes <= _MOST
    if np.count_nonzero(short) < _FEW:
        short[:] = False
    long = np.flatnonzero(~short)
    if len(long):
        raw, sha1 = data.tobytes(), hashlib.sha1
        slices = zip(starts[long].tolist(), ends[long].tolist())
        digests = b"".join([sha1(raw[s:e]).digest() for s, e in slices])
        out[long] = np.frombuffer(digests, "<u4")[::5]
    if len(long) == len(out):
        return out
    padded = np.concatenate([data, np.zeros(_BLOCK, np.uint8)])
    # A block from each byte on, without a copy until some of them are taken.
    blocks = np.ndarray(len(data) + 1, f"V{_BLOCK}", padded, strides=(1,))
    chosen = np.flatnonzero(short)
    for some in np.array_split(chosen, -(-len(chosen) // _STRINGS)):
        rows = blocks[starts[some]].view(np.uint64).reshape(len(some), -1)
        rows &= _MASK[sizes[some]]
        rows |= _TAIL[sizes[some]]
        words = np.ascontiguousarray(rows.view(">u4").T, dtype=np.uint32)
        out[some] = _first_word(words).byteswap()
    return out


def _first_word(w: np.ndarray) -> np.ndarray:
    """The first word of the SHA-1 digests of one-block messages; ``w`` (16, n) is overwritten."""
    a, b, c, d, e = (np.full(w.shape[1], word, np.uint32) for word in _START)
    f, t, u = (np.empty_like(a) for _ in range(3))
    for i in range(80):
        x = w[i % 16]
        if i >= 16:
            for back in (3, 8, 14):
                x ^= w[(i - back) % 16]
            _rotate(x, 1, x, t)
        part = i // 20
        if part == 0:
            np.bitwise_xor(c, d, out=f)
            f &= b
            f ^= d
        elif part == 2:
            np.bitwise_or(b, c, out=f)
            f &= d
            np.bitwise_and(b, c, out=t)
            f |= t
        else:
            np.bitwise_xor(b, c, out=f)
            f ^= d
        e += f
        e += x
        e += _ROUND[part]
        _rotate(a, 5, u, t)
        e += u
        _rotate(b, 30, b, t)
        a, b, c, d, e = e, a, b, c, d
    return a + np.uint32(_START[0])


def _rotate(x: np.ndarray, bits: int, out: np.ndarray, work: np.ndarray) -> None:
    np.right_shift(x, np.uint32(32 - bits), out=work)
    np.left_shift(x, np.uint32(bits), out=out)
    out |= work
