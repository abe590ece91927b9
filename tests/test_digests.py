import hashlib

import numpy as np
import pytest

from twinsieve.functions import digests


def heads(parts):
    data = b"".join(parts)
    ends = np.cumsum([len(p) for p in parts])
    starts = ends - [len(p) for p in parts]
    found = digests.sha1_heads(np.frombuffer(data, np.uint8), starts, ends)
    expected = [int.from_bytes(hashlib.sha1(p).digest()[:4], "little") for p in parts]
    assert found.tolist() == expected


@pytest.mark.parametrize("strings", [1 << 14, 100])
def test_heads_of_all_lengths(monkeypatch, strings):
    monkeypatch.setattr(digests, "_STRINGS", strings)
    rng = np.random.default_rng(4)
    heads([rng.bytes(size) for size in range(130) for _ in range(9)])
    heads([b"", b"\xff" * 55] * 400)


def test_few_and_long_strings_take_the_call(monkeypatch):
    monkeypatch.setattr(digests, "_first_word", None)
    heads([])
    heads([b"abc", b"", b"x" * 55, b"y" * 56])
    heads([bytes([i % 256]) * 56 for i in range(2000)])
    with pytest.raises(TypeError):
        heads([b"abc"] * 2000)


def test_overlapping_slices():
    data = np.frombuffer(b"a b c d e f g h " * 300, np.uint8)
    starts = np.arange(0, 4000)
    found = digests.sha1_heads(data, starts, starts + 35)
    for at in (0, 1, 3999):
        digest = hashlib.sha1(data[at : at + 35].tobytes()).digest()
        assert found[at] == int.from_bytes(digest[:4], "little")
