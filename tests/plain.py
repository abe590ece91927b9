"""Plain Python answers to compare with, written from the definitions."""

import hashlib
import re

import numpy as np

EDGE_TEXTS = [
    None,
    "",
    "    ",
    "one two three four",
    "one two three four five",
    " one two  three four five ",
    "été déjà vu à côté où",
    "ok 🙂 yes 🙂🙂 no, never; maybe_so",
    "日本語 の テキスト です よ ね",
    "same same same same same same same",
    "line\nbreak\ttab\r\nand_under_score 12 34",
    "İstanbul ſ K",  # letters whose case folding reaches into ASCII
]


def tokens(text):
    return re.split("[^A-Za-z_0-9]", text)


def shingles(text, n=5, min_tokens=5):
    words = tokens(text) if text is not None else []
    if len(words) < min_tokens:
        return set()
    return {" ".join(words[i : i + n]) for i in range(len(words) - n + 1)}


def hash32(value):
    return int.from_bytes(hashlib.sha1(value.encode()).digest()[:4], "little")


def signature(text, pairs, n=5, min_tokens=5):
    hashes = {hash32(s) for s in shingles(text, n, min_tokens)}
    if not hashes:
        return None
    prime = 2**61 - 1
    return [
        min(((h * a + b) % 2**64) % prime % 2**32 for h in hashes) for a, b in pairs
    ]


def star_edges(signatures, bands, rows):
    """signatures: {id: list}"""
    buckets = {}
    for key, values in signatures.items():
        for band in range(bands):
            slot = (band, tuple(values[band * rows : (band + 1) * rows]))
            buckets.setdefault(slot, []).append(key)
    return {(n, min(b)) for b in buckets.values() for n in b if n != min(b)}


def components(edges):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        low, high = sorted((root(a), root(b)))
        parent[high] = low
    return {x: root(x) for x in list(parent) if root(x) != x}


def pairs(frame, *columns):
    return {tuple(row[c] for c in columns) for row in frame.collect()}


def random_texts(count, seed, vocabulary=30):
    rng = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(vocabulary)]
    marks = [" ", ", ", ". ", "\n", " é "]
    texts = []
    for _ in range(count):
        size = int(rng.integers(1, 60))
        parts = [words[rng.integers(vocabulary)] + marks[rng.integers(5)] for _ in range(size)]
        texts.append("".join(parts))
    return texts
