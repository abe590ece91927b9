"""Packing: documents in order, cut into sequences of bounded length by dynamic programming.

The documents of an input partition are one stream of tokens. Cuts are chosen at document ends
(free), at sentence ends (a small penalty) or inside a sentence (a larger one, offered only where a
sentence is longer than a sequence, or near the end of a stretch). The cost of a sequence is
its padding plus the penalty of the cut that ends it: padding fills it to the capacity, unless its
length is a power of two. Cutting ``at`` after an earlier cut costs

    least[at] = min(least[before] + capacity - (at - before)) + penalty, over a sliding window,
                or least[at - 2^k] + penalty where a cut may lie there.

The first minimum comes from a monotone queue over least[before] + before, so each position enters
and leaves the queue once. Stretches of about a million tokens, ending with a document, are solved
one after the other, which bounds memory; no document is moved to another partition.

Token ids are those of the tokenizer file for the whole text. It drops white space and never joins
across it, so each distinct run between white space is encoded once and remembered.

Defined results: a null text is an empty one, and gives the end id only. Rows are packed each for
itself, whatever their ids, in the order of the input. A very long document is a stretch of its own.
An empty table gives an empty result.
"""

from __future__ import annotations

import json
import re
from array import array
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

STRETCH = 1 << 20
# Bytes that a Python worker spends on each of its two memories of ids, of runs and of parts of them; a
# memory is emptied when full. Runs of more characters are not remembered.
REMEMBERED_BYTES = 96 << 20
LONGEST_RUN = 128
# About what an entry takes besides its characters and ids.
_ENTRY = 220
# White space to Python, but not to the tokenizer.
_NOT_SPACE_TO_ALL = "\x1c\x1d\x1e\x1f"
_LATIN, _DOTTED = "\u024f", "\u0130"


@dataclass(frozen=True)
class PackParams:
    """``end_id`` is added to each document; penalties are in tokens of padding."""

    tokenizer: str
    end_id: int = 2
    capacity: int = 4096
    sentence_cut: int = 8
    word_cut: int = 32
    per_sequence: int = 32


class _Memory(dict):
    """Ids by run, of bounded size in bytes."""

    held = 0

    def remember(self, run: str, ids: bytes) -> None:
        if len(run) > LONGEST_RUN:
            return
        size = _ENTRY + 2 * len(run) + len(ids)
        if self.held + size > REMEMBERED_BYTES:
            self.clear()
            self.held = 0
        self.held += size
        self[run] = ids


class _PartIds(_Memory):
    """Ids of each part that the tokenizer encodes by itself, in its normal form."""

    def __init__(self, tokenizer: Tokenizer, spec: dict):
        super().__init__()
        self.tokenize = tokenizer.model.tokenize
        self.byte_chars = _byte_chars()
        self.ranked = _ranked(spec, self.byte_chars)

    def encode(self, part: str) -> list[int]:
        data = part.encode()
        if self.ranked is not None:
            return self.ranked.piece(data + _END)
        return [t.id for t in self.tokenize(data.decode("latin-1").translate(self.byte_chars))]

    def __missing__(self, part: str) -> bytes:
        found = array("I", self.encode(part)).tobytes()
        self.remember(part, found)
        return found


# A byte that no UTF-8 text holds stands for the end of a word.
_END = b"\xff"
_SUFFIX = "</w>"


def _ranked(spec: dict, byte_chars: dict[int, int]) -> _Ranked | None:
    """The model as ranked byte strings, if its ids are bytes, bytes that end a word, and then
    the merges in their order. Merging by rank is then what the model does."""
    model = spec["model"]
    vocabulary = model["vocab"]
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    byte = {chr(byte_chars.get(b, b)): bytes([b]) for b in range(256)}
    in_order = all(vocabulary.get(a + b) == 512 + i for i, (a, b) in enumerate(merges))
    if model.get("end_of_word_suffix") != _SUFFIX or model.get("dropout") or not in_order:
        return None
    ranks = {}
    for token, number in vocabulary.items():
        if number < 512 + len(merges):
            stem = token.removesuffix(_SUFFIX)
            if not set(stem) <= byte.keys():
                return None
            ends = _END if stem != token else b""
            ranks[b"".join(map(byte.__getitem__, stem)) + ends] = number
    singles = all(ranks.get(bytes([b]), 512) < 256 for b in range(256))
    last = all(256 <= ranks.get(bytes([b]) + _END, 0) < 512 for b in range(256))
    if not singles or not last or len(ranks) != 512 + len(merges):
        return None
    return _Ranked(ranks)


class _Ranked:
    def __init__(self, ranks: dict[bytes, int]):
        self.encoding = tiktoken.Encoding(
            "ranked", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={}
        )
        self.piece = self.encoding._encode_single_piece


class WordIds(_Memory):
    """Ids of each run between white space, as bytes of little-endian 32-bit numbers."""

    def __init__(self, path: str):
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.normalize = self.tokenizer.normalizer.normalize_str
        with open(path, encoding="utf-8") as file:
            self.parts = _PartIds(self.tokenizer, json.load(file))
        # The split of the tokenizer file, for lower-case ASCII and Latin letters.
        self.ascii = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+")
        self.latin = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends_sentence = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, number in vocabulary.items():
            self.ends_sentence[number] = token.removesuffix(_SUFFIX)[-1:] in (".", "!", "?")

    def __missing__(self, word: str) -> bytes:
        found = self._encoded(word)
        self.remember(word, found)
        return found

    def _encoded(self, word: str) -> bytes:
        if "<|" in word:
            ids = self.tokenizer.encode(word, add_special_tokens=False).ids
            return array("I", ids).tobytes()
        if word.isascii():
            # Most runs are a word, and perhaps a mark.
            plain = word.lower()
            if plain.isalpha():
                return self.parts[plain]
            return b"".join(map(self.parts.__getitem__, self.ascii.findall(plain)))
        # The normal form of Latin letters is their lower case, but for one of them.
        is_latin = max(word) <= _LATIN and _DOTTED not in word
        plain = word.lower() if is_latin else self.normalize(word)
        if max(plain, default="") <= _LATIN:
            if plain.isalpha():
                return self.parts[plain]
            return b"".join(map(self.parts.__getitem__, self.latin.findall(plain)))
        if is_latin:
            plain = self.normalize(word)
        # Other scripts are left to the tokenizer's own tables of characters.
        parts = self.tokenizer.pre_tokenizer.pre_tokenize_str(plain)
        ids = [t.id for part, _ in parts for t in self.parts.tokenize(part)]
        return array("I", ids).tobytes()

    def of(self, text: str) -> bytes:
        if any(c in text for c in _NOT_SPACE_TO_ALL):
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
            return np.array(ids, "<u4").tobytes()
        return b"".join(map(self.__getitem__, text.split()))


def _byte_chars() -> dict[int, int]:
    """The character that stands for each byte in a byte-level vocabulary: printable ones are
    themselves, the others follow from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {b: 256 + i for i, b in enumerate(others)}


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def cut_places(
    total: int, document_ends: np.ndarray, sentence_ends: np.ndarray, params: PackParams
) -> tuple[np.ndarray, np.ndarray]:
    """Where sequences may end, from 0 to ``total``, and the penalty of each place."""
    penalty = np.full(total + 1, -1, np.int32)
    ends = np.concatenate([[0], np.unique(np.concatenate([document_ends, sentence_ends]))])
    gaps = np.flatnonzero(np.diff(ends) > params.capacity)
    for start, stop in zip(ends[gaps], ends[gaps + 1], strict=True):
        penalty[start + params.capacity : stop : params.capacity] = params.word_cut
    penalty[max(total - params.capacity, 0) :] = params.word_cut
    penalty[sentence_ends] = params.sentence_cut
    penalty[document_ends] = 0
    penalty[0] = penalty[total] = 0
    places = np.flatnonzero(penalty >= 0)
    return places, penalty[places]


def best_cuts(places: np.ndarray, penalties: np.ndarray, params: PackParams) -> np.ndarray:
    """The places, from 0 to the last, at which sequences start or end at the least cost."""
    capacity, count = params.capacity, len(places)
    number = np.full(int(places[-1]) + 1, -1, np.int32)
    number[places] = np.arange(count)
    jumps: list[list[int]] = [[] for _ in range(count)]
    for k in range(capacity.bit_length()):
        before = places - (1 << k)
        hit = np.flatnonzero(before >= 0)
        hit = hit[number[before[hit]] >= 0]
        for at, earlier in zip(hit.tolist(), number[before[hit]].tolist(), strict=True):
            jumps[at].append(earlier)
    where, extra = places.tolist(), (penalties + params.per_sequence).tolist()
    least, origin = [0] * count, [0] * count
    queue: deque[tuple[int, int]] = deque([(0, 0)])
    for at in range(1, count):
        place = where[at]
        while where[queue[0][1]] < place - capacity:
            queue.popleft()
        cost, source = queue[0]
        cost += capacity - place
        for earlier in jumps[at]:
            if least[earlier] < cost:
                cost, source = least[earlier], earlier
        cost += extra[at]
        least[at], origin[at] = cost, source
        rank = cost + place
        while queue and queue[-1][0] >= rank:
            queue.pop()
        queue.append((rank, at))
    cuts, at = [count - 1], count - 1
    while at:
        at = origin[at]
        cuts.append(at)
    return places[cuts[::-1]]


_PIECES = (
    "row_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, "
    "sequence_id bigint, offset bigint"
)


def packed(df: DataFrame, params: PackParams, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per piece: (key, start, length, ids, doc_tokens, sequence_id, offset)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_ids(params.tokenizer)
        end = np.array([params.end_id], "<u4").tobytes()
        base, done = TaskContext.get().partitionId() << 32, 0
        keys: list[int | None] = []
        parts: list[bytes] = []
        size = 0
        for batch in batches:
            for row, content in zip(
                batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True
            ):
                found = words.of(content or "") + end
                if parts and size + len(found) > 4 * STRETCH:
                    table, n = _pieces(keys, parts, words, params, base + done)
                    yield table
                    done, keys, parts, size = done + n, [], [], 0
                keys.append(row)
                parts.append(found)
                size += len(found)
        if parts:
            yield _pieces(keys, parts, words, params, base + done)[0]

    rows = df.select(F.col(key).cast("bigint"), F.col(text).cast("string"))
    return rows.mapInArrow(scan, _PIECES).withColumnRenamed("row_id", key)


def _pieces(
    keys: list[int | None], parts: list[bytes], words: WordIds, params: PackParams, base: int
) -> tuple[pa.RecordBatch, int]:
    lengths = np.array([len(part) // 4 for part in parts])
    data = b"".join(parts)
    ids = np.frombuffer(data, "<u4")
    ends = np.cumsum(lengths)
    starts = ends - lengths
    known = np.minimum(ids, len(words.ends_sentence) - 1)
    sentences = np.flatnonzero(words.ends_sentence[known]) + 1
    cuts = best_cuts(*cut_places(len(ids), ends, sentences, params), params)
    edges = np.union1d(cuts, starts)
    places = edges[: np.searchsorted(edges, len(ids))]
    row = np.searchsorted(starts, places, side="right") - 1
    sequence = np.searchsorted(cuts, places, side="right") - 1
    bounds = np.append(places, len(ids))
    offsets = pa.py_buffer((bounds * 4).astype(np.int32).tobytes())
    batch = pa.RecordBatch.from_arrays(
        [
            pa.array(keys, pa.int64()).take(pa.array(row)),
            pa.array(places - starts[row]),
            pa.array(np.diff(bounds)),
            pa.Array.from_buffers(pa.binary(), len(places), [None, offsets, pa.py_buffer(data)]),
            pa.array(lengths[row]),
            pa.array(base + sequence),
            pa.array(places - cuts[sequence]),
        ],
        names=["row_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
    )
    return batch, len(cuts) - 1
