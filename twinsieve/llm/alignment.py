"""Alignment of two tokenizers over the same texts, by products of sparse incidence matrices.

A text becomes a row of bytes: a space and its UTF-8 bytes. Each tokenizer cuts it into tokens, which
gives an incidence matrix of tokens by bytes, kept as compressed sparse rows (``Csr``). The product of
the first matrix with the transpose of the second one, computed row by row (Gustavson's method),
holds a value wherever a token of either side overlaps: the number of bytes they share. Offsets
where tokens of both sides end cut the text into groups; the product of the two incidence matrices
of tokens by groups links all tokens of a group. Its number of values is known from the row lengths
alone, so it is made only where it is asked for.

The corpus then says how often two ids are linked: in how many documents. Each document is staged
once with its different id pairs, so texts are encoded once. Pairs are counted in the tasks before
they are shuffled. The most frequent pairs, ``most`` at most, are looked up in a broadcast table; a
document's other pairs, each of which occurs in few documents, are joined.

Defined results: texts that are null or empty, or whose tokens do not spell a space and the text, have
no tokens: all counts are 0 and the digest is ''. Strings of special tokens are plain text. Rows are
aligned each for itself, whatever their ids; repeated rows count as documents of their own. Very long
texts are encoded in parts that no token crosses, and multiplied in stretches of rows. An
empty table gives an empty result. Other columns of the table are not looked at.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from twinsieve.llm.text import blocks, column_bytes
from twinsieve.sources.tables import fill_cluster
from twinsieve.sources.workspace import Workspace

# Bytes of text that are aligned together, and characters that are encoded together.
BLOCK = 1 << 20
SEGMENT = 1 << 17
# Id pairs that a task counts before it passes them on.
COUNTED = 1 << 21
# A table too small to give each core a split of this size is spread over the cores first.
SPLIT_BYTES = 16 << 20
# Last byte that may lead a character below U+0240. Classes of those are the same to all libraries.
_LATIN_LEAD = 0xC8
_SPACE = "▁"


@dataclass(frozen=True)
class AlignParams:
    """Files of a byte-level BPE model and of a SentencePiece model, and the pairs to broadcast."""

    first: str
    second: str
    most: int = 1 << 20


@dataclass(frozen=True)
class Csr:
    """A sparse matrix as compressed rows: row i has the columns and values from bounds[i] on."""

    bounds: np.ndarray
    columns: np.ndarray
    values: np.ndarray
    width: int

    @property
    def height(self) -> int:
        return len(self.bounds) - 1

    def rows(self) -> np.ndarray:
        """The row of each value."""
        return np.repeat(np.arange(self.height), np.diff(self.bounds))

    def part(self, start: int, stop: int) -> Csr:
        low, high = self.bounds[start], self.bounds[stop]
        bounds = self.bounds[start : stop + 1] - low
        return Csr(bounds, self.columns[low:high], self.values[low:high], self.width)

    def transposed(self) -> Csr:
        order = np.argsort(self.columns, kind="stable")
        bounds = np.concatenate([[0], np.cumsum(np.bincount(self.columns, minlength=self.width))])
        return Csr(bounds, self.rows()[order], self.values[order], self.height)


def product(left: Csr, right: Csr) -> Csr:
    """Gustavson's row product: row i is the sum of the rows of ``right`` that row i names."""
    sizes = np.diff(right.bounds)[left.columns]
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    at = np.arange(total) + np.repeat(right.bounds[left.columns] - (ends - sizes), sizes)
    rows, columns = np.repeat(left.rows(), sizes), right.columns[at]
    values = np.repeat(left.values, sizes) * right.values[at]
    same_row = rows[1:] == rows[:-1]
    if (same_row & (columns[1:] < columns[:-1])).any():
        order = np.lexsort((columns, rows))
        rows, columns, values = rows[order], columns[order], values[order]
    new = np.ones(total, bool)
    new[1:] = ~(same_row & (columns[1:] == columns[:-1]))
    heads = np.flatnonzero(new)
    sums = np.add.reduceat(values, heads) if total else values
    counts = np.bincount(rows[heads], minlength=left.height)
    return Csr(np.concatenate([[0], np.cumsum(counts)]), columns[heads], sums, right.width)


def product_size(left: Csr, right: Csr) -> np.ndarray:
    """Terms of each row of the product, without making it."""
    sums = np.concatenate([[0], np.cumsum(np.diff(right.bounds)[left.columns])])
    return sums[left.bounds[1:]] - sums[left.bounds[:-1]]


def byte_incidence(ends: np.ndarray) -> Csr:
    """Tokens by bytes, of tokens that follow each other and end at the given bytes."""
    bounds = np.concatenate([[0], ends])
    size = int(bounds[-1])
    return Csr(bounds, np.arange(size), np.ones(size, np.int64), size)


def group_incidence(groups: np.ndarray, count: int) -> Csr:
    """Tokens by groups, of tokens that are each in one group."""
    size = len(groups)
    return Csr(np.arange(size + 1), groups, np.ones(size, np.int64), count)


@dataclass(frozen=True)
class Vocabulary:
    """The bytes of each id."""

    data: np.ndarray
    bounds: np.ndarray

    @staticmethod
    def of(tokens: list[bytes]) -> Vocabulary:
        bounds = np.concatenate([[0], np.cumsum([len(t) for t in tokens])])
        return Vocabulary(np.frombuffer(b"".join(tokens), np.uint8), bounds.astype(np.int64))

    def sizes(self, ids: np.ndarray) -> np.ndarray:
        return self.bounds[ids + 1] - self.bounds[ids]

    def spelled(self, ids: np.ndarray) -> np.ndarray:
        sizes = self.sizes(ids)
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        at = np.arange(total) + np.repeat(self.bounds[ids] - (ends - sizes), sizes)
        return self.data[at]

    def __len__(self) -> int:
        return len(self.bounds) - 1


def _byte_of_char() -> dict[str, int]:
    """The byte for which a character stands in a byte-level vocabulary: printable ones stand for
    themselves, characters from 256 on for the others."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class _First:
    """The byte-level tokenizer, without special tokens."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        byte = _byte_of_char()
        words = spec["model"]["vocab"]
        tokens = [b""] * (max(self.tokenizer.get_vocab(with_added_tokens=True).values()) + 1)
        for word, number in words.items():
            tokens[number] = bytes(map(byte.__getitem__, word)) if set(word) <= byte.keys() else b""
        for added in spec.get("added_tokens", ()):
            tokens[added["id"]] = added["content"].encode()
        self.vocabulary = Vocabulary.of(tokens)
        self.quick = self._ranked(spec, tokens)

    @staticmethod
    def _ranked(spec: dict, tokens: list[bytes]) -> tiktoken.Encoding | None:
        """The same model as ranked byte strings, if its merges are in the order of their ids."""
        model, split = spec["model"], spec.get("pre_tokenizer") or {}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model.get("merges", ())]
        plain = {
            split.get("type") == "ByteLevel",
            not split.get("add_prefix_space", True),
            split.get("use_regex", True),
            spec.get("normalizer") is None,
            not model.get("dropout"),
            not model.get("ignore_merges"),
        }
        in_order = all(model["vocab"].get(a + b) == 256 + i for i, (a, b) in enumerate(merges))
        if plain != {True} or not in_order:
            return None
        ranks = {tokens[i]: i for i in range(256 + len(merges))}
        if len(ranks) != 256 + len(merges):
            return None
        # Fixed value: how byte-level models of this kind split a text before they merge.
        pattern = (
            r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        )
        return tiktoken.Encoding(
            "ranked", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
        )

    def ids(self, part: str, latin: bool) -> list[int]:
        if latin and self.quick is not None and len(part) <= 2 * SEGMENT:
            return self.quick.encode_ordinary(part)
        return self.tokenizer.encode(part, add_special_tokens=False).ids


class _Second:
    """The SentencePiece model."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.encode = model.encode
        tokens, self.spaces_lead = [], True
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            is_byte = model.is_byte(i)
            tokens.append(
                bytes([int(piece[3:-1], 16)]) if is_byte else piece.replace(_SPACE, " ").encode()
            )
            self.spaces_lead &= is_byte or _SPACE not in piece.lstrip(_SPACE)
        self.vocabulary = Vocabulary.of(tokens)


_INNER_SPACE = re.compile(r"(?<=\S) (?=\S)")


def segments(text: str, size: int = SEGMENT) -> list[str]:
    """Parts of a text that are encoded each by itself, a space before each: no token of either
    side crosses a single space from the left."""
    parts, start = [], 0
    while len(text) - start > 2 * size:
        found = _INNER_SPACE.search(text, start + size)
        if found is None:
            break
        parts.append(text[start : found.start()])
        start = found.end()
    parts.append(text[start:])
    return parts


@dataclass(frozen=True)
class Alignment:
    """Texts that have tokens, one after the other, and their links.

    Token ids and the byte where each token ends, per side; the number of tokens before each text
    (``first_bounds``, ``second_bounds``); the group of each token, and the number of groups before
    each text; and ``overlap``, first by second tokens.
    """

    texts: np.ndarray
    first_ids: np.ndarray
    first_ends: np.ndarray
    first_bounds: np.ndarray
    second_ids: np.ndarray
    second_ends: np.ndarray
    second_bounds: np.ndarray
    first_groups: np.ndarray
    second_groups: np.ndarray
    group_bounds: np.ndarray
    overlap: Csr

    def group_factors(self) -> tuple[Csr, Csr]:
        """Tokens by groups, and groups by tokens: their product links all tokens of a group."""
        count = int(self.group_bounds[-1])
        first = group_incidence(self.first_groups, count)
        return first, group_incidence(self.second_groups, count).transposed()

    def group_links(self) -> Csr:
        return product(*self.group_factors())

    def links_before(self) -> np.ndarray:
        """The number of links before each text."""
        return self.overlap.bounds[self.first_bounds]


class Aligner:
    """Both tokenizers, and the alignment of many texts at once."""

    def __init__(self, first: str, second: str):
        self.first, self.second = _First(first), _Second(second)

    def _encoded(self, text: str, latin: bool) -> tuple[list[int], list[int]]:
        if len(text) <= 2 * SEGMENT or not self.second.spaces_lead:
            return self.first.ids(" " + text, latin), self.second.encode(text)
        parts = segments(text)
        first = [i for part in parts for i in self.first.ids(" " + part, latin)]
        return first, [i for part in parts for i in self.second.encode(part)]

    def aligned(self, data: np.ndarray, bounds: np.ndarray) -> Alignment:
        """Texts as UTF-8 bytes with their bounds; ``texts`` tells which of them have tokens."""
        kept: list[int] = []
        ids: tuple[list[np.ndarray], list[np.ndarray]] = ([], [])
        vocabularies = self.first.vocabulary, self.second.vocabulary
        for i in np.flatnonzero(np.diff(bounds)).tolist():
            raw = data[bounds[i] : bounds[i + 1]]
            found = self._encoded(raw.tobytes().decode(), bool(raw.max() <= _LATIN_LEAD))
            sides = [np.array(f, np.int64) for f in found]
            if all(self._spells(v, s, raw) for v, s in zip(vocabularies, sides, strict=True)):
                kept.append(i)
                ids[0].append(sides[0])
                ids[1].append(sides[1])
        return self._linked(np.array(kept, np.int64), *ids)

    @staticmethod
    def _spells(vocabulary: Vocabulary, ids: np.ndarray, raw: np.ndarray) -> bool:
        sizes = vocabulary.sizes(ids)
        if int(sizes.sum()) != len(raw) + 1 or not sizes.all():
            return False
        spelled = vocabulary.spelled(ids)
        return spelled[0] == 0x20 and bool((spelled[1:] == raw).all())

    def _linked(
        self, texts: np.ndarray, first: list[np.ndarray], second: list[np.ndarray]
    ) -> Alignment:
        def joined(parts: list[np.ndarray], vocabulary: Vocabulary) -> tuple[np.ndarray, ...]:
            ids = np.concatenate([np.empty(0, np.int64), *parts])
            bounds = np.concatenate([[0], np.cumsum([len(p) for p in parts], dtype=np.int64)])
            return ids, np.cumsum(vocabulary.sizes(ids)), bounds

        a, a_ends, a_bounds = joined(first, self.first.vocabulary)
        b, b_ends, b_bounds = joined(second, self.second.vocabulary)
        common = np.intersect1d(a_ends, b_ends, assume_unique=True)
        text_ends = a_ends[a_bounds[1:] - 1]
        return Alignment(
            texts,
            a,
            a_ends,
            a_bounds,
            b,
            b_ends,
            b_bounds,
            np.searchsorted(common, a_ends),
            np.searchsorted(common, b_ends),
            np.concatenate([[0], np.searchsorted(common, text_ends, side="right")]),
            overlaps(a_ends, b_ends),
        )


def overlaps(first_ends: np.ndarray, second_ends: np.ndarray, stretch: int = BLOCK) -> Csr:
    """First by second tokens with the bytes they share, in stretches of rows of bounded size."""
    rights = np.concatenate([[0], second_ends])
    lefts = np.concatenate([[0], first_ends])
    parts: list[Csr] = []
    start = 0
    while start < len(first_ends):
        stop = int(np.searchsorted(lefts, lefts[start] + stretch, side="right")) - 1
        stop = min(max(stop, start + 1), len(first_ends))
        low, high = lefts[start], lefts[stop]
        # The second side's tokens of these bytes; those at the borders are cut there.
        before = int(np.searchsorted(rights, low, side="right")) - 1
        after = int(np.searchsorted(rights, high))
        inner = np.minimum(rights[before + 1 : after + 1], high) - low
        left = byte_incidence(first_ends[start:stop] - low)
        part = product(left, byte_incidence(inner).transposed())
        parts.append(Csr(part.bounds, part.columns + before, part.values, len(second_ends)))
        start = stop
    sizes = np.concatenate([np.empty(0, np.int64), *[np.diff(p.bounds) for p in parts]])
    columns = np.concatenate([np.empty(0, np.int64), *[p.columns for p in parts]])
    values = np.concatenate([np.empty(0, np.int64), *[p.values for p in parts]])
    bounds = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    return Csr(bounds, columns, values, len(second_ends))


@lru_cache(maxsize=2)
def aligner(first: str, second: str) -> Aligner:
    return Aligner(first, second)


@lru_cache(maxsize=4)
def _decimals(count: int) -> Vocabulary:
    """The decimal numbers below ``count``, each with a byte after it."""
    return Vocabulary.of([b"%d," % i for i in range(count)])


def group_texts(found: Alignment, number: Vocabulary) -> Iterator[bytes]:
    """Per text: the groups as ``a1,a2|b1;a3|b2,b3``, ids written by ``number``."""
    a, b, n = found.first_groups, found.second_groups, int(found.group_bounds[-1])
    first_size, second_size = np.bincount(a, minlength=n), np.bincount(b, minlength=n)
    # Each token's place: groups in order, in each the first side's tokens, then the second's.
    place_a = np.arange(len(a)) + (np.cumsum(second_size) - second_size)[a]
    place_b = np.arange(len(b)) + np.cumsum(first_size)[b]
    ids = np.empty(len(a) + len(b), np.int64)
    ids[place_a], ids[place_b] = found.first_ids, found.second_ids
    text = number.spelled(ids)
    ends = np.cumsum(number.sizes(ids))
    whole = np.cumsum(first_size + second_size)
    text[ends[whole - second_size - 1] - 1] = ord("|")
    text[ends[whole - 1] - 1] = ord(";")
    tokens = (found.first_bounds + found.second_bounds)[1:]
    stops = ends[tokens - 1]
    for start, stop in zip(np.concatenate([[0], stops])[:-1], stops, strict=True):
        yield text[start : stop - 1].tobytes()


def _id_pairs(found: Alignment, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different id pairs of each text, ascending, as first * width + second; how often each
    is linked; and the number of pairs before each text."""
    links, before = found.overlap, found.links_before()
    code = found.first_ids[links.rows()] * width + found.second_ids[links.columns]
    text = np.repeat(np.arange(len(found.texts)), np.diff(before))
    order = np.lexsort((code, text))
    code, text = code[order], text[order]
    new = np.ones(len(code), bool)
    new[1:] = (code[1:] != code[:-1]) | (text[1:] != text[:-1])
    heads = np.flatnonzero(new)
    times = np.diff(np.append(heads, len(code)))
    bounds = np.searchsorted(text[heads], np.arange(len(found.texts) + 1))
    return code[heads], times, bounds


_COUNTS = ("n_a", "n_b", "n_groups", "n_links", "n_group_links")
_SUMMARY = ", ".join(f"{n} bigint" for n in _COUNTS) + (
    ", groups_sha256 string, pairs binary, times binary"
)


def _summary(machine: Aligner, data: np.ndarray, bounds: np.ndarray) -> list[pa.Array]:
    found = machine.aligned(data, bounds)
    count = len(bounds) - 1
    width = len(machine.second.vocabulary)
    code, times, pair_bounds = _id_pairs(found, width)
    terms = np.concatenate([[0], np.cumsum(product_size(*found.group_factors()))])
    steps = (
        found.first_bounds,
        found.second_bounds,
        found.group_bounds,
        found.links_before(),
        terms[found.first_bounds],
    )
    columns = []
    for step in steps:
        numbers = np.zeros(count, np.int64)
        numbers[found.texts] = np.diff(step)
        columns.append(pa.array(numbers))
    digests = [""] * count
    packed: list[list[bytes]] = [[b""] * count, [b""] * count]
    texts = group_texts(found, _decimals(max(len(machine.first.vocabulary), width)))
    for k, (i, text) in enumerate(zip(found.texts.tolist(), texts, strict=True)):
        digests[i] = hashlib.sha256(text).hexdigest()
        part = slice(pair_bounds[k], pair_bounds[k + 1])
        packed[0][i] = code[part].astype("<i8").tobytes()
        packed[1][i] = times[part].astype("<u4").tobytes()
    return [*columns, pa.array(digests), *[pa.array(p, pa.binary()) for p in packed]]


def summaries(
    df: DataFrame, params: AlignParams, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(key, token, group and link counts, digest of the groups, different id pairs) of each row."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = aligner(params.first, params.second)
        for batch in batches:
            data, bounds = column_bytes(batch.column(1))
            for i, j in blocks(bounds, BLOCK):
                part = data[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i]
                columns = [batch.column(0).slice(i, j - i), *_summary(machine, *part)]
                yield pa.RecordBatch.from_arrays(columns, names=_names)

    rows = df.select(F.col(key).alias("__key"), F.col(text).cast("string"))
    schema = f"__key {rows.schema['__key'].dataType.simpleString()}, {_SUMMARY}"
    _names = ["__key", *_COUNTS, "groups_sha256", "pairs", "times"]
    return rows.mapInArrow(scan, schema).withColumnRenamed("__key", key)


_ARRAYS = ("a_ids", "b_ids", "a_groups", "b_groups", "link_a", "link_b", "link_bytes")


def alignments(
    df: DataFrame, params: AlignParams, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(key, ids of both sides, the group of each token, links as places of tokens with the bytes
    shared), arrays of INT, from 0 in each text."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = aligner(params.first, params.second)
        for batch in batches:
            data, bounds = column_bytes(batch.column(1))
            for i, j in blocks(bounds, BLOCK):
                found = machine.aligned(data[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i])
                columns = _lists(found, j - i)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), *columns], names=["__key", *_ARRAYS]
                )

    rows = df.select(F.col(key).alias("__key"), F.col(text).cast("string"))
    schema = f"__key {rows.schema['__key'].dataType.simpleString()}, " + ", ".join(
        f"{n} array<int>" for n in _ARRAYS
    )
    return rows.mapInArrow(scan, schema).withColumnRenamed("__key", key)


def _lists(found: Alignment, count: int) -> list[pa.Array]:
    a, b, links = found.first_bounds, found.second_bounds, found.links_before()

    def column(values: np.ndarray, bounds: np.ndarray, less: np.ndarray | None = None) -> pa.Array:
        if less is not None:
            values = values - np.repeat(less[:-1], np.diff(bounds))
        sizes = np.zeros(count, np.int64)
        sizes[found.texts] = np.diff(bounds)
        offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        return pa.ListArray.from_arrays(offsets, pa.array(values.astype(np.int32)))

    return [
        column(found.first_ids, a),
        column(found.second_ids, b),
        column(found.first_groups, a, found.group_bounds),
        column(found.second_groups, b, found.group_bounds),
        column(found.overlap.rows(), links, a),
        column(found.overlap.columns, links, b),
        column(found.overlap.values, links),
    ]


def pair_counts(staged: DataFrame, width: int) -> DataFrame:
    """(code, n, best): documents that link each id pair, and whether no pair of its first id has
    more. Tasks add up what they can hold, so a frequent pair is few rows of the shuffle."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[np.ndarray] = []
        known, counts = np.empty(0, np.int64), np.empty(0, np.int64)

        def merged() -> tuple[np.ndarray, np.ndarray]:
            codes = np.concatenate([known, *waiting])
            weights = np.concatenate([counts, np.ones(len(codes) - len(known), np.int64)])
            different, place = np.unique(codes, return_inverse=True)
            sums = np.bincount(place, weights, minlength=len(different))
            return different, sums.astype(np.int64)

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(known), pa.array(counts)], names=["code", "n"]
            )

        for batch in batches:
            data, _ = column_bytes(batch.column(0))
            codes = data.view("<i8")
            for at in range(0, len(codes), COUNTED):
                waiting.append(codes[at : at + COUNTED])
                if sum(map(len, waiting)) >= COUNTED:
                    known, counts = merged()
                    waiting.clear()
                    if len(known) >= COUNTED:
                        yield rows()
                        known, counts = np.empty(0, np.int64), np.empty(0, np.int64)
        known, counts = merged()
        yield rows()

    found = staged.select("pairs").mapInArrow(scan, "code bigint, n bigint")
    counted = found.groupBy("code").agg(F.sum("n").alias("n"))
    # One row for each id of the first vocabulary, whatever the corpus.
    first = F.floor(F.col("code") / F.lit(width)).alias("first")
    highest = counted.groupBy(first).agg(F.max("n").alias("highest"))
    joined = counted.withColumn("first", first).join(F.broadcast(highest), "first")
    return joined.select("code", "n", (F.col("n") == F.col("highest")).alias("best"))


def frequent_from(counted: DataFrame, most: int) -> int:
    """The least power of two of documents that no more than ``most`` pairs reach."""
    level = F.floor(F.log2("n")).cast("int").alias("level")
    levels = {r["level"]: r["count"] for r in counted.groupBy(level).count().collect()}
    total = 0
    for level in sorted(levels, reverse=True):
        total += levels[level]
        if total > most:
            return 1 << (level + 1)
    return 1


def aligned(
    df: DataFrame,
    params: AlignParams,
    workspace: Workspace,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, n_group_links)."""
    row = F.monotonically_increasing_id().alias("__row")
    rows = fill_cluster(df.select(key, text), key, split_bytes=SPLIT_BYTES)
    staged = workspace.stage(summaries(rows, params, key, text).select("*", row), "aligned")
    width = sentencepiece.SentencePieceProcessor(model_file=params.second).get_piece_size()
    counted = workspace.stage(pair_counts(staged, width), "pair-counts")
    least = frequent_from(counted, params.most)
    table = counted.where(F.col("n") >= least).orderBy("code").toArrow()
    codes, numbers = (table[n].to_numpy() for n in ("code", "n"))
    frequent = codes, numbers, table["best"].to_numpy()
    shared = df.sparkSession.sparkContext.broadcast(frequent)
    names = [n for n in staged.columns if n not in ("pairs", "times")]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs, bounds = column_bytes(batch.column("pairs"))
            times = column_bytes(batch.column("times"))[0].view("<u4").astype(np.int64)
            found = _looked_up(pairs.view("<i8"), times, bounds // 8, shared.value)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in names], *found],
                names=[*names, "n_best", "count_sum", "rest"],
            )

    kinds = [f"`{n}` {staged.schema[n].dataType.simpleString()}" for n in names]
    sums = ["n_best bigint", "count_sum bigint", "rest array<struct<code: bigint, times: bigint>>"]
    found = staged.mapInArrow(scan, ", ".join([*kinds, *sums]))
    if least > 1:
        found = _with_rest(workspace.stage(found, "sums"), counted.where(F.col("n") < least))
    columns = [key, "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return found.select(*columns, "n_group_links")


def _looked_up(
    codes: np.ndarray, times: np.ndarray, bounds: np.ndarray, frequent: tuple[np.ndarray, ...]
) -> list[pa.Array]:
    known, numbers, best = frequent
    at = np.minimum(np.searchsorted(known, codes), max(len(known) - 1, 0))
    hit = known[at] == codes if len(known) else np.zeros(len(codes), bool)
    at = at[hit]
    weights = np.zeros((2, len(codes) + 1), np.int64)
    weights[0, 1:][hit] = times[hit] * best[at]
    weights[1, 1:][hit] = times[hit] * numbers[at]
    sums = np.cumsum(weights, axis=1)
    rest = np.flatnonzero(~hit)
    offsets = np.searchsorted(rest, bounds).astype(np.int32)
    pairs = pa.StructArray.from_arrays(
        [pa.array(codes[rest]), pa.array(times[rest])], names=["code", "times"]
    )
    columns = [pa.array(s[bounds[1:]] - s[bounds[:-1]]) for s in sums]
    return [*columns, pa.ListArray.from_arrays(offsets, pairs)]


def _with_rest(found: DataFrame, rare: DataFrame) -> DataFrame:
    """The rows with the sums of the pairs outside the table. More than ``most`` pairs occur in at
    least half as many documents as a rare one may, so no key of the join is hot."""
    pairs = found.select("__row", F.inline("rest").alias("code", "times"))
    added = pairs.join(rare, "code").groupBy("__row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
        F.sum(F.col("times") * F.col("n")).alias("more_count"),
    )
    joined = found.drop("rest").join(added, "__row", "left")
    sums = {
        name: F.col(name) + F.coalesce(more, F.lit(0))
        for name, more in (("n_best", "more_best"), ("count_sum", "more_count"))
    }
    return joined.withColumns(sums)
