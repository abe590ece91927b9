"""Substring dedup by hashing units: lines, and the clauses of longer lines.

A text is split at line ends, and after one of .,;:!? before white space. Units are compared after
normalising: A to Z in lower case, runs of space and U+0009 to U+000D as one, by a digest of 128 bits.
A unit of fewer than ``least_words`` words would recur by chance, so it is compared together with what
follows in its line, up to that many words, or at the end of the line with what precedes. What a unit
is compared by thus depends on its neighbours alone, and a passage in the middle of other text is
found wherever it stands, but for some words at its ends. A line of fewer words is compared as a
whole, or left alone if it has fewer than ``least_line``.

With ``across_lines`` units are windows of ``least_words`` words that may run over line ends up to the
text's end, so a passage of short lines is found too. A window starts at each line and clause, and one
ends at each line end and at the end of each longer clause. Lines of fewer words, and texts of fewer
in all, are compared as a whole from ``least_line`` words on. Where sixteen words have no such border,
one is chosen by content: before the three words with the smallest hash. Each character of scripts
without spaces counts as a word, and full stops of other scripts end clauses too. A repeated passage
of at least 32 words with the same line ends thus holds a window, and at most sixteen words at either
end stay. Every word of
a repeated window is removed; a window that overlaps the earliest occurrence of itself loses only the
words after that.

Digests are grouped over the whole table. The earliest occurrence by (rank, place in the text) stays;
every other one is removed, also in the same text. A removed unit takes the white space after it
along; what is left keeps its bytes. Each removed span is reported in characters of the original.

1. One scan gives (rank, place, digest) for each unit. Of a digest that a block of rows has several
   times, only the earliest goes on; the others are known to be later and leave as one list of places
   per text. So a line that a third of all rows share is one row per block.
2. Of the occurrences with equal digests all but the earliest are to be removed: one shuffle, right
   from the scan, as a written copy of all units is larger than the texts.
3. The places to remove are gathered per row, and the row's text is cut. A bit array tells the rows that
   surely lose nothing, and their texts are not shuffled.

Defined results: null texts stay null, with nothing removed. Empty texts and texts of white space
have no units. Rows with the same id are told apart by a hash of the text; if the text is the same
too, they are one row that is there several times, and keep or lose the same units. Rows without an
id rank after all others. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from twinsieve.llm.text import blocks, column_bytes, mixed, word_spans
from twinsieve.operators.key_filter import with_maybe
from twinsieve.sources.workspace import Workspace

_NEWLINE = 10
_ENDS = np.zeros(256, bool)
_ENDS[list(b".,;:!?")] = True
# The last bytes of a word that ends in a full stop or comma of another script.
_OTHER_ENDS = np.array(
    [
        int.from_bytes(c.encode()[-3:], "big")
        for c in "\u0589\u060c\u061b\u061f\u06d4\u0964\u0965\u104a\u104b\u1362\u17d4\u2026"
        "\u3001\u3002\uff01\uff0c\uff0e\uff1a\uff1b\uff1f\uff61"
    ]
)
# Scripts written without spaces, as ranges of code points [low, high).
_UNSPACED = [
    (0x0E00, 0x1000),
    (0x1000, 0x10A0),
    (0x1780, 0x1800),
    (0x2E80, 0xA4D0),
    (0xF900, 0xFB00),
    (0xFE30, 0xFE50),
    (0xFF00, 0xFFF0),
    (0x20000, 0x40000),
]
_GRAM, _REACH = 3, 16  # words that a border is chosen by, and words that hold a border
_CLOSERS = np.zeros(256, bool)
_CLOSERS[list(b"\"')]")] = True


@dataclass(frozen=True)
class UnitParams:
    least_words: int = 16
    least_line: int = 8
    across_lines: bool = False


WINDOWS = UnitParams(across_lines=True)


@dataclass(frozen=True)
class Units:
    """Units of some texts: the text of each, its bytes [start, stop) in the buffer, its digest."""

    text: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    low: np.ndarray
    high: np.ndarray

    def places(self) -> np.ndarray:
        """The number of each unit in its text."""
        first = np.searchsorted(self.text, self.text)
        return np.arange(len(self.text)) - first


def find_units(data: np.ndarray, bounds: np.ndarray, params: UnitParams) -> Units:
    """The units of the texts in a buffer."""
    borders = np.union1d(bounds, _unspaced(data)) if params.across_lines else bounds
    hashes, starts, stops = word_spans(data, borders)
    if not len(hashes):
        none = np.empty(0, np.int64)
        return Units(none, none, none, none.view(np.uint64), none.view(np.uint64))
    text = np.searchsorted(bounds, starts, side="right") - 1
    line = np.searchsorted(np.flatnonzero(data == _NEWLINE), starts)
    line_ends = np.ones(len(starts), bool)
    line_ends[:-1] = (line[1:] != line[:-1]) | (text[1:] != text[:-1])
    last = data[stops - 1]
    before = data[np.maximum(stops - 2, starts)]
    is_end = line_ends | _ENDS[last] | (_CLOSERS[last] & _ENDS[before])
    if params.across_lines:
        is_end |= _other_ends(data, starts, stops)
    ends = np.flatnonzero(is_end)
    after = ends + 1
    first = np.concatenate([[0], after[:-1]])
    if params.across_lines:
        first, after = _windows(hashes, text, line_ends, first, after, params)
        low, high = _window_digests(hashes, first, after, params)
        return Units(text[first], starts[first], _stops(starts, stops, line_ends, after), low, high)
    low_word, high_word, kept = _contexts(first, after, line_ends[ends], params)
    first, after = first[kept], after[kept]
    low_word, high_word = low_word[kept], high_word[kept]
    size = high_word - low_word
    heads = np.cumsum(size) - size
    within = np.arange(size.sum()) - np.repeat(heads, size)
    words = hashes[np.repeat(low_word, size) + within]
    turn = within.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    # Where the unit stands in what it is compared with is part of the digest.
    place = (first - low_word).astype(np.uint64)
    low, high = (
        mixed(np.add.reduceat(mixed(words + turn, salt), heads) + place, salt)
        if len(heads)
        else np.empty(0, np.uint64)
        for salt in (3, 5)
    )
    return Units(text[first], starts[first], _stops(starts, stops, line_ends, after), low, high)


def _stops(
    starts: np.ndarray, stops: np.ndarray, line_ends: np.ndarray, after: np.ndarray
) -> np.ndarray:
    """Up to the next word of the line, or to the end of the last word."""
    return np.where(
        line_ends[after - 1], stops[after - 1], starts[np.minimum(after, len(starts) - 1)]
    )


def _unspaced(data: np.ndarray) -> np.ndarray:
    """Where characters of scripts without spaces start and stop."""
    at = np.flatnonzero(data >= 0xE0)
    if not len(at):
        return at
    four = data[at] >= 0xF0
    tail = [data[np.minimum(at + i, len(data) - 1)].astype(np.int64) & 63 for i in (1, 2, 3)]
    head = data[at].astype(np.int64)
    three_bytes = (head & 15) << 12 | tail[0] << 6 | tail[1]
    point = np.where(four, (head & 7) << 18 | tail[0] << 12 | tail[1] << 6 | tail[2], three_bytes)
    inside = np.zeros(len(at), bool)
    for low, high in _UNSPACED:
        inside |= (point >= low) & (point < high)
    return np.unique(np.concatenate([at[inside], (at + 3 + four)[inside]]))


def _other_ends(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Whether the last character of each word is a full stop or comma of another script."""
    found = np.zeros(len(stops), bool)
    high = np.flatnonzero(data[stops - 1] >= 0x80)
    stop = stops[high]
    code = np.zeros(len(high), np.int64)
    for back in (3, 2, 1):
        code = code << 8 | data[np.maximum(stop - back, 0)]
    ends = np.isin(code, _OTHER_ENDS) | np.isin(code & 0xFFFF, _OTHER_ENDS)
    found[high[ends]] = True
    return found


def _chosen(hashes: np.ndarray, text: np.ndarray, first: np.ndarray) -> np.ndarray:
    """In each run of words of a text without a clause's first word, the start of the least gram."""
    span = _GRAM + _REACH - 1
    if len(hashes) < span:
        return np.empty(0, np.int64)
    count = len(hashes) - span + 1
    begun = np.zeros(len(hashes) + 1, np.int64)
    begun[first + 1] = 1
    begun = np.cumsum(begun)
    runs = np.flatnonzero(
        (begun[_REACH : _REACH + count] == begun[:count]) & (text[span - 1 :] == text[:count])
    )
    gram = hashes[: len(hashes) - _GRAM + 1].copy()
    for i in range(1, _GRAM):
        gram = mixed(gram, 7) + hashes[i : len(hashes) - _GRAM + 1 + i]
    gram = mixed(gram, 7)
    at, least = runs, gram[runs]
    for i in range(1, _REACH):
        less = gram[runs + i] < least
        at, least = np.where(less, runs + i, at), np.where(less, gram[runs + i], least)
    return np.unique(at)


def _windows(
    hashes: np.ndarray,
    text: np.ndarray,
    line_ends: np.ndarray,
    first: np.ndarray,
    after: np.ndarray,
    params: UnitParams,
) -> tuple[np.ndarray, np.ndarray]:
    """The different windows [low, high) of words, in order; clauses are [first, after)."""
    size = params.least_words
    least = min(params.least_line, size)
    text_first = np.flatnonzero(np.diff(text, prepend=-1))
    text_after = np.append(text_first[1:], len(text))
    of = np.searchsorted(text_first, np.arange(len(text)), side="right") - 1
    begin = np.append(first, _chosen(hashes, text, first))
    begin = begin[begin + size <= text_after[of[begin]]]
    line_after = np.flatnonzero(line_ends) + 1
    line_first = np.append(0, line_after[:-1])
    end = np.append(
        line_after[line_after - size >= text_first[of[line_after - 1]]],
        after[after - first > size],
    )
    low, count = [begin, end - size], [np.full(len(begin) + len(end), size)]
    for whole, stop in ((line_first, line_after), (text_first, text_after)):
        words = stop - whole
        kept = (words >= least) & (words < size)
        low.append(whole[kept])
        count.append(words[kept])
    keys = np.unique(np.concatenate(low) * (size + 1) + np.concatenate(count))
    low, count = np.divmod(keys, size + 1)
    return low, low + count


def _window_digests(
    hashes: np.ndarray, low: np.ndarray, high: np.ndarray, params: UnitParams
) -> list[np.ndarray]:
    sums = [np.zeros(len(low), np.uint64) for _ in range(2)]
    for turn in range(params.least_words):
        words = hashes[np.minimum(low + turn, len(hashes) - 1)]
        words = words + np.uint64(turn * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        for total, salt in zip(sums, (3, 5), strict=True):
            total += np.where(low + turn < high, mixed(words, salt), np.uint64(0))
    size = (high - low).astype(np.uint64)
    return [mixed(total + size, salt) for total, salt in zip(sums, (3, 5), strict=True)]


def _contexts(
    first: np.ndarray, after: np.ndarray, line_end: np.ndarray, params: UnitParams
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words that each clause is compared by, [low, high), and whether its line has enough.

    Clauses are given by their first word and the word after them, and cover all words.
    """
    count = len(first)
    last_of_line = np.flatnonzero(line_end)
    line = np.searchsorted(last_of_line, np.arange(count))
    last = last_of_line[line]
    first_of_line = np.concatenate([[0], last_of_line[:-1] + 1])[line]
    to = np.searchsorted(after, first + params.least_words)
    forward = to <= last
    back = np.searchsorted(first, after[last] - params.least_words, side="right") - 1
    low = np.where(forward, first, first[np.maximum(back, first_of_line)])
    high = np.where(forward, after[np.minimum(to, count - 1)], after[last])
    return low, high, high - low >= min(params.least_line, params.least_words)


_UNITS = "rank bigint, copy bigint, place int, places array<int>, low bigint, high bigint"


def _units(rows: DataFrame, params: UnitParams) -> DataFrame:
    """A row per unit with its ``place``, if it is the earliest in its block of rows, and a row per text
    with the ``places`` of its other units. The latter has the text's rank and copy for a digest."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = column_bytes(batch.column(2))
            ranks, copies = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for begin, end in blocks(bounds):
                part = data[bounds[begin] : bounds[end]]
                found = find_units(part, bounds[begin : end + 1] - bounds[begin], params)
                place = found.places().astype(np.int32)
                rank, copy = ranks[found.text + begin], copies[found.text + begin]
                order = np.lexsort((place, copy, rank, found.high, found.low))
                rank, copy, place = rank[order], copy[order], place[order]
                low, high = found.low[order].view(np.int64), found.high[order].view(np.int64)
                new = _changes(low, high)
                first = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
                later = (rank != rank[first]) | (copy != copy[first]) | (place != place[first])
                yield _unit_batch(rank[new], copy[new], low[new], high[new], place=place[new])
                at = np.flatnonzero(later)
                at = at[np.lexsort((place[at], copy[at], rank[at]))]
                rank, copy, place = rank[at], copy[at], place[at]
                heads = np.flatnonzero(_changes(rank, copy))
                lists = pa.ListArray.from_arrays(np.append(heads, len(at)).astype(np.int32), place)
                yield _unit_batch(rank[heads], copy[heads], rank[heads], copy[heads], places=lists)

    return rows.where("text IS NOT NULL").select("rank", "copy", "text").mapInArrow(scan, _UNITS)


def _changes(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Whether each pair is the first or differs from the one before."""
    new = np.ones(len(left), bool)
    new[1:] = (left[1:] != left[:-1]) | (right[1:] != right[:-1])
    return new


def _unit_batch(
    rank: np.ndarray,
    copy: np.ndarray,
    low: np.ndarray,
    high: np.ndarray,
    place: np.ndarray | None = None,
    places: pa.Array | None = None,
) -> pa.RecordBatch:
    columns = {
        "rank": pa.array(rank),
        "copy": pa.array(copy),
        "place": pa.nulls(len(rank), pa.int32()) if place is None else pa.array(place),
        "places": pa.nulls(len(rank), pa.list_(pa.int32())) if places is None else places,
        "low": pa.array(low),
        "high": pa.array(high),
    }
    return pa.RecordBatch.from_pydict(columns)


def repeats(rows: DataFrame, params: UnitParams) -> DataFrame:
    """(rank, copy, places) of the units to remove, for rows (rank, copy, text)."""
    # Lists come last in a group, so that one whose rank and copy equal a digest changes nothing.
    order = [F.col("places").asc_nulls_first(), "rank", "copy", "place"]
    turn = F.rank().over(Window.partitionBy("low", "high").orderBy(*order))
    repeated = _units(rows, params).withColumn("turn", turn).where("turn > 1 OR places IS NOT NULL")
    place = F.explode(F.coalesce("places", F.array("place"))).alias("place")
    return (
        repeated.select("rank", "copy", place)
        .groupBy("rank", "copy")
        .agg(F.collect_set("place").alias("places"))
    )


def cut(
    text: bytes, places: list[int], params: UnitParams
) -> tuple[str, list[dict[str, int]]]:
    """The text without the units at the given places, and their spans, neighbours joined.

    A span that is all of a line takes the line end along.
    """
    found = find_units(np.frombuffer(text, np.uint8), np.array([0, len(text)]), params)
    spans: list[list[int]] = []
    bounds = zip(found.start[places].tolist(), found.stop[places].tolist(), strict=True)
    for start, stop in _window_bounds(text, found, places) if params.across_lines else bounds:
        if spans and spans[-1][1] == start:
            spans[-1][1] = stop
        else:
            spans.append([start, stop])
    kept: list[str] = []
    removed: list[dict[str, int]] = []
    at = chars = 0
    for start, stop in spans:
        if text[stop : stop + 1] == b"\n" and (start == 0 or text[start - 1 : start] == b"\n"):
            stop += 1
        kept.append(text[at:start].decode())
        begin = chars + len(kept[-1])
        chars = begin + len(text[start:stop].decode())
        removed.append({"start": begin, "stop": chars})
        at = stop
    kept.append(text[at:].decode())
    return "".join(kept), removed


def _window_bounds(text: bytes, found: Units, places: list[int]) -> list[tuple[int, int]]:
    """The bytes to cut for windows at the given places, apart from each other, in order."""
    gone = np.zeros(len(found.text), bool)
    gone[places] = True
    # A text that holds the earliest occurrence keeps all of it.
    digests = list(zip(found.low.tolist(), found.high.tolist(), strict=True))
    upto = {digests[i]: int(found.stop[i]) for i in np.flatnonzero(~gone)}
    cuts = [
        (max(int(found.start[i]), upto.get(digests[i], 0)), int(found.stop[i])) for i in places
    ]
    spans: list[tuple[int, int]] = []
    for start, stop in sorted(cuts):
        while start < stop and text[start : start + 1].isspace():
            start += 1
        if start >= stop:
            continue
        if spans and (start <= spans[-1][1] or text[spans[-1][1] : start].isspace()):
            start, last = spans.pop()
            stop = max(stop, last)
        spans.append((start, stop))
    return spans


def deduplicated(
    df: DataFrame,
    workspace: Workspace,
    key: str = "doc_id",
    text: str = "text",
    params: UnitParams = UnitParams(),
) -> DataFrame:
    """The rows of ``df`` with repeated units cut out of ``text``, and ``removed``, the spans.

    Rows without repeats go around the cutting as they are, and all but few of them around the shuffle.
    ``df`` is read three times, which takes less than to write its units or to shuffle all of its text.
    """
    names = [f"__in{i}" for i in range(len(df.columns))]
    inner = df.toDF(*names)
    rank = F.coalesce(F.col(names[df.columns.index(key)]).cast("bigint"), F.lit((1 << 63) - 1))
    content = names[df.columns.index(text)]
    rows = inner.withColumns({"rank": rank, "copy": F.xxhash64(content)})
    found = workspace.stage(
        repeats(rows.select("rank", "copy", F.col(content).alias("text")), params), "repeats"
    )
    others, touched = _parted(rows, found)
    joined = touched.join(found, ["rank", "copy"], "left")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, removed = batch.column(content).to_pylist(), []
            for i, places in enumerate(batch.column("places").to_pylist()):
                spans: list[dict[str, int]] = []
                if places and texts[i] is not None:
                    texts[i], spans = cut(texts[i].encode(), sorted(places), params)
                removed.append(spans)
            columns = {n: batch.column(n) for n in names}
            columns[content] = pa.array(texts, pa.string())
            columns["removed"] = pa.array(removed, _SPANS)
            yield pa.RecordBatch.from_pydict(columns)

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in inner.schema.fields)
    out = joined.select(*names, "places").mapInArrow(
        scan, f"{schema}, removed array<struct<start: int, stop: int>>"
    )
    nothing = F.array().cast(out.schema["removed"].dataType).alias("removed")
    return others.select(*names, nothing).unionByName(out).toDF(*df.columns, "removed")


def _parted(rows: DataFrame, found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows that surely are not among the ``found`` ones, and the others."""
    both = F.xxhash64("rank", "copy").alias("__row_of")
    marked = with_maybe(rows.select("*", both), "__row_of", found.select(both), found.count())
    parts = (marked.where(side).drop("__row_of", "__maybe") for side in ("NOT __maybe", "__maybe"))
    return tuple(parts)


_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
