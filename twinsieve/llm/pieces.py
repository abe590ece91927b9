"""SentencePiece encoding and decoding as a weighted finite-state transducer.

A model file is compiled to three transducers: the normaliser (spaces become U+2581, and one is put
in front), the lexicon (each piece is an arc from its characters to its id, weighted with its
negated score), and the fallback (a character in no piece is an arc to the ids of its bytes). An
input is composed with them by walking the lexicon from each position, which gives a lattice, and
the encoding is the path of least weight in the tropical semiring.

In a model of merges a plain least path would not be the encoding: merges happen in the order of
their scores. There the lattice is also composed with an acceptor of neighbouring pieces. Two pieces
may stand next to each other only if merging their joined characters gives these two pieces again;
merging a text gives just the one segmentation whose neighbours all may. The acceptor's arcs are
made when a pair is first met, and kept up to a bound in bytes.

Between two characters that no piece holds next to each other, a text falls into runs and parts of
runs that are encoded by themselves. Such places are before a space mark, around a line end, and
mostly between letters and punctuation. A worker remembers the ids of some of them, up to
a bound in bytes.

Defined results: null gives null. An empty text has no ids, and no ids give an empty text. Decoding
takes bytes that are no UTF-8 as U+FFFD. A text that holds U+2581 itself comes back with a
space in its place, as the model has one symbol for both. Ids out of range are an error. Rows are
encoded each for itself. An empty table gives an empty result.
"""

from __future__ import annotations

import re
import struct
from array import array
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

SPACE = "▁"
# Bytes that a Python worker spends on each of its memories: ids of parts, of runs after a space mark and
# of other runs, and which pieces follow each other. A memory is emptied when full. Runs of more
# characters are not remembered.
REMEMBERED_BYTES = 160 << 20
LONGEST_RUN = 128
# About what an entry takes besides its characters and ids, and what a table of followers takes.
_ENTRY, _FOLLOWER, _FOLLOWERS = 220, 160, 400
# Rows that a worker encodes at a time.
ROWS = 512
# Kinds of piece in a model file.
_NORMAL, _UNKNOWN, _CONTROL, _USER, _UNUSED, _BYTE = 1, 2, 3, 4, 5, 6
_MERGES = 2
_NOWHERE = object()


@dataclass(frozen=True)
class Piece:
    text: str
    score: float
    kind: int


@dataclass(frozen=True)
class ModelFile:
    pieces: tuple[Piece, ...]
    merges: bool
    charsmap: bytes
    dummy_prefix: bool
    remove_extra_spaces: bool


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a protocol buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = number()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, number()
            continue
        size = number() if kind == 2 else 8 if kind == 1 else 4
        yield tag >> 3, data[at : at + size]
        at += size


def read_model(path: str) -> ModelFile:
    with open(path, "rb") as file:
        data = file.read()
    pieces: list[Piece] = []
    merges, charsmap, dummy, extra = False, b"", True, True
    for number, value in _fields(data):
        if number == 1:
            found = dict(_fields(value))
            score = struct.unpack("<f", found[2])[0] if 2 in found else 0.0
            pieces.append(Piece(found.get(1, b"").decode(), score, found.get(3, _NORMAL)))
        elif number == 2:
            merges = dict(_fields(value)).get(3, 1) == _MERGES
        elif number == 3:
            spec = dict(_fields(value))
            charsmap = spec.get(2, b"")
            dummy, extra = bool(spec.get(3, 1)), bool(spec.get(4, 1))
    if charsmap:
        raise ValueError("models with a character map are not supported")
    return ModelFile(tuple(pieces), merges, charsmap, dummy, extra)


class Transducer:
    """A compiled model."""

    def __init__(self, model: ModelFile):
        self.model = model
        self.ids = {
            p.text: i
            for i, p in enumerate(model.pieces)
            if p.kind in (_NORMAL, _USER, _UNUSED) and p.text
        }
        if any(p.kind == _USER for p in model.pieces):
            raise ValueError("models with pieces defined by users are not supported")
        byte_ids = {p.text: i for i, p in enumerate(model.pieces) if p.kind == _BYTE}
        self.byte_ids = [byte_ids[f"<0x{b:02X}>"] for b in range(256)] if byte_ids else None
        self.unknown = next((i for i, p in enumerate(model.pieces) if p.kind == _UNKNOWN), 0)
        # The lexicon: each start of a piece, with the weight of the piece that ends there.
        self.lexicon: dict[str, float | None] = {
            t[:n]: None for t in self.ids for n in range(1, len(t))
        }
        self.lexicon |= {t: -model.pieces[i].score for t, i in self.ids.items()}
        ranks = {w: i for i, w in enumerate(sorted({self.lexicon[t] for t in self.ids}))}
        self.ranks = {t: ranks[self.lexicon[t]] for t in self.ids}
        # Pieces that were met next to each other; the table is emptied when its bytes are spent.
        self.allowed: dict[str, dict[str, bool]] = {}
        self.held = 0
        joined = [t for t in self.ids if len(t) > 1]
        self.inside = {t[i : i + 2] for t in joined for i in range(len(t) - 1)}
        self.spaces_lead = not any(SPACE in t.lstrip(SPACE) for t in joined)
        self.line_ends_apart = not any("\n" in t for t in joined)
        self.outputs = [self._output(p) for p in model.pieces]

    def _output(self, piece: Piece) -> bytes:
        if piece.kind == _BYTE:
            return bytes([int(piece.text[1:-1], 16)])
        if piece.kind == _CONTROL:
            return b""
        if piece.kind == _UNKNOWN:
            return " ⁇ ".encode()
        return piece.text.replace(SPACE, " ").encode()

    def may_follow(self, left: str, right: str) -> bool:
        """Whether merging the joined characters gives these two pieces."""
        fits = self.followers(left).get(right)
        if fits is None:
            fits = self._merge_apart(left, right)
            self._spend(_FOLLOWER + 2 * len(right))
            self.followers(left)[right] = fits
        return fits

    def followers(self, left: str) -> dict[str, bool]:
        """What is known of the pieces after one."""
        known = self.allowed.get(left)
        if known is None:
            self._spend(_FOLLOWERS + 2 * len(left))
            known = self.allowed[left] = {}
        return known

    def _spend(self, size: int) -> None:
        if self.held + size > REMEMBERED_BYTES:
            self.allowed.clear()
            self.held = 0
        self.held += size

    def _merge_apart(self, left: str, right: str) -> bool:
        """Merge the best neighbours again and again, the first ones of equals; false as soon as
        a merge crosses the border."""
        never, rank = len(self.ranks), self.ranks.get
        parts = [*left, *right]
        border, done = len(left), [left, right]
        best = [rank(a + b, never) for a, b in zip(parts, parts[1:], strict=False)]
        while parts != done:
            least = min(best)
            at = best.index(least)
            if least == never or at == border - 1:
                return False
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del best[at]
            if at < border:
                border -= 1
            if at:
                best[at - 1] = rank(parts[at - 1] + parts[at], never)
            if at < len(best):
                best[at] = rank(parts[at] + parts[at + 1], never)
        return left + right not in self.ranks

    def arcs(self, run: str, start: int) -> Iterator[tuple[int, str, float]]:
        """(end, piece, weight) of the lattice's arcs from a position."""
        end, lexicon = start, self.lexicon
        while end < len(run):
            end += 1
            text = run[start:end]
            weight = lexicon.get(text, _NOWHERE)
            if weight is _NOWHERE or weight is None:
                if end == start + 1:
                    yield end, text, 0.0
                if weight is _NOWHERE:
                    return
            else:
                yield end, text, weight

    def shortest(self, run: str) -> list[str]:
        """The pieces along the path of least weight over a run."""
        return self._only_path(run) if self.model.merges else self._least_path(run)

    def _least_path(self, run: str) -> list[str]:
        least = [0.0] + [float("inf")] * len(run)
        before = [0] * (len(run) + 1)
        for start in range(len(run)):
            for end, _, weight in self.arcs(run, start):
                if least[start] + weight < least[end]:
                    least[end], before[end] = least[start] + weight, start
        path: list[str] = []
        at = len(run)
        while at:
            path.append(run[before[at] : at])
            at = before[at]
        return path[::-1]

    def _only_path(self, run: str) -> list[str]:
        """With the acceptor of neighbours, one piece at most ends a path at each position: the
        last one of the encoding of the characters before it. All other weights are infinite."""
        size = len(run)
        last: list[str | None] = [None] * (size + 1)
        lexicon, allowed = self.lexicon, self.allowed
        for start in range(size):
            before = last[start]
            if before is None:
                if start:
                    continue
                known = None
            else:
                known = allowed.get(before)
                if known is None:
                    known = self.followers(before)
            end = start
            while end < size:
                end += 1
                text = run[start:end]
                weight = lexicon.get(text, _NOWHERE)
                if end > start + 1:
                    if weight is _NOWHERE:
                        break
                    if weight is None:
                        continue
                if known is None:
                    last[end] = text
                else:
                    fits = known.get(text)
                    if fits is None:
                        fits = self.may_follow(before, text)
                    if fits:
                        last[end] = text
                if weight is _NOWHERE:
                    break
        path: list[str] = []
        at = size
        while at:
            piece = last[at]
            path.append(piece)
            at -= len(piece)
        return path[::-1]

    def apart(self, run: str) -> list[str]:
        """A run cut wherever no piece holds the two characters next to each other."""
        inside, parts, start = self.inside, [], 0
        for i in range(1, len(run)):
            if run[i - 1 : i + 1] not in inside:
                parts.append(run[start:i])
                start = i
        parts.append(run[start:])
        return parts

    def run_ids(self, run: str) -> list[int]:
        ids: list[int] = []
        for piece in self.shortest(run):
            found = self.ids.get(piece)
            if found is not None:
                ids.append(found)
            elif self.byte_ids:
                ids += [self.byte_ids[b] for b in piece.encode("utf-8", "replace")]
            else:
                ids.append(self.unknown)
        return ids

    def normalized(self, text: str) -> str:
        if self.model.remove_extra_spaces:
            text = re.sub(" +", " ", text.strip(" "))
        if not text:
            return ""
        return (SPACE if self.model.dummy_prefix else "") + text.replace(" ", SPACE)

    def decoded(self, ids: Sequence[int]) -> str:
        text = b"".join(map(self.outputs.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if self.model.dummy_prefix and text[:1] == " " else text


class _Memory(dict):
    """Ids by run, as bytes of little-endian 32-bit numbers, of bounded size in bytes."""

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
    """Ids of parts of runs met before."""

    def __init__(self, transducer: Transducer):
        super().__init__()
        self.transducer = transducer

    def __missing__(self, part: str) -> bytes:
        found = array("I", self.transducer.run_ids(part)).tobytes()
        self.remember(part, found)
        return found


class RunIds(_Memory):
    """Ids of runs met before. The key is what follows a space mark, or with an empty ``mark`` the
    run itself."""

    def __init__(self, parts: _PartIds, mark: str):
        super().__init__()
        self.parts, self.mark = parts, mark

    def __missing__(self, run: str) -> bytes:
        parts = self.parts.transducer.apart(self.mark + run)
        found = b"".join(map(self.parts.__getitem__, parts))
        self.remember(run, found)
        return found


_RUNS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


class Encoder:
    def __init__(self, path: str):
        self.transducer = Transducer(read_model(path))
        parts = _PartIds(self.transducer)
        self.marked, self.bare = RunIds(parts, SPACE), RunIds(parts, "")

    def ids(self, text: str) -> bytes:
        """Ids of a text, as bytes of little-endian 32-bit numbers."""
        machine = self.transducer
        plain = machine.normalized(text)
        if not plain:
            return b""
        if not machine.spaces_lead:
            return self.bare[plain]
        lines = plain.split("\n") if machine.line_ends_apart else [plain]
        return self.bare["\n"].join(map(self._line, lines)) if len(lines) > 1 else self._line(plain)

    def _line(self, line: str) -> bytes:
        if SPACE + SPACE in line or line.endswith(SPACE):
            return b"".join(map(self.bare.__getitem__, _RUNS.findall(line)))
        head, *rest = line.split(SPACE)
        first = self.bare[head] if head else b""
        return first + b"".join(map(self.marked.__getitem__, rest))


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def _ids_column(machine: Encoder, column: pa.Array) -> tuple[pa.Array, list[bytes | None]]:
    found = [None if t is None else machine.ids(t) for t in column.to_pylist()]
    sizes = [0 if f is None else len(f) // 4 for f in found]
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    data = np.frombuffer(b"".join(f or b"" for f in found), np.int32)
    empty = pa.array([f is None for f in found])
    return pa.ListArray.from_arrays(offsets, pa.array(data), mask=empty), found


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of few rows, which bounds what a worker holds besides its memory of runs."""
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            yield batch.slice(start, ROWS)


def encoded(df: DataFrame, model_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids) of each row, ids as an array of INT."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = encoder(model_path)
        for batch in _parts(batches):
            ids, _ = _ids_column(machine, batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], names=["id", "ids"])

    rows = df.select(F.col(key).alias("id"), F.col(text).cast("string"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(scan, f"id {kind}, ids array<int>").withColumnRenamed("id", key)


def decoded(df: DataFrame, model_path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(key, text) of each row."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = encoder(model_path).transducer
        for batch in _parts(batches):
            found = batch.column(1).to_pylist()
            texts = [None if f is None else machine.decoded(f) for f in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string())], names=["id", "text"]
            )

    rows = df.select(F.col(key).alias("id"), F.col(ids).cast("array<int>").alias("ids"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(scan, f"id {kind}, text string").toDF(key, "text")


def round_trip(
    df: DataFrame, model_path: str, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(key, ids, text): the ids of each row, and the text that they give again, in one pass."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = encoder(model_path)
        decode = machine.transducer.decoded
        for batch in _parts(batches):
            ids, found = _ids_column(machine, batch.column(1))
            texts = [None if f is None else decode(memoryview(f).cast("I")) for f in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), ids, pa.array(texts, pa.string())], names=["id", "ids", "text"]
            )

    rows = df.select(F.col(key).alias("id"), F.col(text).cast("string"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(scan, f"id {kind}, ids array<int>, text string").toDF(key, "ids", text)
