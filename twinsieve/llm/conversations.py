"""Repair of conversation structure, by a Viterbi search in parallel over chunks.

The roles of a repaired conversation are an optional system turn, then user and assistant in turn; it
may be empty. Each row is kept (cost 0), given the role user or assistant (2) or deleted (3; the only
choice for a blank or a repeated row), and turns without text can be inserted anywhere (2); a truncated
row that stays adds 1. The search runs backwards over the rows. Its vector holds, for each of the four
states of the role pattern, the least cost to the end of the conversation.

Rows are placed by a range sort of (conversation, turn), so a conversation of any length is spread over
partitions, and cut into chunks of ``chunk_rows`` rows. All chunks are searched at once (rank
convergence, after Maleki, Musuvathi and Mytkowicz, PPoPP 2014): the last chunk of a conversation
starts from the true vector, the others from a speculative one. A step only depends on the
differences inside a vector, so a result stays right if the vector it came from was right but
for a constant. In fix-up passes the chunks whose start has changed by more than a constant run again,
and stop as soon as the old and the new vector differ by a constant only. The constants
add up to the cost. With the stitched vectors each chunk is traced forward, from each of the
states it may be entered in, by the least letter among the best choices, which gives the least
audit. Last, the rows of a conversation pass by in order once: the state is carried from chunk to
chunk, the trace from that state is taken, and the repaired text goes into the digest.

What one task holds is a chunk's letters and one batch of rows. Only the audit, which is one value of
the result, grows with its conversation.

Defined results: nulls in any column count as one space (a null text is blank, a null role is none of
the three); null ids are one conversation. Rows without a turn come first; rows with the same turn
follow each other by role and text. Every conversation of the table has a row, also one without rows
after damage. An empty table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from twinsieve.operators.skew import HOT_ROWS, with_group_min
from twinsieve.sources.workspace import Workspace

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
_COST = {KEEP: 0, REROLE: 2, DELETE: 3, INSERT: 2}
# States of the role pattern: nothing yet, after system, after user, after assistant.
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_STATES = (_START, _SYSTEM, _USER, _ASSISTANT)
_AFTER = {
    (_START, "s"): _SYSTEM,
    (_START, "u"): _USER,
    (_SYSTEM, "u"): _USER,
    (_USER, "a"): _ASSISTANT,
    (_ASSISTANT, "u"): _USER,
}
# The user or assistant turn that may come next in a state, and the state after it.
_NEXT = tuple(("assistant", _ASSISTANT) if q == _USER else ("user", _USER) for q in _STATES)
# The cost of ending in each state: the turns that are missing.
_END = (0, 4, 2, 0)
_LETTERS = "sua"
_PLAIN, _TRUNCATED, _FORCED = range(3)
_SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
_PREFIX = 32


@dataclass(frozen=True)
class RepairParams:
    chunk_rows: int = 1 << 16
    hot_rows: int = HOT_ROWS


def code_of(initial: Column, fault: Column) -> Column:
    """A row as the search sees it: 3 * (system, user, assistant, other) + fault."""
    role = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    return (3 * role + fault).cast("byte")


Vector = tuple[int, ...]


def _options(code: int, state: int) -> Iterator[tuple[str, int]]:
    """What may be done with a row in a state, by ascending letter: (letter, state after it)."""
    role, fault = divmod(code, 3)
    yield DELETE, state
    yield INSERT, _NEXT[state][1]
    if fault == _FORCED:
        return
    if role < 3 and (state, _LETTERS[role]) in _AFTER:
        yield KEEP, _AFTER[state, _LETTERS[role]]
    yield REROLE, _NEXT[state][1]


def _price(code: int, letter: str) -> int:
    stays = letter in (KEEP, REROLE) and code % 3 == _TRUNCATED
    return _COST[letter] + stays


@dataclass
class Steps:
    """One step of the search and of the trace for each (vector, row), made when first met.

    Vectors are kept without their least value. Their values differ by a few turns' costs at most,
    so there are few of them."""

    back: dict[tuple[Vector, int], tuple[Vector, int]] = field(default_factory=dict)
    forth: dict[tuple[Vector, int, int], tuple[str, int]] = field(default_factory=dict)

    def before(self, after: Vector, code: int) -> tuple[Vector, int]:
        """The vector before a row, less its least value, and that value."""
        found = self.back.get((after, code))
        if found is None:
            raw = self._raw(after, code)
            least = min(raw)
            found = self.back[after, code] = tuple(v - least for v in raw), least
        return found

    def _raw(self, after: Vector, code: int) -> list[int]:
        cost = [
            min(
                _price(code, letter) + after[q]
                for letter, q in _options(code, state)
                if letter != INSERT
            )
            for state in _STATES
        ]
        # No more turns than there are states can be worth inserting in a row.
        for _ in _STATES:
            cost = [min(c, 2 + cost[_NEXT[q][1]]) for q, c in enumerate(cost)]
        return cost

    def letters(self, after: Vector, code: int, state: int) -> tuple[str, int]:
        """The least letters of the best way past a row from a state, and the state after it."""
        found = self.forth.get((after, code, state))
        if found is None:
            before, text, at = self._raw(after, code), "", state
            while not text or text[-1] == INSERT:
                for letter, q in _options(code, at):
                    rest = before[q] if letter == INSERT else after[q]
                    if _price(code, letter) + rest == before[at]:
                        text, at = text + letter, q
                        break
            found = self.forth[after, code, state] = text, at
        return found


def search(steps: Steps, codes: bytes, end: Vector) -> tuple[Vector, int]:
    """The vector before a chunk's rows, less its least value, and the sum of the constants."""
    total = 0
    for code in reversed(codes):
        end, least = steps.before(end, code)
        total += least
    return end, total


def search_again(
    steps: Steps, codes: bytes, old: Vector, new: Vector, head: Vector
) -> tuple[Vector, int]:
    """The vector before the rows for a new end, and the number of rows done until it and the
    old one differ by a constant only; ``head`` is the old result."""
    for done, code in enumerate(reversed(codes)):
        if old == new:
            return head, done
        old, new = steps.before(old, code)[0], steps.before(new, code)[0]
    return new, len(codes)


def trace(steps: Steps, codes: bytes, end: Vector, last: bool) -> tuple[list[str], int]:
    """The letters from each state at a chunk's start, and the sum of the constants."""
    vectors, total = [end], 0
    for code in reversed(codes):
        end, least = steps.before(end, code)
        vectors.append(end)
        total += least
    vectors.reverse()
    texts = []
    for state in _STATES:
        parts = []
        for code, after in zip(codes, vectors[1:], strict=True):
            text, state = steps.letters(after, code, state)
            parts.append(text)
        if last:
            parts.append(INSERT * (_END[state] // 2))
        texts.append("".join(parts))
    return texts, total


# Damage, faults and order


def damaged(
    df: DataFrame, conv: str, turn: str, role: str, text: str, damage: bool = True
) -> DataFrame:
    """(conv, turn, role, text, gone) after damage. Dropped rows stay, as ``gone``."""

    def filled(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    if not damage:
        return df.select(
            F.col(conv).alias("conv"),
            F.col(turn).cast("bigint").alias("turn"),
            filled(role).alias("role"),
            filled(text).alias("text"),
            F.lit(False).alias("gone"),
        )
    mark = F.crc32(F.concat(filled(conv), F.lit(":"), filled(turn))) % 20
    content = F.when(mark == 1, F.lit("")).when(
        mark == 2, F.regexp_replace(filled(text), "[.!?]", "")
    )
    rows = df.select(
        F.col(conv).alias("conv"),
        F.col(turn).cast("bigint").alias("turn"),
        F.when(mark == 4, F.lit("user")).otherwise(filled(role)).alias("role"),
        F.coalesce(content, filled(text)).alias("text"),
        (mark == 0).alias("gone"),
        F.explode(F.array_repeat(F.lit(0), F.when(mark == 3, 2).otherwise(1))).alias("copy"),
    )
    return rows.drop("copy")


_ORDER = ["conv", "turn", "role", "start", "same"]


def _sortable(rows: DataFrame) -> DataFrame:
    """With ``start``, which orders the rows of a turn, and ``same``, which equal rows of a
    conversation share, whatever their turn."""
    conv = F.coalesce(F.concat(F.lit("="), F.col("conv").cast("string")), F.lit(""))
    sizes = [F.length(c).cast("string") for c in (conv, F.col("role"))]
    digest = F.unhex(F.sha2(F.concat_ws(":", *sizes, conv, "role", "text"), 256))
    return rows.withColumns(
        {
            "start": F.substring(F.encode("text", "UTF-8"), 1, _PREFIX),
            "same": F.substring(digest, 1, 16),
        }
    )


def _placed(rows: DataFrame, workspace: Workspace) -> DataFrame:
    """The rows without their texts, by ascending ``place``. Equal rows may spread over several
    partitions, as a salt ends the range."""
    end = F.substring(F.rtrim("text", F.lit(_SPACES)), -1, 1)
    narrow = rows.where("NOT gone").select(
        *_ORDER,
        F.substring("role", 1, 1).alias("initial"),
        (end == "").alias("blank"),
        (~end.isin("", ".", "!", "?")).alias("cut"),
        F.monotonically_increasing_id().alias("salt"),
    )
    ordered = narrow.repartitionByRange(*_ORDER, "salt").sortWithinPartitions(*_ORDER, "salt")
    place = F.monotonically_increasing_id().alias("place")
    return workspace.stage(ordered.drop("salt").select("*", place), "placed")


_FAULTS = ("blank", "duplicate", "truncated")


def _chunks(placed: DataFrame, workspace: Workspace, params: RepairParams) -> DataFrame:
    """A row for each conversation's part of each chunk: its rows as codes, its faults, the keys
    of its first row, and whether it is the first and the last part of its conversation."""
    marked = with_group_min(
        placed, ["same"], "place", "earliest", workspace, "heavy_rows", params.hot_rows
    )
    repeated = ~F.col("blank") & (F.col("place") > F.col("earliest"))
    cut = ~repeated & F.col("cut")
    fault = F.when(F.col("blank") | repeated, _FORCED).when(cut, _TRUNCATED).otherwise(_PLAIN)
    local = F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    rows = marked.select(
        *_ORDER,
        "place",
        code_of(F.col("initial"), fault).alias("code"),
        "blank",
        repeated.alias("duplicate"),
        cut.alias("truncated"),
        F.shiftright("place", 33).alias("part"),
        F.floor(local / params.chunk_rows).alias("chunk"),
    )
    kind = placed.schema["conv"].dataType.simpleString()
    schema = (
        f"conv {kind}, turn bigint, role string, start binary, same binary, place bigint, "
        "n bigint, codes binary, blank bigint, duplicate bigint, truncated bigint"
    )
    parts = workspace.stage(rows.groupBy("part", "chunk").applyInArrow(_chunk, schema), "parts")
    along = Window.partitionBy("conv").orderBy("place")
    ends = {"first": F.lag("n").over(along).isNull(), "last": F.lead("n").over(along).isNull()}
    return workspace.stage(parts.withColumns(ends), "chunks")


def _chunk(rows: pa.Table) -> pa.Table:
    rows = rows.sort_by("place").combine_chunks()
    conv = rows["conv"].combine_chunks().dictionary_encode(null_encoding="encode")
    number = conv.indices.to_numpy(zero_copy_only=False)
    heads = np.flatnonzero(np.concatenate([[True], number[1:] != number[:-1]]))
    sizes = np.diff(np.append(heads, len(number)))
    codes = rows["code"].to_numpy().astype(np.uint8)
    offsets = np.append(heads, len(number)).astype(np.int32)
    packed = pa.Array.from_buffers(
        pa.binary(), len(heads), [None, pa.py_buffer(offsets), pa.py_buffer(codes.tobytes())]
    )
    counts = {
        name: pa.array(np.add.reduceat(rows[name].to_numpy().astype(np.int64), heads))
        for name in _FAULTS
    }
    first = rows.select([*_ORDER, "place"]).take(pa.array(heads))
    return pa.table(
        {c: first[c] for c in first.column_names} | {"n": pa.array(sizes), "codes": packed} | counts
    )


# Search and trace


_VECTOR = pa.list_(pa.int32())


def _searched(chunks: DataFrame) -> DataFrame:
    """With ``tail``, the speculative vector after each chunk, and ``head``, the one before it;
    null if all its rows have to go, which leaves any vector as it is."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps = Steps()
        for batch in batches:
            heads = []
            for codes in batch.column("codes").to_pylist():
                is_open = any(code % 3 != _FORCED for code in codes)
                heads.append(search(steps, codes, _END)[0] if is_open else None)
            tails = pa.array([_END] * len(heads), _VECTOR)
            columns = [*batch.columns, tails, pa.array(heads, _VECTOR)]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "tail", "head"])

    rows = chunks.select("conv", "place", "codes")
    kind = rows.schema["conv"].dataType.simpleString()
    return rows.mapInArrow(scan, f"conv {kind}, place bigint, codes binary, {_ENDS}")


_ENDS = "tail array<int>, head array<int>"


def _fixed_up(rows: DataFrame) -> DataFrame:
    """One pass: chunks whose next chunk's ``head`` is not their ``tail`` run again. ``redone``
    counts the rows that took."""
    back = Window.partitionBy("conv").orderBy(F.col("place").desc())
    before = back.rowsBetween(Window.unboundedPreceding, -1)
    end = F.array(*[F.lit(v) for v in _END])
    following = F.coalesce(F.last("head", ignorenulls=True).over(before), end)
    names = ["conv", "place", "codes", "tail", "head"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps = Steps()
        for batch in batches:
            heads, redone = [], []
            lists = [batch.column(n).to_pylist() for n in ("codes", "tail", "head", "following")]
            for codes, tail, head, new in zip(*lists, strict=True):
                done = 0
                if tail != new and head is not None:
                    vectors = map(tuple, (tail, new, head))
                    head, done = search_again(steps, codes, *vectors)
                heads.append(head)
                redone.append(done)
            columns = [batch.column(n) for n in ("conv", "place", "codes", "following")]
            heads = pa.array(heads, _VECTOR)
            yield pa.RecordBatch.from_arrays(
                [*columns, heads, pa.array(redone, pa.int64())], names=[*names, "redone"]
            )

    kind = rows.schema["conv"].dataType.simpleString()
    return rows.select(*names).withColumn("following", following).mapInArrow(
        scan, f"conv {kind}, place bigint, codes binary, {_ENDS}, redone bigint"
    )


def stitched(
    chunks: DataFrame, workspace: Workspace, passes: list[int] | None = None
) -> DataFrame:
    """(conv, place, tail) of the chunks of conversations that have several.

    A pass leaves one more chunk of each conversation right at least, so the passes end; as
    vectors converge within a few rows there are few. ``passes`` is given the rows redone in each.
    """
    state = workspace.stage(_searched(chunks.where("NOT (first AND last)")), "searched")
    if state.isEmpty():
        return state.select("conv", "place", "tail")
    while True:
        following = workspace.stage(_fixed_up(state), "fixed-up")
        redone = following.agg(F.sum("redone")).first()[0]
        workspace.drop(state)
        state = following
        if passes is not None:
            passes.append(redone)
        if not redone:
            return state.select("conv", "place", "tail")


def _traced(chunks: DataFrame) -> DataFrame:
    """With the ``letters`` from each state, the sum of constants, and the least cost at the start."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps = Steps()
        names = [n for n in batch_names if n not in ("codes", "tail")]
        for batch in batches:
            letters, totals, starts = [], [], []
            lists = [batch.column(n).to_pylist() for n in ("codes", "tail", "last")]
            for codes, tail, last in zip(*lists, strict=True):
                tail = tuple(tail)
                texts, total = trace(steps, codes, tail, last)
                letters.append(texts)
                totals.append(total)
                starts.append(search(steps, codes, tail)[0][_START])
            columns = [
                *[batch.column(n) for n in names],
                pa.array(letters, pa.list_(pa.string())),
                pa.array(totals, pa.int64()),
                pa.array(starts, pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "letters", "total", "least"])

    batch_names = chunks.columns
    kept = [f for f in chunks.schema.fields if f.name not in ("codes", "tail")]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept)
    return chunks.mapInArrow(
        scan, f"{schema}, letters array<string>, total bigint, least bigint"
    )


# The rows of a conversation, in order


class _Passage:
    """One conversation while its rows pass by."""

    def __init__(self, conv: object):
        self.conv = conv
        self.state = _START
        self.waiting: deque[tuple[int, list[str]]] = deque()
        self.letters, self.at, self.left = "", 0, 0
        self.audit: list[str] = []
        self.faults = [0, 0, 0]
        self.cost: int | None = None
        self.turns, self.lowest, self.turn = 0, 0, None
        self.initial: str | None = None
        self.illegal = 0

    def chunk(self, row: dict) -> None:
        self.waiting.append((row["n"], row["letters"]))
        self.faults = [f + row[name] for f, name in zip(self.faults, _FAULTS, strict=True)]
        if self.cost is None:
            self.cost = row["least"]
        self.cost += row["total"]

    def row(self, turn: int | None, role: str, text: bytes) -> Iterator[tuple[str, str, bytes]]:
        """The turns that come of a row: (letter, role, text)."""
        if turn is not None and turn != self.turn:
            self.lowest = turn if self.turn is None else self.lowest
            self.turns, self.turn = self.turns + 1, turn
        if self.initial is not None and self.initial + role[:1] not in ("su", "ua", "au"):
            self.illegal += 1
        self.initial = role[:1]
        if not self.left:
            self.left, choices = self.waiting.popleft()
            self.letters, self.at = choices[self.state], 0
            self.audit.append(self.letters)
        self.left -= 1
        yield from self._inserted()
        letter = self.letters[self.at]
        self.at += 1
        if letter == KEEP:
            self.state = _AFTER[self.state, role[:1]]
            yield letter, role, text
        elif letter == REROLE:
            role, self.state = _NEXT[self.state]
            yield letter, role, text

    def _inserted(self) -> Iterator[tuple[str, str, bytes]]:
        while self.letters[self.at : self.at + 1] == INSERT:
            self.at += 1
            role, self.state = _NEXT[self.state]
            yield INSERT, role, b""

    def end(self) -> Iterator[tuple[str, str, bytes]]:
        if self.left or self.waiting:
            raise RuntimeError(f"rows of conversation {self.conv} have changed between two scans")
        yield from self._inserted()

    def gaps(self) -> int:
        return 0 if self.turn is None else self.turn - self.lowest + 1 - self.turns


_CHUNK_FIELDS = ("n", "letters", "total", "least", *_FAULTS)


def _in_order(rows: DataFrame, chunks: DataFrame) -> DataFrame:
    """Rows and chunks of each conversation in one partition, a chunk before its first row."""
    texts = rows.select(
        *_ORDER,
        F.when(~F.col("gone"), F.encode("text", "UTF-8")).alias("text"),
        F.lit(1).alias("kind"),
        F.lit(None).cast("bigint").alias("place"),
        *[F.lit(None).cast(chunks.schema[n].dataType).alias(n) for n in _CHUNK_FIELDS],
    )
    heads = chunks.select(
        *_ORDER,
        F.lit(None).cast("binary").alias("text"),
        F.lit(0).alias("kind"),
        "place",
        *_CHUNK_FIELDS,
    )
    both = texts.unionByName(heads).repartition("conv")
    return both.sortWithinPartitions(*_ORDER, "kind", "place").drop("start", "same", "place")


def _passages(
    batches: Iterator[pa.RecordBatch],
) -> Iterator[tuple[_Passage, Iterator[tuple[str, str, bytes]] | None]]:
    """Each conversation with the turns that come of its next row, and None where it ends."""
    now: _Passage | None = None
    for batch in batches:
        columns = {n: batch.column(n).to_pylist() for n in batch.schema.names}
        for i, (conv, kind) in enumerate(zip(columns["conv"], columns["kind"], strict=True)):
            if now is None or now.conv != conv:
                if now is not None:
                    yield now, now.end()
                    yield now, None
                now = _Passage(conv)
            if kind == 0:
                now.chunk({n: columns[n][i] for n in _CHUNK_FIELDS})
            elif columns["text"][i] is not None:
                yield now, now.row(columns["turn"][i], columns["role"][i], columns["text"][i])
    if now is not None:
        yield now, now.end()
        yield now, None


def _prepared(
    df: DataFrame,
    workspace: Workspace,
    params: RepairParams,
    damage: bool,
    names: tuple[str, str, str, str],
) -> DataFrame:
    rows = _sortable(damaged(df, *names, damage=damage))
    chunks = _chunks(_placed(rows, workspace), workspace, params)
    tails = stitched(chunks, workspace)
    joined = chunks.join(tails.drop("conv"), "place", "left")
    end = F.array(*[F.lit(v) for v in _END])
    return _in_order(rows, _traced(joined.withColumn("tail", F.coalesce("tail", end))))


_NAMES = ("conv_id", "turn", "role", "text")


def repaired(
    df: DataFrame,
    workspace: Workspace,
    params: RepairParams = RepairParams(),
    names: tuple[str, str, str, str] = _NAMES,
    damage: bool = False,
) -> DataFrame:
    """(conversation, place, edit, role, text) of the turns of the repaired conversations."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple] = []
        place, of = 0, None
        for passage, turns in _passages(batches):
            if passage is not of:
                place, of = 0, passage
            for letter, role, text in turns or ():
                waiting.append((passage.conv, place, letter, role, text.decode()))
                place += 1
            if len(waiting) >= 4096:
                yield table(waiting)
                waiting.clear()
        yield table(waiting)

    def table(found: list[tuple]) -> pa.RecordBatch:
        columns = [
            pa.array([row[i] for row in found], kind) for i, kind in enumerate(arrow)
        ]
        return pa.RecordBatch.from_arrays(columns, names=["conv", "place", "edit", "role", "text"])

    kind = df.schema[names[0]].dataType
    arrow = [to_arrow_type(kind), pa.int64(), pa.string(), pa.string(), pa.string()]
    schema = f"conv {kind.simpleString()}, place bigint, edit string, role string, text string"
    rows = _prepared(df, workspace, params, damage, names).mapInArrow(scan, schema)
    return rows.withColumnRenamed("conv", names[0])


_COUNTS = ("gaps", *_FAULTS, "illegal", "cost")


def repairs(
    df: DataFrame,
    workspace: Workspace,
    params: RepairParams = RepairParams(),
    names: tuple[str, str, str, str] = _NAMES,
    damage: bool = False,
) -> DataFrame:
    """(conversation, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple] = []
        digest, empty = hashlib.sha256(), True
        for passage, turns in _passages(batches):
            for _, role, text in turns or ():
                digest.update((b"" if empty else b"\n") + role.encode() + b":")
                digest.update(text)
                empty = False
            if turns is not None:
                continue
            audit = "".join(passage.audit)
            counts = (passage.gaps(), *passage.faults, passage.illegal, passage.cost or 0)
            found.append((passage.conv, *counts, audit, digest.hexdigest()))
            digest, empty = hashlib.sha256(), True
            if len(found) >= 4096:
                yield table(found)
                found.clear()
        yield table(found)

    def table(found: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array([row[i] for row in found], kind) for i, kind in enumerate(arrow)]
        return pa.RecordBatch.from_arrays(columns, names=["conv", *_COUNTS, "audit", "digest"])

    kind = df.schema[names[0]].dataType
    arrow = [to_arrow_type(kind), *[pa.int64()] * len(_COUNTS), pa.string(), pa.string()]
    counts = ", ".join(f"{n} bigint" for n in _COUNTS)
    schema = f"conv {kind.simpleString()}, {counts}, audit string, digest string"
    rows = _prepared(df, workspace, params, damage, names).mapInArrow(scan, schema)
    return rows.withColumnsRenamed({"conv": names[0], "digest": "repaired_sha256"})
