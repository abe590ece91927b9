import hashlib
import itertools
import re
import zlib

import pytest
from hypothesis import given, settings, strategies as st

from twinsieve.llm import conversations
from twinsieve.llm.conversations import RepairParams, Steps, repaired, repairs, search, trace

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = "gaps blank duplicate truncated illegal cost audit repaired_sha256".split()
LEGAL = re.compile(r"(s?(ua)+)?\Z")


def plain_damage(rows):
    found = []
    for conv, turn, role, text in rows:
        names = [" " if v is None else str(v) for v in (conv, turn)]
        fault = zlib.crc32(":".join(names).encode()) % 20
        role, text = (" " if v is None else v for v in (role, text))
        if fault == 1:
            text = ""
        if fault == 2:
            text = re.sub("[.!?]", "", text)
        if fault == 4:
            role = "user"
        if fault:
            found += [(conv, turn, role, text)] * (2 if fault == 3 else 1)
    return found


def plain_faults(rows):
    """(role, text, fault) of the rows of a conversation in order."""
    seen, found = set(), []
    for _, _, role, text in rows:
        end = text.strip(" \t\n\v\f\r")[-1:]
        if not end:
            fault = "blank"
        elif (role, text) in seen:
            fault = "duplicate"
        else:
            fault = "" if end in ".!?" else "truncated"
        seen.add((role, text))
        found.append((role, text, fault))
    return found


def plain_repair(rows):
    """The least (cost, audit, turns) over all edits, by a search forward over whole audits."""
    after = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    names = {"u": "user", "a": "assistant"}

    def better(best, state, found):
        if state not in best or found < best[state]:
            best[state] = found

    def with_inserts(best):
        for _ in range(4):
            for state, (cost, audit, turns) in list(best.items()):
                for role in "ua":
                    if (state, role) in after:
                        entry = (cost + 2, audit + "I", (*turns, (names[role], "")))
                        better(best, after[state, role], entry)
        return best

    best = with_inserts({"": (0, "", ())})
    for role, text, fault in rows:
        following = {}
        for state, (cost, audit, turns) in best.items():
            better(following, state, (cost + 3, audit + "D", turns))
            if fault in ("blank", "duplicate"):
                continue
            more = fault == "truncated"
            if (state, role[:1]) in after:
                entry = (cost + more, audit + "K", (*turns, (role, text)))
                better(following, after[state, role[:1]], entry)
            for to in "ua":
                if (state, to) in after:
                    entry = (cost + 2 + more, audit + "R", (*turns, (names[to], text)))
                    better(following, after[state, to], entry)
        best = with_inserts(following)
    return min(best[state] for state in ("", "a") if state in best)


def plain(rows, damage=True):
    by_conv = {}
    for row in rows:
        by_conv.setdefault(row[0], []).append(row)
    result = {}
    for conv, own in by_conv.items():
        own = plain_damage(own) if damage else own
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3].encode()))
        turns = [r[1] for r in own if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        faults = plain_faults(own)
        initials = [r[0][:1] for r in faults]
        pairs = itertools.pairwise(initials)
        cost, audit, final = plain_repair(faults)
        assert LEGAL.match("".join(role[0] for role, _ in final))
        text = "\n".join(f"{role}:{text}" for role, text in final)
        result[conv] = (
            gaps,
            *[sum(f == name for *_, f in faults) for name in ("blank", "duplicate", "truncated")],
            sum(a + b not in ("su", "ua", "au") for a, b in pairs),
            cost,
            audit,
            hashlib.sha256(text.encode()).hexdigest(),
        )
    return result


def found(frame, workspace, **options):
    rows = repairs(frame, workspace, damage=True, **options).collect()
    result = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in rows}
    assert len(result) == len(rows)
    return result


def rows_of(frame):
    return [tuple(r) for r in frame.select("conv_id", "turn", "role", "text").collect()]


@pytest.mark.parametrize("chunk_rows", [1 << 16, 3])
def test_table_against_the_plain_version(spark, workspace, chunk_rows):
    frame = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    params = RepairParams(chunk_rows=chunk_rows, hot_rows=1 << 20 if chunk_rows > 3 else 4)
    assert found(frame, workspace, params=params) == plain(rows_of(frame))


TEXTS = ["Yes.", "no", "Well!", "", " \n", "so. ", "é?"]
ROLES = ["user", "assistant", "system", "tool", "", "user", "assistant"]


def made(n, convs, seed):
    """Rows without a pattern; turns are different, apart from gaps and nulls."""
    rows, value = [], seed
    for i in range(n):
        value = (value * 1103515245 + 12345) % (1 << 31)
        a, b, c = value >> 8, value >> 13, value >> 18
        text = TEXTS[a % 7] if c % 3 else f"{TEXTS[a % 7]}{i}."
        rows.append((a % convs, None if b % 29 == 0 else 2 * i + b % 2, ROLES[b % 7], text))
    return rows


@pytest.mark.parametrize("chunk_rows", [1 << 16, 1, 5, 64])
def test_long_conversations_in_chunks(spark, workspace, chunk_rows):
    rows = made(600, 3, chunk_rows)
    rows += [(77, 2 * i, "assistant" if i % 9 else "system", " ") for i in range(200)]
    rows += [(78, i, "user", "the same.") for i in range(200)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(7)
    params = RepairParams(chunk_rows=chunk_rows, hot_rows=16)
    assert found(frame, workspace, params=params) == plain(rows)


def test_fix_up_passes_are_few(spark, workspace):
    """Vectors converge: only the ends of chunks run again, and most passes redo nothing."""
    rows = [(1, i, "user" if i % 2 else "assistant", f"text {i}.") for i in range(4000)]
    frame = spark.createDataFrame(rows, SCHEMA)
    params = RepairParams(chunk_rows=50)
    placed = conversations._placed(
        conversations._sortable(
            conversations.damaged(frame, "conv_id", "turn", "role", "text", damage=False)
        ),
        workspace,
    )
    chunks = conversations._chunks(placed, workspace, params)
    assert chunks.count() >= 80
    passes = []
    tails = conversations.stitched(chunks, workspace, passes)
    assert tails.count() == chunks.count()
    assert len(passes) <= 3 and passes[-1] == 0 and sum(passes) < 1000


codes = st.lists(st.integers(0, 11), max_size=7)


@settings(max_examples=300, deadline=None)
@given(codes)
def test_search_and_trace(found_codes):
    """The cost and the least audit of any row of codes."""
    faults = ["", "truncated", "blank"]
    rows = [(["system", "user", "assistant", "x"][c // 3], f"{i}.", faults[c % 3])
            for i, c in enumerate(found_codes)]
    cost, audit, _ = plain_repair(rows)
    steps, data = Steps(), bytes(found_codes)
    head, total = search(steps, data, conversations._END)
    assert head[0] + total == cost
    texts, again = trace(steps, data, conversations._END, True)
    assert texts[0] == audit and again == total


@settings(max_examples=200, deadline=None)
@given(codes, st.lists(st.integers(0, 11), min_size=1, max_size=7))
def test_runs_again_only_until_vectors_are_parallel(first, second):
    steps, whole = Steps(), bytes(first + second)
    guess = conversations._END
    head = search(steps, bytes(first), guess)[0]
    end = search(steps, bytes(second), conversations._END)[0]
    new, done = conversations.search_again(steps, bytes(first), guess, end, head)
    assert new == search(steps, whole, conversations._END)[0]
    assert done <= len(first)


def test_repaired_rows(spark, workspace):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "assistant", "Hello."), (1, 2, "assistant", "x.")]
    frame = spark.createDataFrame(rows, SCHEMA)
    turns = [tuple(r) for r in repaired(frame, workspace).orderBy("place").collect()]
    cost, audit, final = plain_repair(plain_faults(rows))
    assert [(t[3], t[4]) for t in turns] == list(final)
    assert "".join(t[2] for t in turns) == audit.replace("D", "")
    assert cost == 2


EDGE = [
    (None, None, None, None),
    (None, 1, "user", "Hi."),
    (None, 1, "user", "Hi."),
    (2, None, "user", None),
    (3, 5, None, "Text."),
    (4, 1, "user", "long " * 100_000 + "end."),
    (4, 2, "assistant", "."),
    (5, 0, "user", "a?"),
    (5, 0, "user", "a?"),
    (5, 0, "user", "a?"),
    (6, 9_000_000_000, "", "\x0b"),
]


def test_edge_rows(spark, workspace):
    frame = spark.createDataFrame(EDGE, SCHEMA).selectExpr(
        "*", "array(1) AS conv", "array(2) AS place", "array(3) AS codes", "array(4) AS same"
    )
    assert found(frame, workspace) == plain(EDGE)


def test_conversations_without_rows_are_told(spark, workspace):
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    frame = spark.createDataFrame([(gone, 0, "user", "Hi.")], SCHEMA)
    empty = hashlib.sha256(b"").hexdigest()
    assert found(frame, workspace) == {gone: (0, 0, 0, 0, 0, 0, "", empty)}


def test_empty_table(spark, workspace):
    assert found(spark.createDataFrame([], SCHEMA), workspace) == {}


def test_text_ids(spark, workspace):
    rows = [("a:1", 0, "user", "x."), ("a", 0, "user", "x."), ("a", 1, "assistant", "x")]
    frame = spark.createDataFrame(rows, "conv_id string, turn int, role string, text string")
    assert found(frame, workspace) == plain(rows)
