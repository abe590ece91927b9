"""Packing: ids as the tokenizer gives them, whole coverage, and cuts of least cost."""

import random
import zlib

import edge
import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer
from twinsieve.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")
TOKENIZER = Tokenizer.from_file(PATH)


@settings(max_examples=300, deadline=None)
@given(
    st.lists(
        st.sampled_from(
            ["The", "it's", "we'll", "DON'T", "naïve", "İstanbul", "ΟΔΟΣ", "ﬁ", "é", "日本語", "😀",
             "a1b2", "...", "!?", "<|endoftext|>", "x<|startoftext|>y", "<|", " ", " ", "\n",
             "\x1c", "\x85", "\t", "\x00", "​", "½", "Ⅷ", "ß", "ẞ"]
        )
        | st.text(max_size=6),
        max_size=12,
    ),
    st.sampled_from([" ", "", "\n"]),
)
def test_ids_are_those_of_the_whole_text(parts, glue):
    text = glue.join(parts)
    ids = np.frombuffer(packing.word_ids(PATH).of(text), "<u4").tolist()
    assert ids == TOKENIZER.encode(text, add_special_tokens=False).ids


def cost(lengths_and_penalties, params):
    return sum(
        (0 if n & (n - 1) == 0 else params.capacity - n) + penalty + params.per_sequence
        for n, penalty in lengths_and_penalties
    )


@pytest.mark.parametrize("seed", range(20))
def test_cuts_cost_the_least(seed):
    pick = random.Random(seed)
    params = packing.PackParams(PATH, capacity=16, sentence_cut=2, word_cut=5, per_sequence=1)
    total = pick.randrange(1, 150)
    places = np.array(sorted({0, total, *range(0, total, 16), *pick.sample(range(total), total // 3)}))
    penalties = np.array([pick.choice([0, 2, 5]) for _ in places])
    least = {0: 0}
    for at, penalty in list(zip(places.tolist(), penalties.tolist()))[1:]:
        least[at] = min(
            least[b] + cost([(at - b, penalty)], params) for b in least if at - b <= 16
        )
    cuts = packing.best_cuts(places, penalties, params).tolist()
    by_place = dict(zip(places.tolist(), penalties.tolist()))
    found = cost([(b - a, by_place[b]) for a, b in zip(cuts, cuts[1:])], params)
    assert cuts[0] == 0 and cuts[-1] == total and found == least[total]


def check(pieces, texts, capacity):
    """All ids in one piece each, sequences without gaps; texts are {id: text}."""
    ids = {
        k: np.array([*TOKENIZER.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        for k, t in texts.items()
    }
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p["doc_id"], []).append(p)
        by_sequence.setdefault(p["sequence_id"], []).append(p)
    assert set(by_doc) == set(ids)
    for key, parts in by_doc.items():
        at = 0
        for p in sorted(parts, key=lambda p: p["start"]):
            assert p["start"] == at and p["length"] > 0 and p["doc_tokens"] == len(ids[key])
            assert bytes(p["ids"]) == ids[key][at : at + p["length"]].tobytes()
            at += p["length"]
        assert at == len(ids[key])
    for parts in by_sequence.values():
        at = 0
        for p in sorted(parts, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= capacity


def test_pieces_cover_everything(spark, monkeypatch):
    monkeypatch.setattr(packing, "STRETCH", 500)
    pick = random.Random(4)
    words = "the cat sat on a mat. Then it slept! Why? and so on".split()
    texts = {i: " ".join(pick.choices(words, k=pick.randrange(300))) for i in range(60)}
    frame = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(3)
    params = packing.PackParams(PATH, capacity=64)
    pieces = packing.packed(frame, params).collect()
    check(pieces, texts, 64)
    loads = {}
    for p in pieces:
        loads[p["sequence_id"]] = loads.get(p["sequence_id"], 0) + p["length"]
    padding = sum(64 - n for n in loads.values() if n & (n - 1))
    assert padding < 0.1 * sum(loads.values())


def test_edge_rows(spark):
    rows = [r for r in edge.ROWS if r[0] != 6]
    frame = spark.createDataFrame(rows, edge.SCHEMA).selectExpr("*", "1 AS start", "2 AS row_id")
    params = packing.PackParams(PATH, capacity=512)
    check(packing.packed(frame, params).collect(), {r[0]: r[1] for r in rows}, 512)
    repeated = packing.packed(edge.documents(spark).where("doc_id = 6"), params).collect()
    assert sum(p["length"] for p in repeated) == 2 * repeated[0]["doc_tokens"]
    assert packing.packed(edge.empty(spark), params).count() == 0


def test_crc_of_ids(spark):
    from twinsieve.llm import queries

    frame = queries.op4_packing(spark, "/root/testdata/sf0.001")
    row = frame.orderBy("doc_id", "start").first()
    text = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where(
        f"doc_id = {row['doc_id']}"
    ).first()["text"]
    ids = np.array([*TOKENIZER.encode(text, add_special_tokens=False).ids, 2], "<u4")
    assert row["ids_crc32"] == zlib.crc32(ids[: row["length"]].tobytes())


def test_memories_are_bounded_in_bytes(monkeypatch):
    """Long runs without spaces are not remembered, and a full memory starts anew."""
    words = packing.WordIds(PATH)
    long = ["日本語" * 1000 + str(i) for i in range(20)]
    for text in long:
        words.of(text)
    assert len(words) == 0
    monkeypatch.setattr(packing, "REMEMBERED_BYTES", 20_000)
    expected = TOKENIZER
    for i in range(500):
        run = f"wordé{i}."
        ids = np.frombuffer(words.of(run), "<u4").tolist()
        assert ids == expected.encode(run, add_special_tokens=False).ids
        assert words.held <= 20_000 and words.parts.held <= 20_000
    assert 0 < len(words) < 100


def test_ranked_pieces_are_those_of_the_library():
    words = packing.WordIds(PATH)
    assert words.parts.ranked is not None
    for code in range(0x21, 0x250):
        c = chr(code)
        for run in (c, f"a{c}b", c * 3 + "1", f"Q{c}'s", f"{c}ing"):
            if run.split() == [run]:
                ids = np.frombuffer(words._encoded(run), "<u4").tolist()
                plain = words.tokenizer.encode(run, add_special_tokens=False).ids
                assert ids == plain, run
