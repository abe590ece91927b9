"""SentencePiece: ids of the library, round trips, and least paths against all segmentations."""

import struct
from itertools import combinations

import edge
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st
from twinsieve.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
PARTS = ["The", "the", "ing", "\n", "\n\n", "  ", "   ", "é", "日本語", "😀", "<s>", "<0x0A>", "\t", "\x00",
         "ß", "12", "...", "!?", "word", "Straße", "́", " ", "​", "", "a b"]


def ids_of(text):
    data = pieces.encoder(PATH).ids(text)
    return list(struct.unpack(f"<{len(data) // 4}I", data))


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(PARTS) | st.text(max_size=5), max_size=12), st.sampled_from([" ", ""]))
def test_ids_are_those_of_the_library(parts, glue):
    text = glue.join(parts)
    ids = ids_of(text)
    assert ids == LIBRARY.encode(text)
    decoded = pieces.encoder(PATH).transducer.decoded(ids)
    assert decoded == text.replace(pieces.SPACE, " ")


def test_texts_of_the_table(spark):
    frame = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for row in frame.collect():
        assert ids_of(row["text"]) == LIBRARY.encode(row["text"])


def model_file(path, entries, kind, dummy=1, extra=0):
    """A model file with (piece, score) entries."""

    def field(number, data):
        return bytes([number << 3 | 2]) + _size(len(data)) + data

    def _size(n):
        out = b""
        while n > 127:
            out += bytes([n & 127 | 128])
            n >>= 7
        return out + bytes([n])

    data = field(1, field(1, b"<unk>") + b"\x15" + struct.pack("<f", 0) + b"\x18\x02")
    for piece, score in entries:
        data += field(1, field(1, piece.encode()) + b"\x15" + struct.pack("<f", score))
    data += field(2, bytes([3 << 3, kind]))
    data += field(3, field(1, b"identity") + bytes([3 << 3, dummy, 4 << 3, extra]))
    path.write_bytes(data)
    return str(path)


def segmentations(text):
    for n in range(len(text)):
        for cuts in combinations(range(1, len(text)), n):
            ends = [0, *cuts, len(text)]
            yield [text[a:b] for a, b in zip(ends, ends[1:], strict=False)]


def test_least_paths_of_a_weighted_lexicon(tmp_path):
    entries = [("▁", -2.0), ("a", -3.0), ("b", -3.0), ("ab", -4.0), ("▁a", -2.5), ("ba", -3.5), ("aba", -9.0)]
    machine = pieces.Transducer(pieces.read_model(model_file(tmp_path / "m", entries, 1)))
    scores = dict(entries)
    for text in ("▁abab", "▁ba", "aab", "▁aba▁b"):
        found = machine.shortest(text)
        known = [s for s in segmentations(text) if all(p in scores for p in s)]
        best = max(sum(scores[p] for p in s) for s in known)
        assert "".join(found) == text and sum(scores[p] for p in found) == pytest.approx(best)
    assert machine.run_ids("c") == [0]


def test_extra_spaces_and_prefix(tmp_path):
    entries = [("▁", -2.0), ("a", -3.0)]
    machine = pieces.Transducer(pieces.read_model(model_file(tmp_path / "m", entries, 1, 0, 1)))
    assert machine.normalized("  a   a ") == "a▁a"
    machine = pieces.Transducer(pieces.read_model(model_file(tmp_path / "n", entries, 1, 1, 0)))
    assert machine.normalized(" a") == "▁▁a" and machine.decoded([1, 1, 2]) == " a"


def test_edge_rows(spark):
    frame = edge.clashing(spark, "ids", "id")
    encoded = pieces.encoded(frame, PATH)
    back = pieces.decoded(encoded, PATH)
    both = pieces.round_trip(frame, PATH)
    assert edge.rows_of(both, "doc_id", "text") == edge.rows_of(back, "doc_id", "text")
    assert edge.rows_of(both, "doc_id", "ids") == edge.rows_of(encoded, "doc_id", "ids")
    assert edge.rows_of(back, "doc_id", "text") == sorted(((r[0], r[1]) for r in edge.ROWS), key=repr)
    ids = {(r["doc_id"], tuple(r["ids"] or ())) for r in encoded.collect()}
    assert ids == {(r[0], tuple(LIBRARY.encode(r[1] or ""))) for r in edge.ROWS}
    assert encoded.where("ids IS NULL").count() == 1
    assert pieces.decoded(pieces.encoded(edge.empty(spark), PATH), PATH).count() == 0


def test_bytes_that_are_no_text(spark):
    machine = pieces.encoder(PATH).transducer
    byte = machine.byte_ids[0xE6]
    assert machine.decoded([byte]) == "�" and machine.decoded([]) == ""


def test_memories_are_bounded_in_bytes(monkeypatch):
    """Long runs without spaces are not remembered, and a full memory starts anew, in the middle of a
    text too."""
    encoder = pieces.Encoder(PATH)
    for i in range(20):
        encoder.ids("日本語" * 1000 + str(i))
    assert len(encoder.marked) == len(encoder.bare) == 0
    encoder = pieces.Encoder(PATH)
    machine = encoder.transducer
    memories = (encoder.marked, encoder.bare, encoder.marked.parts, machine)
    monkeypatch.setattr(pieces, "REMEMBERED_BYTES", 20_000)
    fullest = 0
    for i in range(400):
        text = f"wordé{i} unknowable{i * 7919}ness.\nline{i}  of 日本{chr(0x4E00 + i)}"
        data = encoder.ids(text)
        assert list(struct.unpack(f"<{len(data) // 4}I", data)) == LIBRARY.encode(text)
        assert all(m.held <= 20_000 for m in memories)
        fullest = max(fullest, len(encoder.marked), len(machine.allowed))
        assert sum(map(len, machine.allowed.values())) * pieces._FOLLOWER <= 20_000
    assert 0 < fullest < 100
