import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from edge import LONG, clashing, documents, empty
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from twinsieve.llm import alignment
from twinsieve.llm.alignment import AlignParams, Csr, aligned, alignments, product

FIRST = public_tokenizers.path("byte_bpe_50k.json")
SECOND = public_tokenizers.path("piece_bpe_32k.model")
PARAMS = AlignParams(FIRST, SECOND)
COLUMNS = "n_a n_b n_groups n_links n_best count_sum groups_sha256".split()


@pytest.fixture(scope="module")
def libraries():
    first = Tokenizer.from_file(FIRST)
    first.encode_special_tokens = True
    return first, sentencepiece.SentencePieceProcessor(model_file=SECOND)


def byte_chars():
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


CHARS = byte_chars()


def plain_tokens(text, libraries):
    """(id, bytes) of each token on both sides, or none."""
    if not text:
        return [], []
    first, second = libraries
    a = [
        (i, bytes(CHARS[c] for c in first.id_to_token(i)))
        for i in first.encode(" " + text, add_special_tokens=False).ids
    ]
    b = []
    for i in second.encode(text):
        piece = second.id_to_piece(i)
        raw = bytes([int(piece[3:5], 16)]) if second.is_byte(i) else None
        b.append((i, raw or piece.replace("▁", " ").encode()))
    whole = (" " + text).encode()
    if any(b"".join(t for _, t in side) != whole for side in (a, b)):
        return [], []
    return a, b


def spans(tokens):
    at, found = 0, []
    for number, raw in tokens:
        found.append((number, at, at + len(raw)))
        at += len(raw)
    return found


def plain(texts, libraries):
    rows, counts = [], Counter()
    for text in texts:
        a, b = map(spans, plain_tokens(text, libraries))
        links = [(x[0], y[0]) for x in a for y in b if x[1] < y[2] and y[1] < x[2]]
        ends = sorted({x[2] for x in a} & {y[2] for y in b})
        groups, low = [], 0
        for end in ends:
            sides = [[str(t[0]) for t in side if low < t[2] <= end] for side in (a, b)]
            groups.append("|".join(",".join(s) for s in sides))
            low = end
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""
        counts.update(set(links))
        rows.append((len(a), len(b), len(groups), links, digest))
    best = Counter()
    for (x, _), n in counts.items():
        best[x] = max(best[x], n)
    return [
        (
            n_a,
            n_b,
            n_groups,
            len(links),
            sum(counts[p] == best[p[0]] for p in links),
            sum(counts[p] for p in links),
            digest,
        )
        for n_a, n_b, n_groups, links, digest in rows
    ]


TEXTS = [
    "The cat sat on the mat.",
    "the café's naïve Ångström — 日本語 and 😀!",
    "a  b\n\n x\t<|endoftext|> <s> </s> <unk> <0x41> it's",
    " leading and trailing  ",
    "mark ▁ inside",
    "\x85\x1c  odd spaces",
    "The cat sat on the mat.",
    "",
    None,
    "x",
    " ",
    "12345 67,8 don't DON'T we'll",
]


@pytest.mark.parametrize("most", [1 << 20, 8])
def test_rows_are_those_of_a_plain_version(spark, workspace, libraries, most):
    frame = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id int, text string")
    found = aligned(frame.repartition(3), AlignParams(FIRST, SECOND, most), workspace)
    rows = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in found.collect()}
    assert [rows[i] for i in range(len(TEXTS))] == plain(TEXTS, libraries)


def test_documents_of_the_small_table(spark, workspace, libraries):
    frame = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(40)
    rows = [(r.doc_id, r.text[:1500]) for r in frame.collect()]
    cut = spark.createDataFrame(rows, "doc_id long, text string")
    result = aligned(cut, PARAMS, workspace).collect()
    found = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in result}
    assert [found[i] for i, _ in rows] == plain([t for _, t in rows], libraries)


@settings(max_examples=150, deadline=None)
@given(st.text(st.characters(codec="utf-8", max_codepoint=0x23F), max_size=40))
def test_quick_ids_are_those_of_the_library(text):
    machine = alignment.aligner(FIRST, SECOND).first
    assert machine.quick is not None
    assert machine.quick.encode_ordinary(text) == machine.tokenizer.encode(
        text, add_special_tokens=False
    ).ids


def test_quick_ids_of_every_latin_character(libraries):
    machine = alignment.aligner(FIRST, SECOND).first
    for code in range(0x240):
        c = chr(code)
        for text in (f"a{c}b", f" {c} 1{c}{c} .", f"'s{c}\n"):
            plain_ids = libraries[0].encode(text, add_special_tokens=False).ids
            assert machine.ids(text, True) == plain_ids


def test_long_texts_are_cut_where_no_token_crosses(libraries, monkeypatch):
    monkeypatch.setattr(alignment, "SEGMENT", 50)
    text = "Some words, and  more\n of them; l'été d'un naïf 12 34 <|endoftext|> here. " * 20
    machine = alignment.Aligner(FIRST, SECOND)
    assert len(alignment.segments(text, 50)) > 10
    first, second = machine._encoded(text, True)
    assert first == libraries[0].encode(" " + text, add_special_tokens=False).ids
    assert second == libraries[1].encode(text)


@pytest.mark.parametrize("unit", ["a", "^", " ", "\n", "日", "ab "])
def test_very_long_runs(libraries, unit):
    raw = (unit * 300_000).encode()
    found = alignment.aligner(FIRST, SECOND).aligned(
        np.frombuffer(raw, np.uint8), np.array([0, len(raw)])
    )
    assert len(found.texts) == 1
    assert found.overlap.values.sum() == len(raw) + 1


matrices = st.integers(1, 5).flatmap(
    lambda n: st.lists(st.lists(st.integers(0, 2), min_size=4, max_size=4), min_size=n, max_size=n)
)


def sparse(rows, width):
    bounds = np.cumsum([0] + [sum(v != 0 for v in row) for row in rows])
    cells = [(j, v) for row in rows for j, v in enumerate(row) if v]
    columns, values = (np.array([c[i] for c in cells], np.int64) for i in (0, 1))
    return Csr(bounds, columns, values, width)


four_rows = st.lists(
    st.lists(st.integers(0, 2), min_size=3, max_size=3), min_size=4, max_size=4
)


@given(matrices, four_rows)
def test_products_are_those_of_dense_matrices(left, right):
    found = product(sparse(left, 4), sparse(right, 3))
    dense = np.zeros((len(left), 3), int)
    dense[found.rows(), found.columns] = found.values
    assert (dense == np.array(left) @ np.array(right)).all()
    transposed = sparse(left, 4).transposed()
    dense = np.zeros((4, len(left)), int)
    dense[transposed.rows(), transposed.columns] = transposed.values
    assert (dense == np.array(left).T).all()


@given(st.sets(st.integers(1, 60), min_size=1), st.sets(st.integers(1, 60), min_size=1))
def test_overlaps_do_not_depend_on_the_stretch(first, second):
    sides = [np.array(sorted({*s, 61})) for s in (first, second)]
    whole, parts = alignment.overlaps(*sides), alignment.overlaps(*sides, stretch=7)
    for name in ("bounds", "columns", "values"):
        assert (getattr(whole, name) == getattr(parts, name)).all()


def test_shared_groups(libraries):
    raw = "naïve 日本語 cat".encode()
    found = alignment.aligner(FIRST, SECOND).aligned(
        np.frombuffer(raw, np.uint8), np.array([0, len(raw)])
    )
    links = found.group_links()
    pairs = set(zip(links.rows().tolist(), links.columns.tolist(), strict=True))
    expected = {
        (i, j)
        for i, g in enumerate(found.first_groups)
        for j, h in enumerate(found.second_groups)
        if g == h
    }
    assert pairs == expected
    assert alignment.product_size(*found.group_factors()).sum() == len(expected)


def test_links_as_lists(spark):
    frame = spark.createDataFrame([(1, "the café"), (2, None)], "doc_id int, text string")
    rows = {r.doc_id: r for r in alignments(frame, PARAMS).collect()}
    assert rows[2].a_ids == rows[2].link_a == []
    row = rows[1]
    assert sum(row.link_bytes) == len(" the café".encode())
    links = zip(row.link_a, row.link_b, strict=True)
    assert all(row.a_groups[a] == row.b_groups[b] for a, b in links)


def test_edge_rows(spark, workspace, libraries):
    frame = clashing(spark, "pairs", "n_a", "__key", "rest")
    rows = frame.select("doc_id", "text").collect()
    found = aligned(frame, PARAMS, workspace).collect()
    # The long row shares pairs with others, so sums of corpus counts are left out here.
    texts = ["" if r.text == LONG else r.text for r in rows]
    known = zip([r.doc_id for r in rows], plain(texts, libraries), strict=True)
    expected = sorted(((i, r[:4] + r[6:]) for i, r in known if i != 5), key=repr)
    names = COLUMNS[:4] + COLUMNS[6:]
    others = [(r.doc_id, tuple(r[c] for c in names)) for r in found if r.doc_id != 5]
    assert sorted(others, key=repr) == expected
    long = next(r for r in found if r.doc_id == 5)
    assert long.n_links >= long.n_a > 30_000


def test_empty_tables(spark, workspace):
    assert aligned(empty(spark), PARAMS, workspace).collect() == []
    none = documents(spark).where("text IS NULL")
    assert [r.n_a for r in aligned(none, PARAMS, workspace).collect()] == [0]
