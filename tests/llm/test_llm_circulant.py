"""Near-duplicates against all pairs in plain Python."""

import random
import re

import edge
import numpy as np
import pytest
from twinsieve.llm import circulant
from twinsieve.llm.text import column_bytes, word_hashes

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def plain_components(rows, percent=85):
    """{id: smallest id reachable}; rows are (id, text)."""
    parent = {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [(i, shingles(t)) for i, t in rows]
    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    return {i: find(i) for i in parent}


def near_copies(seed, groups=6, size=12, length=120):
    """Groups of texts that drift apart, so that only neighbours are similar enough."""
    pick = random.Random(seed)
    rows = []
    for g in range(groups):
        words = [f"w{pick.randrange(10_000)}" for _ in range(length)]
        for _ in range(size):
            rows.append((len(rows), " ".join(words)))
            for _ in range(pick.choice([0, 1, 2, 3])):
                words[pick.randrange(length)] = f"x{pick.randrange(10_000)}"
    ids = pick.sample(range(10_000), len(rows))
    return [(i, t) for i, (_, t) in zip(ids, rows, strict=True)]


@pytest.mark.parametrize("seed", range(2))
def test_chains_of_near_copies(spark, workspace, seed, monkeypatch):
    monkeypatch.setattr(circulant, "BLOCK", 3)
    rows = near_copies(seed)
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in circulant.components(frame, workspace).collect()}
    assert {i: r["component_id"] for i, r in got.items()} == plain_components(rows)
    sizes = {i: len(shingles(t)) for i, t in rows}
    assert {i: r["n_shingles"] for i, r in got.items()} == sizes
    assert all(r["kept"] == (i == r["component_id"]) for i, r in got.items())


def test_edge_rows(spark, workspace):
    frame = edge.clashing(spark, "digest", "id", "buckets", "component")
    got = edge.rows_of(
        circulant.components(frame, workspace), "doc_id", "n_shingles", "component_id", "kept"
    )
    sets = {i: len(shingles(t)) for i, t, *_ in edge.ROWS}
    expected = plain_components([(r[0], r[1]) for r in edge.ROWS if r[0] is not None])
    assert len(got) == len(edge.ROWS)
    for doc_id, n, component, kept in got:
        assert n == sets[doc_id]
        if doc_id is None:
            assert component is None and kept
        else:
            assert component == expected[doc_id] and kept == (component == doc_id)
    assert circulant.components(edge.empty(spark), workspace).count() == 0


def test_rows_with_one_id_and_two_texts(spark, workspace):
    a, b = (" ".join(f"{x}{i}" for i in range(40)) for x in "ab")
    rows = [(3, a), (5, a), (5, b), (9, b), (7, "other words than those of the rest")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = edge.rows_of(circulant.components(frame, workspace), "doc_id", "component_id")
    assert got == [(3, 3), (5, 3), (5, 3), (7, 7), (9, 3)]


def test_signature_follows_its_definition():
    params = circulant.NearParams(bands=4, rows=2)
    first, second = circulant._permutations(params.seed)
    second = second[circulant.MOST_COORDINATES :]
    found = np.random.default_rng(1).integers(0, 1 << 63, 50).astype(np.uint64)
    places = first[(found % np.uint64(circulant.PLACES)).astype(np.int64)]
    for k, value in enumerate(circulant.signature(found, params.coordinates, params.seed)):
        assert value == second[(places - k) % circulant.PLACES].min()


def test_words_are_cut_in_stretches(monkeypatch):
    import pyarrow as pa
    from twinsieve.llm import text

    texts = ["ab cd  ef", None, "", "x" * 300 + " y", " lead and trail ", "é ü ß"]
    whole = word_hashes(*column_bytes(pa.array(texts)))
    monkeypatch.setattr(text, "STRETCH", 7)
    parts = word_hashes(*column_bytes(pa.array(texts)))
    assert whole[0].tolist() == parts[0].tolist() and whole[1].tolist() == parts[1].tolist()
    counts = [len(WORD.findall(t or "")) for t in texts]
    assert np.diff(whole[1]).tolist() == counts
    assert len(set(whole[0].tolist())) == len({w for t in texts for w in WORD.findall(t or "")})
    sliced = word_hashes(*column_bytes(pa.array(texts)[3:]))
    assert sliced[0].tolist() == whole[0][whole[1][3] :].tolist()
