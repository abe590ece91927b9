import random

import pytest
from pyspark.sql import functions as F

import plain
from twinsieve.functions import minhash
from twinsieve.functions.text import hash32, shingle_hashes, shingles, token_count, tokens


@pytest.fixture(scope="module")
def texts():
    return plain.EDGE_TEXTS + plain.random_texts(60, 1)


@pytest.fixture(scope="module")
def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "id long, text string")


def test_tokens_keep_empty_ones(frame, texts):
    got = {r.id: r.t for r in frame.select("id", tokens("text").alias("t")).collect()}
    assert got == {i: None if t is None else plain.tokens(t) for i, t in enumerate(texts)}


def test_empty_text_is_one_token_and_four_spaces_are_five(spark):
    rows = spark.createDataFrame([("",), ("    ",)], "text string")
    assert [r[0] for r in rows.select(token_count("text")).collect()] == [1, 5]


@pytest.mark.parametrize("n, least", [(5, 5), (1, 1), (2, 0), (3, 7), (7, 3)])
def test_shingles(frame, texts, n, least):
    got = {r.id: r.s for r in frame.select("id", shingles("text", n, least).alias("s")).collect()}
    for i, text in enumerate(texts):
        assert len(got[i] or []) == len(set(got[i] or []))
        assert set(got[i] or []) == plain.shingles(text, n, least), text


def test_hash_is_little_endian(spark):
    words = ["", "a", "one two three four five", "x" * 1000]
    rows = spark.createDataFrame([(w,) for w in words], "w string")
    got = [r[0] for r in rows.select(hash32(F.col("w"))).collect()]
    assert got == [plain.hash32(w) for w in words]


def test_shingle_hashes(frame, texts):
    got = {r.id: r.h for r in frame.select("id", shingle_hashes("text").alias("h")).collect()}
    for i, text in enumerate(texts):
        assert set(got[i] or []) == {plain.hash32(s) for s in plain.shingles(text)}


def test_any_unicode_text_splits_alike(spark):
    """Control characters, combining marks, case-folding oddities and astral planes."""
    rng = random.Random(17)
    pools = [(0, 0x7F), (0x80, 0x24F), (0x300, 0x36F), (0x2000, 0x2FFF), (0x1F300, 0x1FAFF)]
    texts = []
    for _ in range(400):
        chars = [chr(rng.randint(*rng.choice(pools))) for _ in range(rng.randint(0, 40))]
        texts.append("".join(chars))
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    got = rows.select("id", tokens("text").alias("t"), shingle_hashes("text", 2, 2).alias("h"))
    classes = minhash._byte_classes()
    for row in got.collect():
        text = texts[row.id]
        assert row.t == plain.tokens(text)
        expected = {plain.hash32(s) for s in plain.shingles(text, 2, 2)}
        assert set(row.h) == expected
        parts = minhash.text_hashes(text.encode(), 2, 2, classes)
        assert {int(h) for part in parts for h in part} == expected


def test_bad_sizes():
    with pytest.raises(ValueError):
        shingles("text", 0)
