"""Quality rules against counts in plain Python."""

import re
from collections import Counter

import edge
from hypothesis import given, settings, strategies as st
from twinsieve.llm import rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")
NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {
        i + k
        for i in range(len(words) - 2)
        if windows[tuple(words[i : i + 3])] > 1
        for k in range(3)
    }
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def test_edge_rows(spark):
    frame = edge.clashing(spark, "n_words", "kept", "i")
    got = rules.verdicts(frame).select("text", *NAMES, "base_failed", "kept").collect()
    assert len(got) == len(edge.ROWS)
    for text, *counts, failed, kept in map(tuple, got):
        assert tuple(counts) == plain(text)
        assert failed == (counts[0] < 50 or 100 * counts[4] > 50 * counts[0])
        assert not (failed and kept)
    assert rules.verdicts(edge.empty(spark)).count() == 0


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text("ab #|\n\t é.", max_size=60), min_size=1, max_size=200))
def test_any_text(spark, texts):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    got = {r["doc_id"]: tuple(r[n] for n in NAMES) for r in rules.measures(frame).collect()}
    assert got == {i: plain(t) for i, t in enumerate(texts)}


def prose(n):
    return " ".join(f"the word{i} of" for i in range(n))


def test_rules_bite(spark):
    texts = {
        "good": prose(30),
        "short": prose(10),
        "symbols": " ".join(f"the word{i} ##" for i in range(30)),
        "no stop words": " ".join(f"word{i}" for i in range(90)),
        "long words": " ".join(f"the {'x' * 40}{i}" for i in range(60)),
        "lines": "\n".join(["the same line"] * 9 + [prose(30)]),
        "repeats": "the cat sat " * 30,
    }
    frame = spark.createDataFrame(list(texts.items()), "doc_id string, text string")
    kept = {r[0] for r in rules.verdicts(frame).where("kept").select("doc_id").collect()}
    assert kept == {"good"}
    assert {r[0] for r in rules.keep_good(frame).collect()} == {"good"}


def test_keep_good_keeps_columns(spark):
    frame = edge.clashing(spark, "n_words", "kept", "__in0", "__row").unionByName(
        edge.clashing(spark, "n_words", "kept", "__in0", "__row").selectExpr(
            "doc_id", f"'{prose(40)}' AS text", "lang", "source", "n_chars", "n_words", "kept",
            "__in0", "__row",
        )
    )
    good = rules.keep_good(frame)
    assert good.schema == frame.schema
    assert good.count() == len(edge.ROWS)


def test_no_lambda_holds_the_split(spark):
    """The filter must not be moved below the projections, or each word splits the text again."""
    plan = rules.keep_good(edge.documents(spark))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") <= 4
