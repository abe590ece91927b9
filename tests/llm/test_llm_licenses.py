import re

import numpy as np
import pytest
from edge import LONG, clashing, documents, empty
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from twinsieve.llm import licenses
from twinsieve.llm.licenses import (
    PHRASES,
    TEMPLATES,
    LicenseParams,
    gram_hashes,
    labelled,
    scan_licenses,
)

PARAMS = LicenseParams()
COLUMNS = "n_words n_base first_word last_word base_labels labels score n_spans".split()
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = {i: i + 32 for i in range(65, 91)}


def words_of(text):
    return WORD.findall((text or "").translate(UPPER))


def plain_spans(words, params=PARAMS):
    """(label, template, first, last, votes, share) of verified spans."""
    k, found = params.gram, []
    for name, (label, text) in TEMPLATES.items():
        template = words_of(text)
        windows = {}
        for t in range(len(template) - k + 1):
            windows.setdefault(tuple(template[t : t + k]), []).append(t)
        hits = [
            (p - t, p, t)
            for p in range(len(words) - k + 1)
            for t in windows.get(tuple(words[p : p + k]), ())
        ]
        islands = []
        for hit in sorted(hits):
            if not islands or hit[0] - islands[-1][-1][0] > params.slack:
                islands.append([])
            islands[-1].append(hit)
        for island in islands:
            covered = len({t + i for _, _, t in island for i in range(k)})
            first, last = min(h[1] for h in island), max(h[1] for h in island) + k - 1
            share, density = covered / len(template), covered / (last - first + 1)
            if share >= params.least_share and density >= params.least_density:
                found.append((label, name, first, last, len(island), share))
    places = []
    for span in sorted(found, key=lambda s: (s[2], s[3], s[1])):
        if not places or span[2] > max(s[3] for s in places[-1]) - k:
            places.append([])
        places[-1].append(span)
    kept = []
    for place in places:
        share, label = max((s[5], s[0]) for s in place)
        kept += [s for s in place if s[5] == share or s[0] == label]
    return kept


def plain(text):
    words = words_of(text)
    base = []
    for phrase, label in PHRASES:
        run = phrase.split()
        n = len(run)
        base += [(i, label) for i in range(len(words)) if words[i : i + n] == run]
    places = sorted(i for i, _ in base)
    own = {label for _, label in base}
    spans = plain_spans(words)
    share = max([s[5] for s in spans], default=0.0)
    return (
        len(words),
        len(base),
        places[0] if places else None,
        places[-1] if places else None,
        ",".join(sorted(own)),
        ",".join(sorted(own | {s[0] for s in spans})),
        round(max(share, 0.5 if own else 0.0), 9),
        len(spans),
    )


MIT, BSD = TEMPLATES["mit"][1], TEMPLATES["bsd"][1]
GPL = TEMPLATES["gpl-notice"][1]
TEXTS = [
    "Released under the MIT license.",
    "the mit License, or the Apache-license; general public\nlicense. MIT LICENSE",
    "some words before\n" + MIT + "\nand some after " + BSD,
    MIT.replace("free of charge", "free of any charge").replace("merge, publish,", "publish,"),
    " ".join(MIT.split()[:60]),
    " x ".join(MIT.split(" ")),
    (GPL + " filler words here. ") * 3,
    "licensed under cc by-nc 4.0. Licensed under CC BY-SA 4.0",
    "mitlicense mit  licen mité license İmit license",
    "",
    None,
    "mit",
    "license mit license license mit",
    "Released under the MIT license.",
]


def rows_of(found):
    def value(v):
        return round(v, 9) if isinstance(v, float) else v

    return [tuple(value(row[c]) for c in COLUMNS) for row in found]


def test_rows_are_those_of_a_plain_version(spark, workspace):
    frame = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id int, text string")
    rows = {r.doc_id: r for r in labelled(frame.repartition(3), workspace).collect()}
    expected = [plain(t) for t in TEXTS]
    assert rows_of(rows[i] for i in range(len(TEXTS))) == expected
    assert expected[2][5] == "bsd,mit" and expected[3][5] == "mit" and expected[6][7] == 3
    assert expected[4][5] == expected[5][5] == ""


def test_documents_of_the_small_table(spark, workspace):
    frame = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = {r.doc_id: r for r in labelled(frame, workspace).collect()}
    for row in frame.collect():
        assert rows_of([rows[row.doc_id]]) == [plain(row.text)]


def test_spans_tell_where_the_text_is(spark, workspace):
    frame = spark.createDataFrame([(1, "one two three " + MIT)], "doc_id int, text string")
    found = scan_licenses(frame, workspace).spans.collect()
    words = len(words_of(MIT))
    places = [(r.template, r.first_word, r.last_word, r.share) for r in found]
    assert places == [("mit", 3, words + 2, 1.0)]


def test_a_hash_alone_is_no_match(spark, workspace, monkeypatch):
    """With templates whose windows start with other words, equal hashes are not enough."""
    windows = licenses.template_windows

    def others(*args):
        return windows(*args).withColumn("word", F.concat("word", F.lit("x")))

    frame = spark.createDataFrame([(1, MIT)], "doc_id int, text string")
    assert scan_licenses(frame, workspace).spans.count() == 1
    monkeypatch.setattr(licenses, "template_windows", others)
    assert scan_licenses(frame, workspace).spans.collect() == []


@settings(max_examples=60, deadline=None)
@given(st.text("mit lceaph.éM", max_size=60))
def test_words_and_phrases(text):
    hashes, words = licenses._words(text)
    assert words == words_of(text)
    bounds = np.array([0, len(hashes)])
    n_base, first, last, labels = licenses._Phrases(PHRASES).found(hashes, bounds)
    assert (n_base[0], first[0], last[0], labels[0]) == plain(text)[1:5]


def test_phrases_stay_in_their_text():
    hashes, words = licenses._words("mit license")
    both = np.concatenate([hashes, hashes])
    assert licenses._Phrases(PHRASES).found(both, np.array([0, 1, 2, 4]))[0] == [0, 0, 1]


def test_windows():
    words = np.arange(10, dtype=np.uint64)
    found = gram_hashes(words, 4)
    assert len(found) == 7 and found[2] == gram_hashes(words[2:6], 4)[0]
    assert len(gram_hashes(words[:3], 4)) == 0
    with pytest.raises(ValueError):
        licenses.template_windows(None, {"short": ("x", "two words")}, 4)


def test_many_copies_and_long_texts(spark, workspace):
    text = (MIT + " ") * 20
    frame = spark.range(600).selectExpr("7L AS doc_id", f"'{text.replace(chr(39), '')}' AS text")
    rows = labelled(frame, workspace).groupBy("labels", "n_spans").count().collect()
    assert [(r.labels, r.n_spans, r["count"]) for r in rows] == [("mit", 20, 600)]


def test_edge_rows(spark, workspace):
    frame = clashing(spark, "row", "head", "label", "place")
    rows = labelled(frame, workspace).collect()
    expected = [(r.doc_id, *plain(r.text)) for r in frame.select("doc_id", "text").collect()]
    found = [(r.doc_id, *rows_of([r])[0]) for r in rows]
    assert sorted(found, key=repr) == sorted(expected, key=repr)
    assert next(r.n_words for r in rows if r.doc_id == 5) == len(words_of(LONG))


def test_empty_tables(spark, workspace):
    assert labelled(empty(spark), workspace).collect() == []
    none = documents(spark).where("text IS NULL")
    assert rows_of(labelled(none, workspace).collect()) == [plain(None)]
