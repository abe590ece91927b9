"""Toxicity by held-out accuracy, and counts, chances and scores against a plain version."""

import math
import random
import zlib

import edge
import numpy as np
import pyarrow as pa
import pytest
from twinsieve.llm import toxicity
from twinsieve.llm.text import column_bytes

PARAMS = toxicity.ToxicityParams()


def corpus(spark, seed, size=600):
    pick = random.Random(seed)
    rows, labels = [], []
    for i in range(size):
        words = [f"w{int(pick.expovariate(0.01))}" for _ in range(pick.randrange(5, 200))]
        toxic = int(pick.random() < 0.2)
        if toxic:
            for _ in range(1 + len(words) // 40):
                words.insert(pick.randrange(len(words)), pick.choice(["Nasty,", "vile", "dreck!"]))
        rows.append((i, " ".join(words)))
        labels.append((i, toxic))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    return docs, spark.createDataFrame(labels, "doc_id bigint, toxic int"), dict(labels)


def test_held_out_texts_are_told_apart(spark, workspace):
    docs, labels, truth = corpus(spark, 1)
    model = toxicity.fit(docs, labels, workspace, params=PARAMS)
    got = toxicity.scored(docs, model).collect()
    test = [r for r in got if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1]
    assert len(test) > 150
    hits = [r["predicted"] for r in test if truth[r["doc_id"]]]
    false = [r["predicted"] for r in test if not truth[r["doc_id"]]]
    assert np.mean(hits) > 0.9 and np.mean(false) < 0.02
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in got)
    kept = toxicity.keep_ordinary(docs, model)
    assert kept.schema == docs.schema
    assert kept.count() == sum(not r["predicted"] for r in got)


def test_held_out_labels_are_not_read(spark, workspace):
    docs, labels, truth = corpus(spark, 2, 200)
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 3 == 1]
    other = labels.selectExpr(
        "doc_id", f"if(doc_id IN ({','.join(map(str, held))}), 1 - toxic, toxic) AS toxic"
    )
    scores = [
        edge.rows_of(toxicity.scored(docs, toxicity.fit(docs, x, workspace, params=PARAMS)), "doc_id", "score")
        for x in (labels, other)
    ]
    assert scores[0] == scores[1]


def test_edge_rows(spark, workspace):
    docs, labels, _ = corpus(spark, 3, 200)
    model = toxicity.fit(docs, labels, workspace, params=PARAMS)
    frame = edge.clashing(spark, "score", "toxic", "predicted")
    got = toxicity.scored(frame, model).collect()
    assert len(got) == len(edge.ROWS)
    empty = {r["score"] for r in got if r["doc_id"] in (2, 3, 4)}
    assert len(empty) == 1 and not any(r["predicted"] for r in got)
    assert toxicity.keep_ordinary(frame, model).columns == frame.columns
    assert toxicity.scored(edge.empty(spark), model).count() == 0


@pytest.mark.parametrize("labels", [[], [(1, 1)], [(1, None), (None, 0), (99, 0)], [(1, 2)]])
def test_without_both_classes_all_scores_are_zero(spark, workspace, labels):
    frame = edge.documents(spark)
    table = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    model = toxicity.fit(frame, table, workspace)
    assert model is None
    got = toxicity.scored(frame, model).collect()
    assert len(got) == len(edge.ROWS) and all(r["score"] == 0 for r in got)
    assert toxicity.keep_ordinary(frame, model).count() == len(edge.ROWS)


class Plain:
    """The model of some training texts (words, class), by the formulas and without arrays."""

    def __init__(self, texts, params, part=1.0):
        self.params, self.part = params, part
        self.sizes = [sum(c == k for _, c in texts) for k in (0, 1)]
        self.words, self.pairs = [{}, {}], [{}, {}]
        for words, c in texts:
            for w in set(words):
                self.words[c][w] = self.words[c].get(w, 0) + 1
            for p in set(zip(["^", *words], words)):
                self.pairs[c][p] = self.pairs[c].get(p, 0) + 1
        self.every = set(self.pairs[0]) | set(self.pairs[1])

    def test(self, counts):
        both, total = sum(counts), sum(self.sizes)
        parts = zip(counts, self.sizes)
        return 2 * sum(n * math.log(n * total / (both * size)) for n, size in parts if n)

    def weight(self, counts):
        test = self.test(counts)
        return (test / (test + self.params.evidence)) ** 2

    def word_chance(self, c, w):
        whole = [sum(counts.values()) for counts in self.words]
        kinds = len(set(self.words[0]) | set(self.words[1]))
        share = min(1, self.params.discount * kinds / sum(whole))
        lefts = sum(x == w for _, x in self.every) / len(self.every)
        own = max(self.words[c].get(w, 0) - self.params.discount, 0) / whole[c]
        return own + share * lefts

    def pair_chance(self, c, v, w):
        before = [sum(n for (x, _), n in p.items() if x == v) for p in self.pairs]
        rights = sum(x == v for x, _ in self.every)
        fall = min(1, self.params.discount * rights / sum(before))
        own = max(self.pairs[c].get((v, w), 0) - self.params.discount, 0) / max(before[c], 1)
        return own + fall * self.word_chance(c, w)

    def word(self, w):
        counts = [k.get(w, 0) for k in self.words]
        return self.weight(counts) * math.log(self.word_chance(1, w) / self.word_chance(0, w))

    def pair(self, v, w):
        own = self.weight([k.get((v, w), 0) for k in self.pairs])
        ratio = math.log(self.pair_chance(1, v, w) / self.pair_chance(0, v, w))
        return own * ratio + (1 - own) * self.word(w)

    def known(self, counts):
        return sum(counts) and self.test(counts) >= self.params.least_test

    def features(self, words):
        total = 0.0
        for v, w in set(zip(["^", *words], words)):
            if self.known([k.get((v, w), 0) for k in self.pairs]):
                total += self.pair(v, w)
            elif self.known([k.get(w, 0) for k in self.words]):
                total += self.word(w)
        size = max(len(words), 1)
        return math.atan(total / size / 0.2), math.atan(total / math.sqrt(size))


def test_counts_chances_and_scores_follow_the_formulas(spark, workspace):
    docs, labels, truth = corpus(spark, 5, 150)
    model = toxicity.fit(docs, labels, workspace, params=PARAMS)
    texts = {r["doc_id"]: r["text"].lower().replace(",", "").replace("!", "").split()
             for r in docs.collect()}
    used = [i for i in texts if zlib.crc32(str(i).encode()) % 3 != 1]
    plain = Plain([(texts[i], truth[i]) for i in used], PARAMS)
    words = {w for i in used for w in texts[i]}
    known = {w for w in words if plain.known([k.get(w, 0) for k in plain.words])}
    assert len(model.ratios.words) == len(known) < len(words)
    for w in sorted(known):
        now, _ = toxicity.word_hashes(*column_bytes(pa.array([w])))
        at = np.searchsorted(model.ratios.words, now[0])
        assert model.ratios.word_ratio[at] == pytest.approx(plain.word(w), abs=1e-9)
    frame = [" ".join(texts[i]) for i in texts] + ["", "unseen words", "vile unseen dreck"]
    got = model.ratios.features(*column_bytes(pa.array(frame)))
    expected = [plain.features(t.split()) for t in frame]
    assert got == pytest.approx(np.array(expected), abs=1e-9)
    scores = model.score(*column_bytes(pa.array(frame)))
    slope = np.array(expected) @ model.weights[:2] + model.weights[2]
    assert scores == pytest.approx(1 / (1 + np.exp(-slope)))


def test_few_labels_tell_texts_apart(spark, workspace):
    """Two dozen toxic training texts, production parameters: ordinary texts differ in score."""
    docs, labels, truth = corpus(spark, 6, 180)
    got = toxicity.scored(docs, toxicity.fit(docs, labels, workspace)).collect()
    test = [r for r in got if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1]
    toxic = [r for r in test if truth[r["doc_id"]]]
    ordinary = [r for r in test if not truth[r["doc_id"]]]
    assert np.mean([r["predicted"] for r in toxic]) > 0.5
    assert np.mean([r["predicted"] for r in ordinary]) < 0.1
    assert len({r["score"] for r in ordinary}) > 0.9 * len(ordinary)


def test_more_evidence_never_lowers_a_score(spark, workspace):
    docs, labels, _ = corpus(spark, 8, 90)
    model = toxicity.fit(docs, labels, workspace)
    assert (model.weights[:2] >= 0).all()


def test_blocks_do_not_change_features(monkeypatch):
    from twinsieve.llm import text

    ratios = toxicity.Ratios(
        *(np.sort(np.arange(1, 3, dtype=np.uint64)), np.ones(2)) * 2,
    )
    words, _ = toxicity.word_hashes(*column_bytes(pa.array(["x y"])), toxicity.WORD_BYTES)
    order = np.argsort(words)
    ratios = toxicity.Ratios(words[order], np.array([1.0, 2.0])[order], words[:0], np.empty(0))
    texts = pa.array(["x y x", "", "y", "z " * 50 + "y", None])
    whole = ratios.features(*column_bytes(texts))
    assert whole[0, 0] > 0 and whole[1, 0] == 0
    monkeypatch.setattr(toxicity, "blocks", lambda bounds: text.blocks(bounds, 3))
    assert ratios.features(*column_bytes(texts)).tolist() == whole.tolist()
