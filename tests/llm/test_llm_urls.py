"""URL filters: parsing and rules against plain Python, the regression by held-out accuracy."""

import random

import numpy as np
import pytest
from twinsieve.llm import urls
from twinsieve.llm.queries import URL_RULES

UPPER_TO_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host, rest = rest[:end], rest[end:]
    stop = min((rest.find(c) for c in "?#" if c in rest), default=len(rest))
    return host.translate(UPPER_TO_LOWER), rest[:stop]


def rule_of(host, path):
    fitting = []
    for verdict, rule in URL_RULES:
        name, _, start = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + start):
            fitting.append((len(rule), rule, verdict))
    return max(fitting)[1:] if fitting else (None, None)


URLS = [
    None, "", "no scheme", "://", "http://", "http:///path", "http://A.Example.ORG/ES/x",
    "http://a.example.org/es/x?y#z", "http://example.org/es", "http://example.org/es/",
    "http://badexample.org/es/", "http://example.org/en/1", "http://example.org/en/12/3",
    "http://x.org", "http://x.org?q=/es/", "http://x.org#/", "HTTPS://ÄÖÜ.COM/fr/É",
    "http://x.com/fr", "http://x.com/de/1", "http://com/de/", "http://org:80/", "http://a@x.org/",
    "ftp://x.net/a://b", "http://x.net/\nline", "a://b://c/d", "http://x.org/?" + "q" * 50_000,
]


@pytest.fixture(scope="module")
def model(spark):
    frame = spark.createDataFrame(urls.labelled_urls(), "url string, label int")
    return urls.fit(frame, "url", "label")


def test_parts_and_rules(spark, model):
    rows = [(i, u, ["x"], "y") for i, u in enumerate(URLS)] + [(0, None, None, None)]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, host array<string>, rule string")
    got = urls.judged(frame, model, URL_RULES).collect()
    assert len(got) == len(rows)
    for row in got:
        host, path = parts(URLS[row["page_id"]])
        rule, verdict = rule_of(host, path)
        assert (row["host"], row["path"], row["rule"]) == (host, path, rule)
        assert row["verdict"] == (verdict or ("block" if row["score"] >= 0.6 else "allow"))
    assert urls.judged(frame.limit(0), model, URL_RULES).count() == 0
    assert [r["verdict"] for r in got if not r["host"] and not r["path"]] == ["allow"] * 6


def test_held_out_names_are_told_apart(spark):
    rows = urls.labelled_urls()
    pick = random.Random(1)
    names = sorted({u.split("//")[1].split(".example")[0].split(".")[-1] for u, _ in rows})
    held = set(pick.sample(names, len(names) // 4))

    def is_held(url):
        return any(f"/{n}." in url or f".{n}." in url for n in held)

    train = spark.createDataFrame([r for r in rows if not is_held(r[0])], "url string, label int")
    model = urls.fit(train, "url", "label")
    test = [(i, u, y) for i, (u, y) in enumerate(rows) if is_held(u)]
    frame = spark.createDataFrame(test, "page_id bigint, url string, label int")
    got = {r["page_id"]: r["verdict"] == "block" for r in urls.judged(frame, model).collect()}
    right = [got[i] == bool(y) for i, _, y in test]
    assert np.mean(right) > 0.75


def plain_features(host, path, params):
    """(bucket, count) of the n-grams of one URL, byte by byte."""
    found = {}
    for salt, text in ((1, host.encode()), (2, path.encode())):
        for size in params.sizes:
            for at in range(len(text) - size + 1):
                key = np.array([salt * 16 + size], np.uint64)
                for byte in text[at : at + size]:
                    key = urls.mixed(key * np.uint64(257) + np.uint64(byte))
                bucket = int(key[0] % np.uint64(params.buckets))
                found[bucket] = found.get(bucket, 0) + 1
    return found


def test_scores_follow_the_formula(spark, model):
    rows = [(i, u) for i, u in enumerate(URLS) if not u or len(u) < 1000]
    frame = spark.createDataFrame(rows, "page_id bigint, url string")
    got = {r["page_id"]: r["score"] for r in urls.judged(frame, model).collect()}
    for i, url in rows:
        found = plain_features(*parts(url), model.params)
        size = max(sum(found.values()), 1)
        slope = sum(n * model.weights[b] for b, n in found.items()) / np.sqrt(size)
        assert got[i] == pytest.approx(1 / (1 + np.exp(-slope - model.intercept)))


def test_known_names_are_learnt(spark, model):
    rows = [(i, f"http://shop.{n}.example.net/new/{i}", y) for y in (0, 1)
            for i, n in enumerate(urls._NAMES[y].split(), 100 * y)]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, label int")
    got = {r["page_id"]: r["verdict"] for r in urls.judged(frame, model).collect()}
    assert np.mean([(got[i] == "block") == bool(y) for i, _, y in rows]) > 0.97


def test_training_takes_odd_tables(spark):
    odd = spark.createDataFrame([(None, 1), ("http://x.y/", None), ("", 0), ("a", 7)], "u string, y int")
    for frame in (odd, odd.limit(0)):
        model = urls.fit(frame, "u", "y")
        assert np.isfinite(model.weights).all() and np.isfinite(model.intercept)
