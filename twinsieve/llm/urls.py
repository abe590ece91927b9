"""URL filters: a rule list first, then logistic regression on hashed character n-grams.

The host is what follows the first "://" up to "/", "?", "#" or the end, A to Z in lower case; the
path goes on from there up to "?", "#" or the end. Both are empty for a null URL or one without
"://". A rule is a host and the start of a path; it fits that host and its subdomains. The longest
fitting rule decides. URLs that no rule fits are judged by the regression, whose features are the
n-grams of host and path, hashed apart from each other. It is trained from a small table of labelled
URLs, which is a parameter, and its weights are the only thing that is broadcast.

Each row is judged for itself, so repeated rows and ids do no harm. A URL without host and path has
no features and gets the verdict of the intercept. Very long URLs are read whole. An empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from twinsieve.llm.text import column_bytes, mixed

ALLOW, BLOCK = "allow", "block"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"

# A small labelled table: names of sites, by hand. 1 is to be blocked.
_NAMES = {
    1: """casino-win lucky-casino casino-bonus online-slots free-bets best-bets bets-today poker-win
    cheap-pills pills-store diet-pills buy-meds spam-farm link-farm farm-links spam-mail adult-x
    adult-cams xxx-tube hot-dates ads-track track-click ad-server click-ads easy-loans fast-cash
    win-prize free-gifts crack-keys replica-shop""",
    0: """city-library news-daily open-source garden-club weather history-notes science-review
    art-museum book-reviews cooking travel-diary football-club music-school math-lessons
    state-archive public-health village-council railway-times film-festival language-course
    tionhe reondst therin ndestle anthou erlist einkeit schunge chlich zuversten geberin tretion
    pasmen quellen mentiva ciones llados bocarre arada esulta""",
}
_PREFIXES = ("", "www.", "m.", "blog.")
_ENDINGS = ("com", "org", "net")
_PATHS = ("", "/", "/en/{}.html", "/de/{}", "/fr/{}/", "/es/{}", "/a/b/{}")


@dataclass(frozen=True)
class UrlParams:
    sizes: tuple[int, ...] = (3, 4, 5)
    buckets: int = 1 << 16
    ridge: float = 0.01
    steps: int = 300
    rate: float = 2.0
    threshold: float = 0.6


def labelled_urls() -> list[tuple[str, int]]:
    """(url, label): each name with a prefix, an ending and a path in turn."""
    rows = []
    for label, names in _NAMES.items():
        for i, name in enumerate(names.split()):
            for j in range(3):
                path = _PATHS[(i + 3 * j) % len(_PATHS)].format(17 * i + 1009 * j)
                ending = f"example.{_ENDINGS[(i + j) % len(_ENDINGS)]}"
                rows.append((f"https://{_PREFIXES[(i + j) % 4]}{name}.{ending}{path}", label))
    return rows


def with_parts(df: DataFrame, url: str = "url") -> DataFrame:
    """``df`` with ``host`` and ``path``."""
    text = F.coalesce(F.col(url), F.lit(""))
    host = F.translate(F.regexp_extract(text, _PARTS, 1), _UPPER, _LOWER)
    return df.withColumns({"host": host, "path": F.regexp_extract(text, _PARTS, 2)})


def rule_columns(rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, over ``host`` and ``path``; null if none fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    # From the shortest to the longest, so a longer one is asked first.
    for decision, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        host, slash, path = rule.partition("/")
        same = (F.col("host") == host) | F.col("host").endswith(f".{host}")
        fits = same & F.col("path").startswith(slash + path)
        name = F.when(fits, F.lit(rule)).otherwise(name)
        verdict = F.when(fits, F.lit(decision)).otherwise(verdict)
    return name, verdict


def _features(column: pa.Array, salt: int, params: UrlParams) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of each n-gram of a column of texts."""
    data, bounds = column_bytes(column)
    row = np.repeat(np.arange(len(column)), np.diff(bounds))
    room = bounds[1:][row] - np.arange(len(data))
    rows, found = [], []
    for size in params.sizes:
        at = np.flatnonzero(room >= size)
        key = np.full(len(at), salt * 16 + size, np.uint64)
        for i in range(size):
            key = mixed(key * np.uint64(257) + data[at + i])
        rows.append(row[at])
        found.append((key % np.uint64(params.buckets)).astype(np.int64))
    return np.concatenate(rows), np.concatenate(found)


@dataclass(frozen=True)
class UrlModel:
    weights: np.ndarray
    intercept: float
    params: UrlParams

    def score(self, host: pa.Array, path: pa.Array) -> np.ndarray:
        row, bucket = _all_features(host, path, self.params)
        sums = np.bincount(row, self.weights[bucket], minlength=len(host))
        sizes = np.maximum(np.bincount(row, minlength=len(host)), 1)
        return 1 / (1 + np.exp(-np.clip(sums / np.sqrt(sizes) + self.intercept, -30, 30)))


def _all_features(
    host: pa.Array, path: pa.Array, params: UrlParams
) -> tuple[np.ndarray, np.ndarray]:
    both = _features(host, 1, params), _features(path, 2, params)
    return np.concatenate([b[0] for b in both]), np.concatenate([b[1] for b in both])


def fit(labelled: DataFrame, url: str, label: str, params: UrlParams = UrlParams()) -> UrlModel:
    """Gradient descent over a small table of labelled URLs; rows without a 0 or 1 take no part."""
    rows = with_parts(labelled.where(F.col(label).isin(0, 1)), url)
    table = rows.select("host", "path", F.col(label).cast("double").alias("y")).toArrow()
    y = table["y"].to_numpy()
    row, bucket = _all_features(*(_one(table[n]) for n in ("host", "path")), params)
    size = np.maximum(np.bincount(row, minlength=len(y)), 1)
    value = 1 / np.sqrt(size[row])
    share = np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3)
    weight = np.where(y == 1, 0.5 / share, 0.5 / (1 - share)) / max(len(y), 1)
    weights, intercept = np.zeros(params.buckets), 0.0
    for _ in range(params.steps):
        z = np.bincount(row, weights[bucket] * value, minlength=len(y)) + intercept
        slope = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y)
        step = np.bincount(bucket, slope[row] * value, minlength=params.buckets)
        weights -= params.rate * (step + params.ridge * weights / params.buckets)
        intercept -= params.rate * slope.sum()
    return UrlModel(weights, intercept, params)


def _one(column: pa.ChunkedArray) -> pa.Array:
    return pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)


def judged(
    df: DataFrame,
    model: UrlModel,
    rules: Sequence[tuple[str, str]] = (),
    key: str = "page_id",
    url: str = "url",
) -> DataFrame:
    """(key, host, path, rule, verdict, score) of each row."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = shared.value.score(batch.column("host"), batch.column("path"))
            yield batch.append_column("score", pa.array(score, pa.float64()))

    parts = with_parts(df.select(F.col(key), F.col(url).cast("string").alias("url")), "url")
    rows = parts.select(F.col(key).alias("id"), "host", "path")
    kind = rows.schema["id"].dataType.simpleString()
    scored = rows.mapInArrow(scan, f"id {kind}, host string, path string, score double")
    rule, verdict = rule_columns(rules)
    guess = F.when(F.col("score") >= model.params.threshold, BLOCK).otherwise(ALLOW)
    return scored.select(
        F.col("id").alias(key),
        "host",
        "path",
        rule.alias("rule"),
        F.coalesce(verdict, guess).alias("verdict"),
        "score",
    )
