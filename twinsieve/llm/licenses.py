"""License scans by diagonal voting.

Words are runs of ASCII letters and digits and of other non-ASCII characters, A to Z in lower case.
Every rolling window of ``gram`` words of every text is a row with its hash, its place and its first
word as it stands. These rows are joined with the windows of the license templates. A match of the
text's place p with the template's place t votes for the diagonal p - t of the pair of text and
template. Diagonals no more than ``slack`` apart are merged, as an inserted or missing word shifts
the rest by one. What they cover is a span, which is verified: the words themselves have
to be equal, not their hashes alone, and enough of the template's words have to be there
(``least_share``), in a stretch that holds little else (``least_density``). Of spans that lie over
each other those of the license stay of which the greatest share is there.

Beside the spans, short phrases name a license by themselves; they are found as plain runs of words.
The score is the greatest share of a template that a verified span covers, and for a text with such
a phrase ``phrase_score`` at least.

All windows of all texts take part. Matches stay on their own text and template, so no group is
larger than what one text holds. The templates are a parameter; their windows are counted, and reach
the texts by broadcast only up to ``most_broadcast`` of them.

Defined results: a null text is an empty one. Texts without words have no spans, null places, empty
labels and the score 0. Repeated rows, and rows that share an id or have none, are scanned each for
itself. A window never leaves its text. An empty table gives an empty result. Other columns of the
table are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from twinsieve.llm.text import LOWER, WORD_BYTES, blocks, column_bytes, mixed, word_spans
from twinsieve.sources.tables import fill_cluster
from twinsieve.sources.workspace import Workspace

# Bytes of text whose windows are made together.
BLOCK = 1 << 20
# A table too small to give each core a split of this size is spread over the cores first.
SPLIT_BYTES = 16 << 20

# Phrases that name a license, and public license texts and notices.
PHRASES = (
    ("mit license", "mit"),
    ("apache license", "apache"),
    ("general public license", "gpl"),
)
TEMPLATES = {
    "mit-notice": (
        "mit",
        "Released under the MIT License.",
    ),
    "mit": (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the \"Software\"), to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, "
        "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in "
        "all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", "
        "WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
        "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN "
        "NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR "
        "OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT "
        "OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    "apache-line": (
        "apache",
        "Licensed under the Apache License, Version 2.0.",
    ),
    "apache-notice": (
        "apache",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this "
        "file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed "
        "to in writing, software distributed under the License is distributed on an \"AS IS\" "
        "BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the "
        "License for the specific language governing permissions and limitations under the "
        "License.",
    ),
    "gpl-line": (
        "gpl",
        "This work is licensed under the GNU General Public License, version 3.",
    ),
    "gpl-notice": (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version. This program is "
        "distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even "
        "the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU "
        "General Public License for more details.",
    ),
    "lgpl-notice": (
        "lgpl",
        "This library is free software; you can redistribute it and/or modify it under the terms "
        "of the GNU Lesser General Public License as published by the Free Software Foundation; "
        "either version 2.1 of the License, or (at your option) any later version.",
    ),
    "bsd": (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met: Redistributions of source code "
        "must retain the above copyright notice, this list of conditions and the following "
        "disclaimer. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other "
        "materials provided with the distribution.",
    ),
    "isc": (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies.",
    ),
    "mpl-notice": (
        "mpl",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a "
        "copy of the MPL was not distributed with this file, You can obtain one at "
        "http://mozilla.org/MPL/2.0/.",
    ),
    "unlicense": (
        "unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free "
        "to copy, modify, publish, use, compile, sell, or distribute this software, either in "
        "source code form or as a compiled binary, for any purpose, commercial or non-commercial, "
        "and by any means.",
    ),
    "zlib": (
        "zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event "
        "will the authors be held liable for any damages arising from the use of this software. "
        "Permission is granted to anyone to use this software for any purpose, including "
        "commercial applications, and to alter it and redistribute it freely, subject to the "
        "following restrictions:",
    ),
    "cc-by": ("cc-by", "Licensed under CC BY 4.0."),
    "cc-by-sa": ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    "cc-by-nc": ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    "cc-by-long": (
        "cc-by",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
}


@dataclass(frozen=True)
class LicenseParams:
    gram: int = 4
    slack: int = 3
    least_share: float = 0.7
    least_density: float = 0.6
    phrase_score: float = 0.5
    most_broadcast: int = 1 << 20


_HEAD = (
    "struct<key: {key}, n_words: bigint, n_base: bigint, first_word: bigint, last_word: bigint, "
    "base_labels: string>"
)
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _words(text: str) -> tuple[np.ndarray, list[str]]:
    """The hashes of a text's words and the words in lower case."""
    raw = np.frombuffer(text.encode(), np.uint8)
    hashes, starts, stops = word_spans(raw, np.array([0, len(raw)]), WORD_BYTES, LOWER)
    low = LOWER[raw].tobytes()
    found = zip(starts.tolist(), stops.tolist(), strict=True)
    return hashes, [low[i:j].decode() for i, j in found]


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """The hash of the window that starts at each word but the last ``size`` - 1."""
    count = max(len(words) - size + 1, 0)
    found = np.zeros(count, np.uint64)
    for i in range(size):
        found = mixed(found * np.uint64(0x9E3779B97F4A7C15) + words[i : i + count])
    return found


def template_windows(
    spark: SparkSession, templates: Mapping[str, tuple[str, str]], size: int
) -> DataFrame:
    """(gram, word, template, place, template_words, label) of each window of each template."""
    rows = []
    for name, (label, text) in templates.items():
        hashes, words = _words(text)
        if len(words) < size:
            raise ValueError(f"template {name} has fewer than {size} words")
        for place, gram in enumerate(gram_hashes(hashes, size).view(np.int64).tolist()):
            rows.append((gram, words[place], name, place, len(words), label))
    return spark.createDataFrame(
        rows,
        "gram bigint, word string, template string, place int, template_words int, label string",
    )


class _Phrases:
    """Short runs of words that stand for a label."""

    def __init__(self, phrases: Sequence[tuple[str, str]]):
        self.runs = [(_words(text)[0], label) for text, label in phrases]

    def found(self, words: np.ndarray, bounds: np.ndarray) -> list[list]:
        """Per text: number of places, first and last place, labels."""
        places, labels = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        for k, (run, _) in enumerate(self.runs):
            count = max(len(words) - len(run) + 1, 0)
            hit = np.ones(count, bool)
            for i, word in enumerate(run):
                hit &= words[i : i + count] == word
            at = np.flatnonzero(hit)
            at = at[text[at] == text[at + len(run) - 1]]
            places.append(at)
            labels.append(np.full(len(at), k))
        at, kind = np.concatenate(places), np.concatenate(labels)
        order = np.argsort(at, kind="stable")
        at, kind = at[order], kind[order]
        edges = np.searchsorted(at, bounds).tolist()
        rows: list[list] = [[], [], [], []]
        for i, (low, high) in enumerate(zip(edges, edges[1:], strict=False)):
            names = sorted({self.runs[k][1] for k in np.unique(kind[low:high]).tolist()})
            some = high > low
            rows[0].append(high - low)
            rows[1].append(int(at[low] - bounds[i]) if some else None)
            rows[2].append(int(at[high - 1] - bounds[i]) if some else None)
            rows[3].append(",".join(names))
        return rows


def _scanned(
    df: DataFrame, key: str, text: str, phrases: Sequence[tuple[str, str]], size: int
) -> DataFrame:
    """(row, head, gram, at, word): a head for each text, and a row for each of its windows.

    ``row`` numbers the texts of a pass. All that follows is made from one pass, which is staged."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        short = _Phrases(phrases)
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            data, bounds = column_bytes(batch.column(1))
            for i, j in blocks(bounds, BLOCK):
                part = data[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i]
                keys = batch.column(0).slice(i, j - i)
                yield from _windows(keys, *part, row, short, size)
                row += j - i

    rows = df.select(F.col(key).alias("key"), F.col(text).cast("string"))
    head = _HEAD.format(key=rows.schema["key"].dataType.simpleString())
    schema = f"row bigint, head {head}, gram bigint, at int, word binary"
    return rows.mapInArrow(scan, schema)


def _windows(
    keys: pa.Array,
    data: np.ndarray,
    bounds: np.ndarray,
    row: int,
    phrases: _Phrases,
    size: int,
) -> Iterator[pa.RecordBatch]:
    hashes, starts, _ = word_spans(data, bounds, WORD_BYTES, LOWER)
    ends = np.searchsorted(starts, bounds)
    n_base, first, last, labels = phrases.found(hashes, ends)
    count = len(keys)
    head = pa.StructArray.from_arrays(
        [
            keys,
            pa.array(np.diff(ends)),
            *[pa.array(c, pa.int64()) for c in (n_base, first, last)],
            pa.array(labels, pa.string()),
        ],
        names=["key", "n_words", "n_base", "first_word", "last_word", "base_labels"],
    )
    names = ["row", "head", "gram", "at", "word"]
    numbers = row + np.arange(count)
    nothing = [pa.nulls(count, t) for t in (pa.int64(), pa.int32(), pa.binary())]
    yield pa.RecordBatch.from_arrays([pa.array(numbers), head, *nothing], names=names)
    text = np.repeat(np.arange(count), np.diff(ends))
    grams = gram_hashes(hashes, size)
    inside = np.flatnonzero(text[: len(grams)] == text[size - 1 :][: len(grams)])
    if not len(inside):
        return
    # A word and what follows it up to the next word, without copying the text.
    low = pa.py_buffer(LOWER[data].tobytes())
    edges = pa.py_buffer(np.append(starts, len(data)).astype(np.int32).tobytes())
    words = pa.Array.from_buffers(pa.binary(), len(starts), [None, edges, low])
    at = np.arange(len(starts)) - ends[text]
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(numbers[text[inside]]),
            pa.nulls(len(inside), head.type),
            pa.array(grams[inside].view(np.int64)),
            pa.array(at[inside].astype(np.int32)),
            words if len(inside) == len(words) else words.take(pa.array(inside)),
        ],
        names=names,
    )


def spans(hits: DataFrame, params: LicenseParams) -> DataFrame:
    """(row, label, template, first_word, last_word, votes, share, density) of verified spans.

    ``hits`` are (row, template, template_words, label, place, at). Each window below sees the hits
    of one text with one template.
    """
    pair = ["row", "template"]
    diagonal = F.col("at") - F.col("place")
    along = Window.partitionBy(*pair).orderBy("diagonal", "at")
    apart = F.col("diagonal") - F.lag("diagonal").over(along) > params.slack
    island = F.sum(F.when(apart, 1).otherwise(0)).over(along)
    merged = hits.withColumn("diagonal", diagonal).withColumn("island", island)
    # Words of the template that the span's windows cover, each once.
    across = Window.partitionBy(*pair, "island").orderBy("place")
    step = F.lead("place").over(across) - F.col("place")
    gain = F.least(F.coalesce(step, F.lit(params.gram)), F.lit(params.gram))
    found = (
        merged.withColumn("gain", gain)
        .groupBy(*pair, "island")
        .agg(
            F.first("label").alias("label"),
            F.min("at").cast("bigint").alias("first_word"),
            (F.max("at") + params.gram - 1).cast("bigint").alias("last_word"),
            F.count(F.lit(1)).alias("votes"),
            (F.sum("gain") / F.first("template_words")).alias("share"),
            F.sum("gain").alias("covered"),
        )
    )
    density = F.least(
        F.col("covered") / (F.col("last_word") - F.col("first_word") + 1), F.lit(1.0)
    )
    enough = (F.col("share") >= params.least_share) & (density >= params.least_density)
    return _closest(found.withColumn("density", density).where(enough), params).drop(
        "island", "covered"
    )


def _closest(found: DataFrame, params: LicenseParams) -> DataFrame:
    """Without the spans that lie over others of which a greater share is there, under another
    label: licenses that share sentences would else be found for each other."""
    along = Window.partitionBy("row").orderBy("first_word", "last_word", "template")
    reach = F.max("last_word").over(along.rowsBetween(Window.unboundedPreceding, -1))
    apart = F.when(F.col("first_word") > reach - params.gram, 1).otherwise(0)
    place = found.withColumn("apart", apart).withColumn("place", F.sum("apart").over(along))
    best = F.max(F.struct("share", "label")).over(Window.partitionBy("row", "place"))
    kept = (F.col("share") == F.col("best.share")) | (F.col("label") == F.col("best.label"))
    return place.withColumn("best", best).where(kept).drop("apart", "place", "best")


@dataclass(frozen=True)
class Scan:
    """``texts`` (row, head) of all texts, and ``spans``, see there."""

    texts: DataFrame
    spans: DataFrame


def scan_licenses(
    df: DataFrame,
    workspace: Workspace,
    key: str = "doc_id",
    text: str = "text",
    params: LicenseParams = LicenseParams(),
    templates: Mapping[str, tuple[str, str]] = TEMPLATES,
    phrases: Sequence[tuple[str, str]] = PHRASES,
) -> Scan:
    windows = template_windows(df.sparkSession, templates, params.gram)
    if windows.count() <= params.most_broadcast:
        windows = F.broadcast(windows)
    texts = fill_cluster(df.select(key, text), key, split_bytes=SPLIT_BYTES)
    rows = _scanned(texts, key, text, phrases, params.gram)
    known = windows.select(
        F.col("gram").alias("known"),
        F.col("word").alias("known_word"),
        "template",
        "place",
        "template_words",
        "label",
    )
    # The word is looked at only where the hash has matched, so it is no key of the join.
    word = F.regexp_extract(F.col("word").cast("string"), f"^{_WORD}", 0)
    is_match = F.col("head").isNotNull() | (word == F.col("known_word"))
    matched = rows.join(known, F.col("gram") == F.col("known"), "left").where(is_match)
    staged = workspace.stage(
        matched.select("row", "head", "template", "template_words", "label", "place", "at"), "hits"
    )
    hits = staged.where("head IS NULL").drop("head")
    return Scan(staged.where("head IS NOT NULL").select("row", "head"), spans(hits, params))


def labelled(
    df: DataFrame,
    workspace: Workspace,
    key: str = "doc_id",
    text: str = "text",
    params: LicenseParams = LicenseParams(),
) -> DataFrame:
    """(key, n_words, n_base, first_word, last_word, base_labels, labels, score, n_spans)."""
    found = scan_licenses(df, workspace, key, text, params)
    per_text = found.spans.groupBy("row").agg(
        F.collect_set("label").alias("names"),
        F.max("share").alias("share"),
        F.count(F.lit(1)).alias("n_spans"),
    )
    joined = found.texts.join(per_text, "row", "left")
    base = F.col("head.base_labels")
    own = F.filter(F.split(base, ","), lambda name: name != "")
    names = F.array_sort(F.array_union(own, F.coalesce("names", F.array().cast("array<string>"))))
    phrase = F.when(base != "", params.phrase_score).otherwise(0.0)
    score = F.least(F.greatest(F.coalesce("share", F.lit(0.0)), phrase), F.lit(1.0))
    return joined.select(
        F.col("head.key").alias(key),
        *[f"head.{n}" for n in ("n_words", "n_base", "first_word", "last_word", "base_labels")],
        F.array_join(names, ",").alias("labels"),
        score.alias("score"),
        F.coalesce("n_spans", F.lit(0)).cast("bigint").alias("n_spans"),
    )
