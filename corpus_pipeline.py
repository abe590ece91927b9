"""A corpus pipeline in five stages over the table ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run`` writes as Parquet and
reads again as the next stage's documents. All stages but the last one return the columns of
``documents``.

1. quality_rules drops texts that fail the rule table.
2. toxicity drops texts predicted to be toxic; the models learn from the labelled rows among the
   documents that are left.
3. near_dedup keeps the document with the smallest id of each group of near-duplicates.
4. substring_dedup cuts repeated lines and sentences out of the texts; ``n_chars`` follows. A document
   of which nothing is left goes.
5. packing cuts the token ids of the texts into sequences, a row per piece.

Null or repeated ids, empty and very long texts and empty tables are treated as the operators define.
Rows without an id are never near-duplicates. Columns beyond those of ``documents`` are passed on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

import public_tokenizers
from twinsieve.llm import circulant, packing, rules, toxicity, units
from twinsieve.operators.removal import keep_one
from twinsieve.sources.tables import read_table
from twinsieve.sources.workspace import Workspace


# Near-duplicates share at least this per cent of their five-word shingles.
NEAR = circulant.NearParams(percent=80)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return rules.keep_good(docs)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = read_table(spark, f"{sf_dir}/labels.parquet", "parquet")
    model = toxicity.fit(docs, labels, Workspace(spark))
    return toxicity.keep_ordinary(docs, model)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    workspace = Workspace(spark)
    found = circulant.components(docs, workspace, params=NEAR)
    dropped = found.where("NOT kept").select(F.col("doc_id").alias("id"))
    return keep_one(docs, workspace.stage(dropped.distinct(), "dropped"), "doc_id")


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = units.deduplicated(docs, Workspace(spark), params=units.WINDOWS)
    emptied = (F.size("removed") > 0) & (F.trim("text") == "")
    changed = found.where(~F.coalesce(emptied, F.lit(False)))
    if "n_chars" in docs.columns:
        length = F.when(F.size("removed") > 0, F.length("text").cast("bigint"))
        kind = docs.schema["n_chars"].dataType
        changed = changed.withColumn("n_chars", F.coalesce(length.cast(kind), "n_chars"))
    return changed.select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    params = packing.PackParams(public_tokenizers.path("word_bpe_49k.json"))
    return packing.packed(docs, params)


STAGES = [
    ("quality_rules", quality_rules),
    ("toxicity", drop_toxic),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("packing", pack),
]

# The toxicity stage trains a model, and the packing stage runs a tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the table ``documents``."""
    workspace = Workspace(spark)
    docs = read_table(spark, f"{sf_dir}/documents.parquet", "parquet")
    for name, stage in STAGES:
        docs = workspace.stage(stage(spark, docs, sf_dir), name)
    return docs
