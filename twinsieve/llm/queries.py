"""The registered queries of this subpackage, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from twinsieve.llm import (
    alignment,
    circulant,
    conversations,
    licenses,
    masked_lm,
    packing,
    pieces,
    rules,
    shards,
    sql,
    topk,
    toxicity,
    units,
    urls,
)
from twinsieve.sources.tables import read_table
from twinsieve.sources.workspace import Workspace


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf}/{name}.parquet", "parquet")


def _texts(spark: SparkSession, sf: str) -> DataFrame:
    return _table(spark, sf, "documents").select("doc_id", "text")


def op1_top_k(spark: SparkSession, sf: str) -> DataFrame:
    vectors = _table(spark, sf, "embeddings").select("vec_id", "embedding")
    return topk.top_k(vectors, F.col("id") % 100 == 0, Workspace(spark))


def op2_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    texts = _texts(spark, sf)
    model = toxicity.fit(texts, _table(spark, sf, "labels"), Workspace(spark))
    found = toxicity.scored(texts, model)
    return found.withColumn("held_out", toxicity.held_out(F.col("doc_id")))


def op3_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    judged = rules.verdicts(_texts(spark, sf))
    return judged.drop("text")


def op4_packing(spark: SparkSession, sf: str) -> DataFrame:
    params = packing.PackParams(public_tokenizers.path("word_bpe_49k.json"))
    pieces = packing.packed(_texts(spark, sf), params)
    return pieces.withColumn("ids", F.crc32("ids")).withColumnRenamed("ids", "ids_crc32")


def op5_lm_scoring(spark: SparkSession, sf: str) -> DataFrame:
    return masked_lm.lm_scores(_texts(spark, sf), Workspace(spark))


URL_RULES = (
    (urls.ALLOW, "org/"),
    (urls.BLOCK, "example.org/es/"),
    (urls.BLOCK, "example.org/en/1"),
    (urls.ALLOW, "com/fr/"),
    (urls.BLOCK, "com/de/"),
)


def op6_url_filters(spark: SparkSession, sf: str) -> DataFrame:
    labelled = spark.createDataFrame(urls.labelled_urls(), "url string, label int")
    model = urls.fit(labelled, "url", "label")
    return urls.judged(_table(spark, sf, "pages"), model, URL_RULES)


def op7_sentencepiece(spark: SparkSession, sf: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    return pieces.round_trip(_texts(spark, sf), model).select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_ids"),
        "ids",
        F.crc32(F.encode("text", "UTF-8")).alias("decoded_crc32"),
    )


def op8_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return units.deduplicated(_texts(spark, sf), Workspace(spark), params=units.WINDOWS)


def op9_near_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return circulant.components(_texts(spark, sf), Workspace(spark))


def op10_sharding(spark: SparkSession, sf: str) -> DataFrame:
    return shards.sharded(_texts(spark, sf), Workspace(spark))


def op11_token_alignment(spark: SparkSession, sf: str) -> DataFrame:
    params = alignment.AlignParams(
        public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    )
    return alignment.aligned(_texts(spark, sf), params, Workspace(spark))


def op12_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.labelled(_texts(spark, sf), Workspace(spark))


def op13_conversation_repair(spark: SparkSession, sf: str) -> DataFrame:
    turns = _table(spark, sf, "conversations")
    return conversations.repairs(turns, Workspace(spark), damage=True)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_top_k": op1_top_k,
        "op2_toxicity": op2_toxicity,
        "op3_quality_rules": op3_quality_rules,
        "op4_packing": op4_packing,
        "op5_lm_scoring": op5_lm_scoring,
        "op6_url_filters": op6_url_filters,
        "op7_sentencepiece": op7_sentencepiece,
        "op8_substring_dedup": op8_substring_dedup,
        "op9_near_duplicates": op9_near_duplicates,
        "op10_sharding": op10_sharding,
        "op11_token_alignment": op11_token_alignment,
        "op12_license_scan": op12_license_scan,
        "op13_conversation_repair": op13_conversation_repair,
    }


def oracle_sql() -> dict[str, str]:
    return sql.statements()
