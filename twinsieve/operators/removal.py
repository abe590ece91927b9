"""Keeping one row of each component without shuffling the kept text."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from twinsieve.operators.key_filter import with_maybe


def keep_one(df: DataFrame, components: DataFrame, key: str) -> DataFrame:
    """The rows that are in no component or are the smallest of theirs, with the same schema.

    ``components`` should be a staged table: it is counted here. A bit array of bounded size marks
    the hashes of the removed keys. Rows whose bit is not set are kept without a shuffle; the
    others, which are the removed ones and few more, meet the exact key list in a join. ``df``
    is read twice, which costs less than to shuffle all of its text.
    """
    marked, exact = _marked(df, components, key)
    kept = marked.where("NOT __maybe").select(*df.columns)
    checked = marked.where("__maybe").join(exact, key, "left_anti").select(*df.columns)
    return kept.unionByName(checked)


def removed(df: DataFrame, components: DataFrame, key: str) -> DataFrame:
    """The rows that ``keep_one`` leaves out."""
    marked, exact = _marked(df, components, key)
    return marked.where("__maybe").join(exact, key, "left_semi").select(*df.columns)


def _marked(df: DataFrame, components: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    keys = components.select(F.col("id").alias(key))
    return with_maybe(df, key, keys, keys.count()), keys
