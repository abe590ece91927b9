"""Audits of keys that a warehouse declares but does not enforce."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from twinsieve.operators.uniqueness import key_counts
from twinsieve.sources.workspace import Workspace


class KeyNotUnique(ValueError):
    """A key that has to be unique and not null is not."""


def primary_key_audit(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """(key columns, n): keys that occur more than once or have a null column."""
    null = F.greatest(*[F.col(c).isNull() for c in key], F.lit(False))
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where((F.col("n") > 1) | null)


def key_report(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row: n_rows, n_keys, repeated_keys, repeated_rows and null_rows of a key."""
    null = F.greatest(*[F.col(c).isNull() for c in key], F.lit(False)).alias("__null")
    counts = df.select(*key, null).groupBy(*key, "__null").agg(F.count(F.lit(1)).alias("n"))
    repeated = (F.col("n") > 1) & ~F.col("__null")
    return counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.count_if(~F.col("__null")).alias("n_keys"),
        F.count_if(repeated).alias("repeated_keys"),
        F.coalesce(F.sum(F.when(repeated, F.col("n"))), F.lit(0)).alias("repeated_rows"),
        F.coalesce(F.sum(F.when(F.col("__null"), F.col("n"))), F.lit(0)).alias("null_rows"),
    )


def require_key(df: DataFrame, key: Sequence[str], workspace: Workspace) -> None:
    """Raise ``KeyNotUnique`` if a key occurs twice or is null. The keys are not shuffled."""
    found = key_counts(df, key, workspace)
    if found.repeated_rows or found.null_rows:
        raise KeyNotUnique(f"{', '.join(key)} is no key: {found}")


def foreign_key_audit(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """(column, n): values of the child's key that the parent lacks; null refers to nothing.

    The child is counted by value before the join, so a frequent value is one row there.
    """
    values = child.where(F.col(column).isNotNull()).groupBy(column).agg(
        F.count(F.lit(1)).alias("n")
    )
    return values.join(parent.select(F.col(key).alias(column)), column, "left_anti")
