"""Column profiles in long form: (entity, instance, name, value), all strings."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class ProfileSpec:
    """What to measure. Columns the table lacks are skipped, but not a unique key."""

    complete: Sequence[str] = ()
    numeric: Sequence[str] = ()
    unique_key: Sequence[str] = ()


# The columns profiled in the wide table of source files.
REPOSITORY_PROFILE = ProfileSpec(
    complete=(
        "repo_id",
        "path",
        "content",
        "owner",
        "name",
        "commit_sha",
        "main_language",
        "license",
        "is_fork",
    ),
    numeric=("size", "stars", "forks", "issues"),
    unique_key=("repo_id", "path", "commit_sha"),
)


def completeness(column: str) -> Column:
    """Share of rows that are not null; null for an empty table."""
    return F.try_divide(F.count(column), F.count(F.lit(1)))


def key_uniqueness(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row, ``value``: the share of rows whose key occurs once; null for an empty table.

    Rows whose key columns are all null count as rows but never as unique.
    """
    some = F.greatest(*[F.col(c).isNotNull() for c in key], F.lit(False))
    single = (F.col("__n") == 1) & some
    return (
        df.groupBy(*key)
        .agg(F.count(F.lit(1)).alias("__n"))
        .agg(F.try_divide(F.sum(F.when(single, 1).otherwise(0)), F.sum("__n")).alias("value"))
    )


def profile_aggregates(df: DataFrame, spec: ProfileSpec) -> list[tuple[str, str, str, Column]]:
    """(entity, instance, name, aggregate) of each single-column metric that ``df`` allows."""
    metrics = [("Dataset", "*", "Size", F.count(F.lit(1)))]
    for column in spec.complete:
        if column in df.columns:
            metrics.append(("Column", column, "Completeness", completeness(column)))
    for column in spec.numeric:
        if column in df.columns:
            for name, function in (("Mean", F.avg), ("Maximum", F.max), ("Minimum", F.min)):
                metrics.append(("Column", column, name, function(column)))
    return [(*labels, value.cast("double")) for *labels, value in metrics]


def profile(df: DataFrame, spec: ProfileSpec, hidden: Sequence[str] = ()) -> DataFrame:
    """Size, completeness, mean, maximum, minimum, key uniqueness and schema of a table.

    All single-column metrics come from one aggregate over the columns they name; uniqueness
    is a second one. ``hidden`` columns are left out of the schema row. A metric without a
    value, such as the mean of a column of nulls, gives no row.
    """
    aggregates = profile_aggregates(df, spec)
    totals = df.agg(*[a[3].alias(f"p{i}") for i, a in enumerate(aggregates)])
    return profile_rows(df.drop(*hidden), spec, aggregates, totals, partial(key_uniqueness, df))


def profile_rows(
    df: DataFrame,
    spec: ProfileSpec,
    aggregates: list[tuple[str, str, str, Column]],
    totals: DataFrame,
    uniqueness: Callable[[Sequence[str]], DataFrame],
) -> DataFrame:
    """The profile in long form, from totals named p0, p1, ... in the order of ``aggregates``."""
    rows = [
        _row(entity, instance, name, _number_text(F.col(f"p{i}")))
        for i, (entity, instance, name, _) in enumerate(aggregates)
    ]
    rows.append(_row("Dataset", "*", "schema", F.lit(df.schema.json())))
    result = totals.select(F.inline(F.array(*rows)))
    if spec.unique_key and set(spec.unique_key) <= set(df.columns):
        key = ",".join(spec.unique_key)
        value = F.col("value").cast("string")
        unique = uniqueness(spec.unique_key).select(
            F.inline(F.array(_row("Multicolumn", key, "Uniqueness", value)))
        )
        result = result.unionByName(unique)
    return result.where("value IS NOT NULL")


def numbered_rows(
    df: DataFrame, aggregates: list[tuple[str, str, str, Column]], schema: Column
) -> DataFrame:
    """Metrics in long form, from aggregates over ``df`` and one that is the schema's JSON."""
    totals = df.agg(*[a[3].alias(f"p{i}") for i, a in enumerate(aggregates)], schema.alias("s"))
    rows = [
        _row(entity, instance, name, _number_text(F.col(f"p{i}")))
        for i, (entity, instance, name, _) in enumerate(aggregates)
    ]
    rows.append(_row("Dataset", "*", "schema", F.col("s")))
    return totals.select(F.inline(F.array(*rows))).where("value IS NOT NULL")


def metric(metrics: DataFrame, name: str, entity: str = "Dataset") -> DataFrame:
    """The values of one metric."""
    return metrics.filter((F.col("entity") == entity) & (F.col("name") == name)).select("value")


def _number_text(value: Column) -> Column:
    """A DOUBLE as text. Whole numbers from 10^7 on keep their digits; a cast gives an exponent."""
    size = F.abs(value)
    whole = (size >= 1e7) & (size < 2.0**63) & (F.rint(value) == value)
    digits = F.concat(value.cast("bigint").cast("string"), F.lit(".0"))
    return F.when(whole, digits).otherwise(value.cast("string"))


def _row(entity: str, instance: str, name: str, value: Column) -> Column:
    return F.struct(
        F.lit(entity).alias("entity"),
        F.lit(instance).alias("instance"),
        F.lit(name).alias("name"),
        value.alias("value"),
    )
