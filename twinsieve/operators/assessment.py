"""Profile and checks of one table from one shared pass, or from a pass that runs anyway."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, functions as F

from twinsieve.operators.checks import Constraint, applicable, check_rows, rule_aggregates
from twinsieve.operators.profile import ProfileSpec, profile_aggregates, profile_rows
from twinsieve.operators.uniqueness import uniqueness_row
from twinsieve.sources.workspace import Workspace


@dataclass(frozen=True)
class Assessment:
    profile: DataFrame
    checks: DataFrame


class Watched:
    """Totals of a table, taken while ``frame`` is read by whatever reads it first.

    A text column is then not read once more to count its values. ``frame`` has the rows of ``df``;
    it should be read to the end, and by one action only. ``table`` is what the totals are for, if
    that has fewer columns.
    """

    def __init__(
        self,
        df: DataFrame,
        spec: ProfileSpec,
        rules: Sequence[Constraint],
        table: DataFrame | None = None,
    ):
        table = df if table is None else table
        columns = _totals(table, spec, applicable(table, rules))
        self._seen = Observation()
        self._schema = table.agg(*columns).schema
        self._spark = df.sparkSession
        self.frame = df.observe(self._seen, *columns)

    def totals(self) -> DataFrame:
        """One row; waits for the first action on ``frame``.

        It is made of literals, as rows from a list would start a Python worker on each core.
        """
        values = self._seen.get
        row = [F.lit(values[f.name]).cast(f.dataType).alias(f.name) for f in self._schema]
        return self._spark.range(1, numPartitions=1).select(*row)


def _totals(df: DataFrame, spec: ProfileSpec, rules: Sequence[Constraint]) -> list[Column]:
    aggregates = profile_aggregates(df, spec)
    return [a[3].alias(f"p{i}") for i, a in enumerate(aggregates)] + rule_aggregates(df, rules)


def assess(
    df: DataFrame,
    spec: ProfileSpec,
    rules: Sequence[Constraint],
    check: str,
    workspace: Workspace,
    name: str,
    level: str = "Error",
    totals: DataFrame | None = None,
) -> Assessment:
    """What ``profile`` and ``run_checks`` give, but each column and each key is read once.

    The totals (one row) are staged, the uniqueness of each key is found once (``key_counts``), and
    both results are made from those rows. Completeness of a text column reads all of its text,
    so at scale one pass instead of two matters, and none at all if ``Watched`` has taken the
    ``totals``.
    """
    rules = applicable(df, rules)
    aggregates = profile_aggregates(df, spec)
    if totals is None:
        totals = workspace.stage(df.agg(*_totals(df, spec, rules)), f"totals_{name}")
    known: dict[tuple[str, ...], DataFrame] = {}

    def uniqueness(key: Sequence[str]) -> DataFrame:
        key = tuple(key)
        if key not in known:
            known[key] = uniqueness_row(df, key, workspace)
        return known[key]

    return Assessment(
        profile_rows(df, spec, aggregates, totals, uniqueness),
        check_rows(df, rules, check, level, totals, uniqueness),
    )
