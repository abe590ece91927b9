"""Data-quality constraints, evaluated together in one pass over the table."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, functions as F

from twinsieve.operators.profile import completeness, key_uniqueness


@dataclass(frozen=True)
class Constraint:
    """A measured share and what it must satisfy. Without ``measure`` the key is measured.

    ``measure`` builds the aggregate when it is used, as columns need a running session.
    """

    label: str
    columns: tuple[str, ...]
    accepts: Callable[[Column], Column]
    measure: Callable[[], Column] | None = None
    only_if_present: bool = False


def is_complete(column: str, at_least: float = 1.0, only_if_present: bool = False) -> Constraint:
    label = f"Completeness({column}) >= {at_least}"
    return Constraint(
        label,
        (column,),
        lambda v: v >= at_least,
        lambda: completeness(column),
        only_if_present,
    )


def is_unique(*key: str) -> Constraint:
    return Constraint(f"Uniqueness({','.join(key)}) = 1.0", tuple(key), lambda v: v == 1.0)


def is_non_negative(column: str) -> Constraint:
    """Every value is at least zero; nulls pass."""
    return Constraint(
        f"{column} is non-negative",
        (column,),
        lambda v: v == 1.0,
        lambda: _share(F.coalesce(F.col(column), F.lit(0)) >= 0),
    )


def is_at_most(column: str, high: float, only_if_present: bool = False) -> Constraint:
    """No value is above the bound; nulls do not pass."""
    return Constraint(
        f"{column} <= {high}",
        (column,),
        lambda v: v == 1.0,
        lambda: _share(F.col(column) <= high),
        only_if_present,
    )


def is_at_least(column: str, low: float, only_if_present: bool = False) -> Constraint:
    """No value is below the bound; nulls do not pass."""
    return Constraint(
        f"{column} >= {low}",
        (column,),
        lambda v: v == 1.0,
        lambda: _share(F.col(column) >= low),
        only_if_present,
    )


# The rules for the wide table of source files.
REPOSITORY_RULES = (
    is_complete("repo_id"),
    is_complete("path"),
    is_complete("content", 0.95),
    is_complete("owner"),
    is_complete("name"),
    is_complete("commit_sha"),
    is_unique("repo_id", "path", "commit_sha"),
    is_non_negative("size"),
    is_non_negative("stars"),
    is_non_negative("forks"),
    is_non_negative("issues"),
    is_complete("minhash_signature", 0.99, only_if_present=True),
    is_at_most("similarity_score", 1.0, only_if_present=True),
    is_at_least("similarity_score", 0.0, only_if_present=True),
)
REPOSITORY_CHECK = "Data Quality Check for Repository Code Dataset"


def run_checks(
    df: DataFrame, rules: Sequence[Constraint], check: str, level: str = "Error"
) -> DataFrame:
    """One row for each rule, with the status of the rule and of the whole check.

    A rule on a missing column fails, unless it applies only to a present one.
    """
    rules = applicable(df, rules)
    totals = df.agg(F.count(F.lit(1)), *rule_aggregates(df, rules))
    return check_rows(df, rules, check, level, totals, partial(key_uniqueness, df))


def applicable(df: DataFrame, rules: Sequence[Constraint]) -> list[Constraint]:
    """The rules without those for absent optional columns."""
    kept = [r for r in rules if not (r.only_if_present and _missing(df, r))]
    if not kept:
        raise ValueError("no rule applies")
    return kept


def rule_aggregates(df: DataFrame, rules: Sequence[Constraint]) -> list[Column]:
    """The measures of the rules on present columns, named c0, c1, ... by the place of the rule."""
    return [
        rule.measure().alias(f"c{i}")
        for i, rule in enumerate(rules)
        if rule.measure is not None and not _missing(df, rule)
    ]


def check_rows(
    df: DataFrame,
    rules: Sequence[Constraint],
    check: str,
    level: str,
    totals: DataFrame,
    uniqueness: Callable[[Sequence[str]], DataFrame],
) -> DataFrame:
    """The check results, from totals that hold ``rule_aggregates``."""
    structs, parts = [], []
    for i, rule in enumerate(rules):
        missing = _missing(df, rule)
        if missing:
            structs.append(_verdict(i, rule, F.lit(None).cast("double"), missing))
        elif rule.measure is not None:
            structs.append(_verdict(i, rule, F.col(f"c{i}")))
        else:
            verdict = F.inline(F.array(_verdict(i, rule, F.col("value"))))
            parts.append(uniqueness(rule.columns).select(verdict))
    if structs:
        parts.append(totals.select(F.inline(F.array(*structs))))
    verdicts = reduce(DataFrame.unionByName, parts)
    # One row for each rule: the array is as long as the rule list, whatever the table holds.
    verdict = F.struct("place", "constraint", "passed", "message")
    whole = verdicts.agg(
        F.every("passed").alias("all_passed"),
        F.sort_array(F.collect_list(verdict)).alias("v"),
    )
    return whole.select("all_passed", F.explode("v").alias("v")).select(
        F.lit(check).alias("check"),
        F.lit(level).alias("check_level"),
        F.when(F.col("all_passed"), "Success").otherwise(level).alias("check_status"),
        F.col("v.constraint").alias("constraint"),
        F.when(F.col("v.passed"), "Success").otherwise("Failure").alias("constraint_status"),
        F.col("v.message").alias("constraint_message"),
    )


def failed_checks(results: DataFrame) -> DataFrame:
    return results.filter("check_status != 'Success'")


def _share(holds: Column) -> Column:
    """Share of rows for which a condition is true; null for an empty table."""
    return F.try_divide(F.count_if(holds), F.count(F.lit(1)))


def _missing(df: DataFrame, rule: Constraint) -> list[str]:
    return [c for c in rule.columns if c not in df.columns]


def _verdict(
    place: int, rule: Constraint, value: Column, missing: Sequence[str] = ()
) -> Column:
    passed = F.coalesce(rule.accepts(value), F.lit(False))
    if missing:
        message = F.lit(f"Missing column: {', '.join(missing)}")
    else:
        text = F.coalesce(value.cast("string"), F.lit("none"))
        failure = F.concat(F.lit("Value: "), text, F.lit(" does not meet the constraint"))
        message = F.when(passed, F.lit("")).otherwise(failure)
    return F.struct(
        F.lit(place).alias("place"),
        F.lit(rule.label).alias("constraint"),
        passed.alias("passed"),
        message.alias("message"),
    )
