"""Quality rules: a threshold table compiled into one projection of built-in functions.

Words are runs of characters other than space and U+0009 to U+000D. All counts are of the whole
text; a null text counts as an empty one, so it has no words and fails the base rule. Texts of any
length take time in proportion to their words (times a logarithm, for one sort). Repeated rows are
judged each for itself, and columns other than the text are passed through or ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

_SPACE = r"[\x20\x09-\x0D]+"
_SPACE_CHARS = " \t\n\x0b\x0c\r"
_NOT_SYMBOL = r"[^#*$%&|<>]+"

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = tuple(
    """a an and are as at be by for from he in is it not of on or that the they this to was were
    which with you auf aus das dem den der des die ein eine er für im ist mit nicht sich sie und
    von zu au avec ce dans de du elle en est et il la le les ne par pas pour qui que sur un une
    con del el es lo los las no para por se su y""".split()
)

N_WORDS, WORD_CHARS, N_SYMBOLS = "n_words", "word_chars", "n_symbols"
N_LINES, N_DUP_LINES = "n_lines", "n_dup_lines"
N_STOP, N_REPEAT = "n_stop_words", "n_repeat_words"
MEASURES = (N_WORDS, WORD_CHARS, N_SYMBOLS, N_LINES, N_DUP_LINES, N_STOP, N_REPEAT)


@dataclass(frozen=True)
class Rule:
    """``low <= 100 * part / whole <= high`` over two measures, in whole percent.

    A rule with an empty whole holds. Comparisons are of integers, so they are exact.
    """

    name: str
    part: str
    whole: str
    low: int | None = None
    high: int | None = None

    def holds(self) -> Column:
        part, whole = 100 * F.col(self.part), F.col(self.whole)
        checks = F.lit(True)
        if self.low is not None:
            checks &= part >= self.low * whole
        if self.high is not None:
            checks &= part <= self.high * whole
        return checks


@dataclass(frozen=True)
class RuleTable:
    """Thresholds of a verdict. ``min_words`` and ``max_repeat`` are the base rule."""

    min_words: int = 50
    max_repeat: int = 50
    rules: Sequence[Rule] = (
        Rule("word_length", WORD_CHARS, N_WORDS, low=200, high=1200),
        Rule("symbols", N_SYMBOLS, N_WORDS, high=10),
        Rule("stop_words", N_STOP, N_WORDS, low=5),
        Rule("repeated_lines", N_DUP_LINES, N_LINES, high=40),
    )


def measures(
    df: DataFrame, text: str = "text", stop_words: Sequence[str] = STOP_WORDS
) -> DataFrame:
    """``df`` with the measures as LONG columns; columns of those names are replaced.

    Arrays that a lambda looks into are columns of their own, so they are computed once per row.
    """
    plain = F.coalesce(F.col(text), F.lit(""))
    trimmed = F.btrim(plain, F.lit(_SPACE_CHARS))
    words, lines, windows = F.col("__words"), F.col("__lines"), F.col("__windows")
    rows = df.withColumns(
        {
            "__words": F.when(trimmed != "", F.split(trimmed, _SPACE)).otherwise(
                F.array().cast("array<string>")
            ),
            "__lines": F.filter(
                F.split(plain, "\n"), lambda line: F.btrim(line, F.lit(_SPACE_CHARS)) != ""
            ),
            WORD_CHARS: F.length(F.regexp_replace(plain, _SPACE, "")).cast("bigint"),
            N_SYMBOLS: F.length(F.regexp_replace(plain, _NOT_SYMBOL, "")).cast("bigint"),
        }
    )
    # Windows of three words by hash, sorted, each with its place.
    rows = rows.withColumns(
        {
            N_WORDS: F.size(words).cast("bigint"),
            N_LINES: F.size(lines).cast("bigint"),
            N_DUP_LINES: (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint"),
            N_STOP: F.size(F.filter(words, lambda w: _is_stop(w, stop_words))).cast("bigint"),
            "__windows": F.array_sort(
                F.transform(
                    F.slice(words, 1, F.greatest(F.size(words) - 2, F.lit(0))),
                    lambda w, i: F.struct(
                        F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)).alias("h"),
                        i.alias("i"),
                    ),
                )
            ),
        }
    )
    rows = rows.withColumn(
        "__places",
        F.array_sort(
            F.transform(F.filter(windows, lambda x, j: _has_twin(windows, x, j)), lambda x: x["i"])
        ),
    )
    return rows.withColumn(N_REPEAT, _covered(F.col("__places"))).drop(
        "__words", "__lines", "__windows", "__places"
    )


def _is_stop(word: Column, stop_words: Sequence[str]) -> Column:
    return F.btrim(F.lower(word), F.lit(".,;:!?\"'()")).isin(list(stop_words))


def _has_twin(windows: Column, window: Column, place: Column) -> Column:
    after = F.get(windows, place + 1)["h"].eqNullSafe(window["h"])
    return after | F.get(windows, place - 1)["h"].eqNullSafe(window["h"])


def _covered(places: Column) -> Column:
    """Words in windows of three that start at the given ascending places."""
    start = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("bigint").alias("n"))
    return F.aggregate(
        places,
        start,
        lambda done, p: F.struct(
            p.alias("last"), (done["n"] + F.least(F.lit(3), p - done["last"])).alias("n")
        ),
        lambda done: done["n"],
    )


def base_failed(table: RuleTable) -> Column:
    """Too few words, or too many of them in repeated three-word windows."""
    too_short = F.col(N_WORDS) < table.min_words
    return too_short | (100 * F.col(N_REPEAT) > table.max_repeat * F.col(N_WORDS))


def verdicts(df: DataFrame, text: str = "text", table: RuleTable = RuleTable()) -> DataFrame:
    """``df`` with the measures, ``base_failed``, a flag for each rule and ``kept``."""
    flags = {f"{rule.name}_ok": rule.holds() for rule in table.rules}
    rows = measures(df, text).withColumn("base_failed", base_failed(table)).withColumns(flags)
    kept = ~F.col("base_failed")
    for name in flags:
        kept &= F.col(name)
    return rows.withColumn("kept", kept)


def keep_good(df: DataFrame, text: str = "text", table: RuleTable = RuleTable()) -> DataFrame:
    """The rows whose text passes, with the columns of ``df`` as they are.

    The filter also looks at a row number. Without it the optimizer would move the filter below the
    projections and write their arrays out inside the lambdas, to be computed again for each word.
    """
    names = [f"__in{i}" for i in range(len(df.columns))]
    inner = df.toDF(*names)
    judged = verdicts(inner, names[df.columns.index(text)], table)
    numbered = judged.select(*names, "kept", F.monotonically_increasing_id().alias("__row"))
    return numbered.where("kept AND __row >= 0").select(*names).toDF(*df.columns)
