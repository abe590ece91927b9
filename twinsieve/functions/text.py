"""Tokens, word n-grams and 32-bit shingle hashes as built-in Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: every single character outside A-Z, a-z, 0-9 and _ separates two tokens. In a
# Java pattern \\W is just that class, and it is ten times as fast as the class spelled out.
SEPARATOR = r"\W"


def tokens(text: Column | str) -> Column:
    """Split at every separator; empty tokens between, before and after separators stay."""
    return F.split(text, SEPARATOR, -1)


def token_count(text: Column | str) -> Column:
    return F.size(tokens(text))


def shingles(text: Column | str, n: int = 5, min_tokens: int = 5) -> Column:
    """Distinct word n-grams, joined by one space; an empty array for a text too short."""
    return F.array_distinct(_ngrams(text, n, min_tokens))


def shingle_hashes(text: Column | str, n: int = 5, min_tokens: int = 5) -> Column:
    """Distinct 32-bit hashes of the word n-grams of a text.

    Two passes, because a lambda computes an argument anew wherever it is mentioned.
    """
    numbers = F.transform(_ngrams(text, n, min_tokens), _leading_word)
    return F.array_distinct(F.transform(numbers, _swap_bytes))


def hash32(value: Column) -> Column:
    """First four SHA-1 bytes read as a little-endian unsigned number, as BIGINT."""
    return _swap_bytes(_leading_word(value))


def _ngrams(text: Column | str, n: int, min_tokens: int) -> Column:
    """All word n-grams in order.

    The tokens are bound once, as the variable of the outer lambda, so the split is not
    repeated for each n-gram. The length guard sits inside the expression because Spark may
    move a separate filter past it.
    """
    if n < 1 or min_tokens < 0:
        raise ValueError(f"n-gram size must be positive, got n={n}, min_tokens={min_tokens}")

    def grams(words: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(words) - F.lit(n - 1), F.lit(1)))
        joined = F.transform(starts, lambda i: F.array_join(F.slice(words, i, n), " "))
        return F.when(F.size(words) >= max(n, min_tokens), joined).otherwise(
            F.array().cast("array<string>")
        )

    return F.element_at(F.transform(F.array(tokens(text)), grams), 1)


def _leading_word(value: Column) -> Column:
    """First four SHA-1 bytes as a big-endian number."""
    return F.conv(F.substring(F.sha1(value), 1, 8), 16, 10).cast("bigint")


def _swap_bytes(number: Column) -> Column:
    """The number with its four bytes in reverse."""
    return (
        F.shiftright(number, 24)
        .bitwiseOR(F.shiftright(number, 8).bitwiseAND(F.lit(0xFF00)))
        .bitwiseOR(F.shiftleft(number.bitwiseAND(F.lit(0xFF00)), 8))
        .bitwiseOR(F.shiftleft(number.bitwiseAND(F.lit(0xFF)), 24))
    )
