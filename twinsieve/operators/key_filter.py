"""A bit array of keys: tells rows that surely have none of the keys from those that may have one.

The array is sized by the number of keys, sixteen bits each, up to 2^31 bits or 256 MB, and reaches
the rows by broadcast, so the rows are not shuffled. With more keys than 2^27 it lets more rows
pass than need be, but never one too few.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

BITS_PER_KEY = 16
LEAST_BITS, MOST_BITS = 1 << 15, 1 << 31
# Bits of one row of the array, as ``bitmap_construct_agg`` makes them.
_ROW = 1 << 15


def bit_count(keys: int) -> int:
    """Bits for so many keys: a power of two."""
    wanted = max(keys * BITS_PER_KEY, LEAST_BITS)
    return min(1 << (wanted - 1).bit_length(), MOST_BITS)


def with_maybe(
    df: DataFrame, key: str, keys: DataFrame, count: int, name: str = "__maybe"
) -> DataFrame:
    """``df`` with a boolean: false only if the row's ``key`` is none of ``count`` staged ``keys``.

    ``keys`` has a column called ``key`` too. A null key is never one of them.
    """
    bits = F.pmod(F.xxhash64(key), F.lit(bit_count(count)))
    row, position = F.floor(bits / _ROW), bits % _ROW
    array = keys.where(F.col(key).isNotNull()).groupBy(row.alias("__row")).agg(
        F.bitmap_construct_agg(position).alias("__bits")
    )
    marked = df.withColumn("__row", row).join(F.broadcast(array), "__row", "left")
    is_set = bit_is_set("__bits", position) & F.col(key).isNotNull()
    return marked.withColumn(name, is_set).drop("__row", "__bits")


def bit_is_set(bits: str, position: Column) -> Column:
    """True if a bit is set in a column of bitmaps; false where there is no bitmap."""
    byte = F.substr(F.col(bits), F.floor(position / 8) + 1, F.lit(1))
    value = F.conv(F.hex(byte), 16, 10).cast("bigint")
    mask = F.element_at(F.array(*[F.lit(1 << i) for i in range(8)]), (position % 8 + 1).cast("int"))
    return F.coalesce(value.bitwiseAND(mask) > 0, F.lit(False))
