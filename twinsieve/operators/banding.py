"""From signatures to candidate edges: bands, buckets and stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from twinsieve.functions.lsh import Banding
from twinsieve.functions.minhash import SEED, signature_rows
from twinsieve.operators.skew import HOT_ROWS, with_group_min
from twinsieve.sources.tables import fill_cluster
from twinsieve.sources.workspace import Workspace


def signatures(
    df: DataFrame,
    key: str,
    text: str,
    ngram_size: int = 5,
    min_ngram_size: int = 5,
    num_perm: int = 256,
    used: int | None = None,
    seed: int = SEED,
) -> DataFrame:
    """(id, signature) of every row whose text is long enough for an n-gram.

    Reads two columns of the source and shuffles nothing unless the source is tiny.
    """
    rows = fill_cluster(df.select(F.col(key).alias("id"), F.col(text).alias("text")), "id")
    key_type = rows.schema["id"].dataType.simpleString()
    function = signature_rows(ngram_size, min_ngram_size, num_perm, used, seed)
    return rows.mapInArrow(function, f"id {key_type}, signature binary")


def bands(signed: DataFrame, banding: Banding) -> DataFrame:
    """(id, band, band_key): one row for each band, its values as packed bytes."""
    width = 4 * banding.rows
    slices = [F.substring("signature", i * width + 1, width) for i in range(banding.bands)]
    return signed.select("id", F.posexplode(F.array(*slices)).alias("band", "band_key"))


def buckets(banded: DataFrame) -> DataFrame:
    """(band, band_key, min_id, n): the buckets that hold more than one row."""
    return (
        banded.groupBy("band", "band_key")
        .agg(F.min("id").alias("min_id"), F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1)
    )


def star_edges(
    banded: DataFrame, workspace: Workspace, hot_rows: int = HOT_ROWS, at_most: int | None = None
) -> DataFrame:
    """Distinct (src, dst): each member of a bucket but the smallest, with the smallest.

    The band key leads the grouping, since its first bytes tell nearly all rows apart and so
    settle the sort; the band has few values.
    """
    keys = ["band_key", "band"]
    linked = with_group_min(
        banded, keys, "id", "min_id", workspace, "heavy_buckets", hot_rows, at_most
    )
    return (
        linked.where(F.col("id") > F.col("min_id"))
        .select(F.col("id").alias("src"), F.col("min_id").alias("dst"))
        .distinct()
    )
