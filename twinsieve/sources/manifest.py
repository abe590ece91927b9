"""Which files a scan reads, and how that differs from an earlier time."""

from __future__ import annotations

import re
from urllib.parse import unquote, urlsplit

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, functions as F


def file_path() -> Column:
    """The path of the file that a row comes from, without the escapes of a URL."""
    return F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B")))


def file_stamp() -> Column:
    """One number for path, size and time of the file that a row comes from."""
    time = F.unix_millis(F.col("_metadata.file_modification_time"))
    return F.xxhash64(file_path(), F.col("_metadata.file_size"), time)


def source_files(scan: DataFrame) -> DataFrame:
    """(path, size, time_ms, stamp) of the files of a scan, which are listed and not opened.

    The driver holds the names of a scan's files anyway; sizes and times are looked up by tasks.
    The names go there as Arrow, as a list of rows would start a Python worker on each core.
    """
    spark = scan.sparkSession
    names = sorted({_plain(name) for name in scan.inputFiles()})
    wanted = spark.createDataFrame(pa.table({"path": pa.array(names, pa.string())}))
    folders = {name.rpartition("/")[0] for name in names}
    if not folders:
        return wanted.selectExpr("path", "0L AS size", "0L AS time_ms", "0L AS stamp")
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    listed = reader.load([re.sub(r"([\\{}\[\]*?])", r"\\\1", f) for f in sorted(folders)])
    time = F.unix_millis("modificationTime")
    found = listed.select(
        "path",
        F.col("length").alias("size"),
        time.alias("time_ms"),
        F.xxhash64("path", "length", time).alias("stamp"),
    )
    return found.distinct().join(wanted, "path", "left_semi")


def _plain(name: str) -> str:
    """A file's URL as the reader of files writes its path: ``file:/x`` for ``file:///x``."""
    parts = urlsplit(name)
    if not parts.scheme:
        return unquote(name)
    place = f"//{parts.netloc}" if parts.netloc else ""
    return f"{parts.scheme}:{place}{unquote(parts.path)}"


def file_difference(before: DataFrame, now: DataFrame) -> DataFrame:
    """(path, change): each file of either list as added, changed, removed or same."""
    old = before.select("path", F.col("stamp").alias("__old"))
    change = (
        F.when(F.col("__old").isNull(), "added")
        .when(F.col("stamp").isNull(), "removed")
        .when(F.col("__old") != F.col("stamp"), "changed")
        .otherwise("same")
    )
    return now.select("path", "stamp").join(old, "path", "full").select(
        "path", change.alias("change")
    )


def is_file_scan(df: DataFrame) -> bool:
    """Whether each row of ``df`` comes from one file of one scan."""
    try:
        return bool(df.select("_metadata.file_path").columns)
    except AnalysisException:
        return False


def source_stamp(df: DataFrame, *columns: str) -> tuple[str, ...]:
    """What changes if the source changes: from its list of files if ``df`` is a scan of files,
    and otherwise from the values of the columns, which are read once for it."""
    if is_file_scan(df):
        rows = source_files(df).select(F.col("stamp").alias("s"))
    else:
        rows = df.select(F.xxhash64(*columns).alias("s"))
    # The exclusive or alone would not see a row that comes twice more.
    total = F.sum(F.col("s").cast("decimal(38, 0)"))
    found = rows.agg(F.count(F.lit(1)), F.bit_xor("s"), total).first()
    return tuple(map(str, found))
