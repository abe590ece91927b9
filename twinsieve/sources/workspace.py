"""Staged tables: intermediate results written to shared storage and read back.

A staged table cuts the lineage, so a lost executor costs a re-read and not a recomputation,
and non-deterministic values such as generated row ids are frozen.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from functools import lru_cache
from hashlib import sha256

from pyspark.sql import DataFrame, SparkSession

_PLAIN_FILES = ("parquet", "orc", "avro")


def checkpoint_root(spark: SparkSession) -> str:
    """The folder the session names for checkpoints; a temporary one in local mode only."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    folder = folder or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        return _local_root()
    raise ValueError("set spark.checkpoint.dir to a folder that all executors share")


@lru_cache(maxsize=1)
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="twinsieve-")


class Workspace:
    """A run's own folder for staged tables, removed by ``close`` or at the end of a ``with``.

    Frames made from staged tables are lazy, so write or collect them before that.

    A ``run`` has a name. Steps that were finished under it are read again and not redone, see
    ``stage_once``, and an error at the end of a ``with`` leaves the folder for the next try.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str | None = None,
        fmt: str = "parquet",
        run: str | None = None,
    ):
        self.spark = spark
        self.fmt = fmt
        self.run = run
        name = f"run-{run}" if run else uuid.uuid4().hex
        self.root = f"{root or checkpoint_root(spark)}/twinsieve-{name}"
        self._staged: dict[DataFrame, str] = {}

    def stage(self, df: DataFrame, label: str) -> DataFrame:
        """Write ``df`` and return the written table.

        The folder is new each time, whatever the label, so no earlier frame changes.
        """
        return self._written(df, self.path(f"staged/{uuid.uuid4().hex[:12]}-{label}"))

    def stage_once(
        self, label: str, fingerprint: object, make: Callable[[], DataFrame]
    ) -> DataFrame:
        """The staged table of a named run's step, made only if it was not finished before.

        ``fingerprint`` holds all that the step depends on, a stamp of the source included, and
        has a ``repr`` that says so; another one gives another table. Without a run the step is
        always made.
        """
        if self.run is None:
            return self.stage(make(), label)
        digest = sha256(repr(fingerprint).encode()).hexdigest()[:16]
        path = self.path(f"once/{label}-{digest}")
        if self._exists(f"{path}/_SUCCESS"):
            return self.spark.read.format(self.fmt).load(path)
        self._delete(path)
        return self._written(make(), path)

    def _written(self, df: DataFrame, path: str) -> DataFrame:
        df.write.format(self.fmt).save(path)
        reader = self.spark.read.format(self.fmt)
        # Table formats know their schema; plain files would be opened once more to infer it.
        table = (reader.schema(df.schema) if self.fmt in _PLAIN_FILES else reader).load(path)
        self._staged[table] = path
        return table

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def drop(self, table: DataFrame) -> None:
        """Delete a staged table that no frame in use reads any more."""
        self._delete(self._staged.pop(table))

    def close(self) -> None:
        self._staged.clear()
        self._delete(self.root)

    def _delete(self, path: str) -> None:
        files, target = self._files(path)
        files.delete(target, True)

    def _exists(self, path: str) -> bool:
        files, target = self._files(path)
        return files.exists(target)

    def _files(self, path: str) -> tuple[object, object]:
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self.spark._jsc.hadoopConfiguration()), target

    def __enter__(self) -> Workspace:
        return self

    def __exit__(self, *exc: object) -> None:
        if self.run is None or exc[0] is None:
            self.close()
