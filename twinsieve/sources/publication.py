"""Tables that are replaced in one step: versioned folders, manifests, and readers with a snapshot.

    root/data/<id>/<table>/...   what one write made, never changed afterwards
    root/versions/<number>       a manifest: the folders of each table of that version

A write goes to a folder of its own, which no reader knows. It becomes the current version by one new
manifest, made under a name that only one writer can take. So a reader sees the old version or the new
one, a write that dies half-way changes nothing, and of two writers that started from the same version
the second one is told. A version may hold several tables, which then change together. Appending
lists the earlier folders once more and copies nothing.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from twinsieve.sources.folders import Folders
from twinsieve.sources.tables import MAX_RECORDS_PER_FILE, write_table

TABLE = "table"
_DIGITS = 12


class PublishConflict(RuntimeError):
    """Another writer has published a version since the one that this write started from."""


class NothingPublished(LookupError):
    """No such version."""


@dataclass(frozen=True)
class Version:
    """What a manifest says. ``folders`` are below the root; ``schemas`` are JSON, by table."""

    number: int
    parent: int | None
    operation: str
    time_ms: int
    fmt: str
    folders: dict[str, list[str]]
    schemas: dict[str, str]
    notes: dict[str, str] = field(default_factory=dict)

    def text(self) -> str:
        return json.dumps(self.__dict__, sort_keys=True)


class Published:
    """The versions below a root folder."""

    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet"):
        self.spark = spark
        self.root = root.rstrip("/")
        self.fmt = fmt
        self._folders = Folders(spark)

    # Reading

    def numbers(self) -> list[int]:
        names = self._folders.names(f"{self.root}/versions")
        return sorted(int(name) for name in names if name.isdecimal())

    def version(self, number: int | None = None) -> Version:
        """The current version, or the one with a number."""
        if number is None:
            numbers = self.numbers()
            if not numbers:
                raise NothingPublished(f"{self.root} has no version")
            number = numbers[-1]
        path = self._manifest(number)
        if not self._folders.exists(path):
            raise NothingPublished(f"{self.root} has no version {number}")
        return Version(**json.loads(self._folders.read(path)))

    def current(self) -> Version | None:
        return self.version() if self.numbers() else None

    def read(self, number: int | None = None, table: str = TABLE) -> DataFrame:
        """A table as of one version, which stays the same whatever is published meanwhile."""
        return self.read_version(self.version(number), table)

    def read_version(self, version: Version, table: str = TABLE) -> DataFrame:
        schema = StructType.fromJson(json.loads(version.schemas[table]))
        paths = [f"{self.root}/{folder}" for folder in version.folders[table]]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.format(version.fmt).schema(schema).load(paths)

    def history(self) -> DataFrame:
        """(version, parent, operation, time_ms, table, n_folders) of all versions."""
        rows = [
            (v.number, v.parent, v.operation, v.time_ms, table, len(folders))
            for v in map(self.version, self.numbers())
            for table, folders in v.folders.items()
        ]
        return self.spark.createDataFrame(
            rows,
            "version bigint, parent bigint, operation string, time_ms bigint, table string, "
            "n_folders int",
        )

    # Writing

    def write(self, df: DataFrame, table: str = TABLE, records: int = MAX_RECORDS_PER_FILE) -> str:
        """Write a folder that belongs to no version yet, and return its name below the root."""
        folder = f"data/{uuid.uuid4().hex}/{table}"
        path = f"{self.root}/{folder}"
        write_table(df, path, self.fmt, mode="errorifexists", max_records_per_file=records)
        return folder

    def commit(
        self,
        parent: Version | None,
        folders: Mapping[str, Sequence[str]],
        schemas: Mapping[str, StructType],
        operation: str = "replace",
        notes: Mapping[str, str] | None = None,
    ) -> Version:
        """Make the folders the version that follows ``parent``; the one step that readers see."""
        number = parent.number + 1 if parent else 1
        found = Version(
            number,
            parent.number if parent else None,
            operation,
            int(time.time() * 1000),
            self.fmt,
            {table: list(names) for table, names in folders.items()},
            {table: schema.json() for table, schema in schemas.items()},
            dict(notes or {}),
        )
        if not self._folders.write_new(self._manifest(number), found.text()):
            raise PublishConflict(f"version {number} of {self.root} is another writer's")
        return found

    def replace(self, df: DataFrame, table: str = TABLE) -> Version:
        """Publish ``df`` in place of the table; the other tables stay."""
        parent = self.current()
        folder = self.write(df, table)
        return self._follow(parent, table, [folder], df.schema, "replace")

    def append(self, df: DataFrame, table: str = TABLE, tries: int = 10) -> Version:
        """Publish the table with more rows. Appending to what another writer has published in
        the meantime is no conflict, so it is tried again on that."""
        folder = self.write(df, table)
        for left in range(tries, 0, -1):
            parent = self.current()
            before = parent.folders.get(table, []) if parent else []
            if before and not _same_columns(parent.schemas[table], df.schema):
                raise ValueError(f"{self.root}: {table} has other columns than the rows to append")
            try:
                return self._follow(parent, table, [*before, folder], df.schema, "append")
            except PublishConflict:
                if left == 1:
                    raise
        raise AssertionError("not reached")

    def _follow(
        self,
        parent: Version | None,
        table: str,
        folders: Sequence[str],
        schema: StructType,
        operation: str,
    ) -> Version:
        others = {t: f for t, f in parent.folders.items() if t != table} if parent else {}
        schemas = {t: StructType.fromJson(json.loads(parent.schemas[t])) for t in others}
        return self.commit(
            parent, {**others, table: folders}, {**schemas, table: schema}, operation
        )

    def expire(self, keep: int = 1, grace_ms: int = 86_400_000) -> list[str]:
        """Drop all but the last ``keep`` versions, and folders that no kept version names.

        A folder changed less than ``grace_ms`` ago may belong to a write that still runs, and
        stays, unless a dropped version has named it. Returns the folders that went.
        """
        if keep < 1:
            raise ValueError("at least one version stays")
        numbers = self.numbers()
        versions = {n: self.version(n) for n in numbers}
        kept = {_write_of(f) for n in numbers[-keep:] for f in _all(versions[n])}
        dropped = {_write_of(f) for n in numbers[:-keep] for f in _all(versions[n])}
        now = time.time() * 1000
        gone = []
        for name, changed in self._folders.names(f"{self.root}/data").items():
            if name not in kept and (name in dropped or now - changed > grace_ms):
                gone.append(name)
        # The manifests go first, so no version is left that names a missing folder.
        for number in numbers[:-keep]:
            self._folders.delete(self._manifest(number))
        for name in gone:
            self._folders.delete(f"{self.root}/data/{name}")
        return sorted(gone)

    def _manifest(self, number: int) -> str:
        return f"{self.root}/versions/{number:0{_DIGITS}d}"


def _all(version: Version) -> list[str]:
    return [folder for folders in version.folders.values() for folder in folders]


def _write_of(folder: str) -> str:
    return folder.split("/")[1]


def _same_columns(json_schema: str, schema: StructType) -> bool:
    known = StructType.fromJson(json.loads(json_schema))
    return [(f.name, f.dataType) for f in known] == [(f.name, f.dataType) for f in schema]
