"""Signatures that are kept from run to run, by the files they were made from.

Each run lists the files of the source (path, size, time) and compares them with those of the last one.
Only new and changed files are read and signed. A file's signatures carry its stamp, the hash of path,
size and time; those whose stamp is no longer listed belong to files that are gone or have changed, and
are left out by a join with the list. List and signatures are published together, so a run that dies
leaves the state of the last one.
"""

from __future__ import annotations

from dataclasses import dataclass
from hashlib import sha256

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from twinsieve.operators.banding import bands, signatures, star_edges
from twinsieve.operators.components import connected_components
from twinsieve.operators.skew import HOT_ROWS
from twinsieve.plans.near_dedup import DedupParams, Duplicates
from twinsieve.sources.manifest import file_difference, file_path, file_stamp, source_files
from twinsieve.sources.publication import Published, Version
from twinsieve.sources.workspace import Workspace

_FILES, _SIGNED = "files", "signatures"
# Folders of signatures after which they are written anew as one, without stale rows.
MOST_FOLDERS = 32


class SourceChanged(RuntimeError):
    """The source was written to while it was read."""


@dataclass(frozen=True)
class FileChanges:
    """Files by what happened to them since the last run, in numbers."""

    added: int
    changed: int
    removed: int
    same: int

    def any(self) -> bool:
        return bool(self.added or self.changed or self.removed)


@dataclass(frozen=True)
class SignedSource:
    """``signatures`` (id, signature) of the source as it is now."""

    signatures: DataFrame
    changes: FileChanges
    version: int


def update_signatures(
    scan: DataFrame,
    root: str,
    key: str,
    text: str,
    workspace: Workspace,
    params: DedupParams = DedupParams(),
    most_folders: int = MOST_FOLDERS,
) -> SignedSource:
    """Bring the signatures below ``root`` up to date with the files of ``scan``.

    ``scan`` reads files, listed when it was made, and may choose and compute columns, row by
    row. Other parameters, names and types have a state of their own below ``root``; another
    expression under the same name needs another root.
    """
    schema = _schema(scan, key)
    step = sha256(repr((params, key, text, schema.json())).encode()).hexdigest()[:16]
    state = Published(workspace.spark, f"{root.rstrip('/')}/signed-{step}")
    parent = state.current()
    files = workspace.stage(source_files(scan), "source-files")
    before = state.read_version(parent, _FILES) if parent else files.limit(0)
    compared = workspace.stage(file_difference(before, files), "file-changes")
    counts = {r["change"]: r["count"] for r in compared.groupBy("change").count().collect()}
    changes = FileChanges(*[counts.get(n, 0) for n in ("added", "changed", "removed", "same")])
    version = parent
    if version is None or changes.any():
        folders = list(parent.folders[_SIGNED]) if parent else []
        if changes.added + changes.changed:
            fresh = _fresh_rows(scan, compared, changes)
            folders.append(state.write(_signed(fresh, key, text, params), _SIGNED))
            _require_listed(state, folders[-1], files)
        tables = {_SIGNED: folders, _FILES: [state.write(files, _FILES)]}
        schemas = {_SIGNED: schema, _FILES: files.schema}
        version = state.commit(parent, tables, schemas, "update")
        if len(folders) > most_folders:
            tables[_SIGNED] = [state.write(_live_rows(state, version), _SIGNED)]
            version = state.commit(version, tables, schemas, "compact")
    live = _live_rows(state, version).select("id", "signature")
    return SignedSource(live, changes, version.number)


def _schema(scan: DataFrame, key: str) -> StructType:
    return StructType(
        [
            StructField("id", scan.schema[key].dataType),
            StructField("signature", BinaryType()),
            StructField("stamp", LongType()),
        ]
    )


def _fresh_rows(scan: DataFrame, compared: DataFrame, changes: FileChanges) -> DataFrame:
    """The rows of new and changed files. Their paths are a filter on the list of files, which the
    driver holds for any scan; the other files are not opened."""
    if not changes.same:
        return scan
    wanted = compared.where("change IN ('added', 'changed')").select("path").toArrow()
    return scan.where(file_path().isin(wanted["path"].to_pylist()))


def _require_listed(state: Published, folder: str, files: DataFrame) -> None:
    """Raise if a file was another one when its rows were read than when it was listed."""
    signed = state.spark.read.format(state.fmt).load(f"{state.root}/{folder}")
    if not signed.select("stamp").join(files, "stamp", "left_anti").isEmpty():
        raise SourceChanged("files have changed between the listing and the scan; run again")


def _signed(rows: DataFrame, key: str, text: str, params: DedupParams) -> DataFrame:
    """(id, signature, stamp); the stamp goes through the signature step as part of the key."""
    tag = F.struct(F.col(key).alias("id"), file_stamp().alias("stamp"))
    signed = signatures(
        rows.select(tag.alias("tag"), F.col(text).alias("content")),
        "tag",
        "content",
        params.ngram_size,
        params.min_ngram_size,
        params.num_perm,
        params.banding().used,
        params.seed,
    )
    return signed.select("id.id", "signature", "id.stamp")


def _live_rows(state: Published, version: Version) -> DataFrame:
    listed = state.read_version(version, _FILES).select("stamp")
    return state.read_version(version, _SIGNED).join(listed, "stamp", "left_semi").select(
        "id", "signature", "stamp"
    )


def incremental_duplicates(
    scan: DataFrame,
    root: str,
    key: str,
    text: str,
    workspace: Workspace,
    params: DedupParams = DedupParams(),
    max_rounds: int = 100,
    hot_rows: int = HOT_ROWS,
) -> tuple[Duplicates, FileChanges]:
    """What ``find_duplicates`` gives, with only new and changed files read.

    Old and new rows are compared alike: links and components are made from all signatures. The
    key has to be unique, which the caller knows or has checked.
    """
    source = update_signatures(scan, root, key, text, workspace, params)
    banding = params.banding()
    signed = source.signatures
    at_most = signed.count() * banding.bands
    edges = workspace.stage(
        star_edges(bands(signed, banding), workspace, hot_rows, at_most), "edges"
    )
    found = connected_components(edges, workspace, max_rounds, hot_rows, contract=True)
    return Duplicates(banding, signed, edges, found), source.changes
