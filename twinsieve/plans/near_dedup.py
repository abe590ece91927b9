"""The near-duplicate job: signatures, bands, stars, components, removal, profiles and gates."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from twinsieve.functions.lsh import Banding, choose_banding
from twinsieve.functions.minhash import SEED
from twinsieve.operators.assessment import Watched, assess
from twinsieve.operators.audits import require_key
from twinsieve.operators.banding import bands, signatures, star_edges
from twinsieve.operators.checks import REPOSITORY_CHECK, REPOSITORY_RULES, Constraint
from twinsieve.operators.components import connected_components
from twinsieve.operators.deletion import without_places
from twinsieve.operators.gates import enforce, row_count_gate, schema_gate
from twinsieve.operators.profile import REPOSITORY_PROFILE, ProfileSpec
from twinsieve.operators.removal import keep_one
from twinsieve.operators.skew import HOT_ROWS
from twinsieve.sources.manifest import source_stamp
from twinsieve.sources.publication import TABLE, Published
from twinsieve.sources.tables import attach_row_id, read_with_row_id, write_table
from twinsieve.sources.workspace import Workspace

_ROW_ID = "__row_id"


@dataclass(frozen=True)
class DedupParams:
    """Parameters of the search; ``bands`` and ``rows`` are derived unless both are given."""

    threshold: float = 0.7
    ngram_size: int = 5
    min_ngram_size: int = 5
    num_perm: int = 256
    bands: int | None = None
    rows: int | None = None
    seed: int = SEED

    def banding(self) -> Banding:
        return choose_banding(self.threshold, self.num_perm, self.bands, self.rows)


@dataclass(frozen=True)
class Duplicates:
    """Staged results of the search."""

    banding: Banding
    signatures: DataFrame
    edges: DataFrame
    components: DataFrame


@dataclass(frozen=True)
class JobResult:
    """Written tables of a whole job."""

    banding: Banding
    kept: DataFrame
    components: DataFrame
    profile_before: DataFrame
    profile_after: DataFrame
    checks_before: DataFrame
    checks_after: DataFrame
    row_count: DataFrame
    schema: DataFrame


def stage_signatures(
    df: DataFrame,
    key: str,
    text: str,
    params: DedupParams,
    workspace: Workspace,
    source: object = None,
) -> DataFrame:
    """Staged (id, signature), the one step that reads the text and the costliest to redo."""
    def signed() -> DataFrame:
        return signatures(
            df,
            key,
            text,
            params.ngram_size,
            params.min_ngram_size,
            params.num_perm,
            params.banding().used,
            params.seed,
        )

    return workspace.stage_once("signatures", (params, key, text, source), signed)


def find_duplicates(
    df: DataFrame,
    key: str,
    text: str,
    workspace: Workspace,
    params: DedupParams = DedupParams(),
    max_rounds: int = 100,
    hot_rows: int = HOT_ROWS,
    proven_unique: bool = False,
) -> Duplicates:
    """Link rows that share a band and resolve the links into components.

    ``key`` must be unique and not null, or removal would take rows of their own along with
    a duplicate. This is checked, over the key alone, and ``KeyNotUnique`` raised, unless the
    caller says that it is proven. Rows with a null or too short text get no signature and are
    in no component.

    Steps that a named run has finished are taken from it if the source is still the same, by its
    list of files, or by its values if it is not made of files (``source_stamp``).
    """
    if not proven_unique:
        require_key(df, [key], workspace)
    banding = params.banding()
    source = source_stamp(df, key, text) if workspace.run else None
    signed = stage_signatures(df, key, text, params, workspace, source)
    step = (params, key, text, source)

    def linked() -> DataFrame:
        at_most = signed.count() * banding.bands
        return star_edges(bands(signed, banding), workspace, hot_rows, at_most)

    edges = workspace.stage_once("edges", step, linked)

    def resolved() -> DataFrame:
        return connected_components(edges, workspace, max_rounds, hot_rows, contract=True)

    named = workspace.run is not None
    components = workspace.stage_once("components", step, resolved) if named else resolved()
    return Duplicates(banding, signed, edges, components)


def near_dedup(
    df: DataFrame,
    key: str,
    text: str,
    workspace: Workspace,
    params: DedupParams = DedupParams(),
    proven_unique: bool = False,
) -> DataFrame:
    """The rows of ``df`` without near-duplicates: the smallest key of each component stays."""
    found = find_duplicates(df, key, text, workspace, params, proven_unique=proven_unique)
    return keep_one(df, found.components, key)


def run_job(
    df: DataFrame,
    output: str,
    workspace: Workspace,
    text: str = "content",
    key: str | None = None,
    params: DedupParams = DedupParams(),
    profile_spec: ProfileSpec = REPOSITORY_PROFILE,
    rules: Sequence[Constraint] = REPOSITORY_RULES,
    check: str = REPOSITORY_CHECK,
    strict: bool = False,
    reports: str | None = None,
    keep_key: bool = True,
    publish: bool = False,
    proven_unique: bool = False,
    keep: Callable[[DataFrame], DataFrame] | None = None,
) -> JobResult:
    """Profile and check a table, write it without near-duplicates, profile and check again.

    Without a ``key`` each row gets a generated id, which is not part of the output; a key that
    only serves the job is left out with ``keep_key`` false. A given key is checked before any
    work, see ``find_duplicates``, unless it is ``proven_unique``. ``keep`` may be another way to
    get the rows left from the components than ``keep_one``. The output is read back with the schema it was written with,
    so the schema gate compares the two tables. Reports go to ``reports`` (default:
    folder "reports" of the workspace, which a second run replaces). The gates run after the
    output and all reports are written and raise ``GateFailed``; failed checks raise only if
    ``strict``.

    With ``publish`` the output is a versioned table, see ``Published``: the new version becomes
    the current one after all gates have passed, and until then, and if the job dies or a gate
    fails, readers have the old one. Otherwise the files below ``output`` are replaced in place.
    """
    columns = [c for c in df.columns if keep_key or c != key]
    generated = key is None
    if generated:
        key = _ROW_ID
        df = attach_row_id(df, workspace, key)
    elif not proven_unique:
        require_key(df, [key], workspace)
    source = df.select(*columns)
    # The signatures read the whole table anyway, unless a named run has them already.
    watched = Watched(df, profile_spec, rules, source) if workspace.run is None else None
    searched = watched.frame if watched else df
    found = find_duplicates(searched, key, text, workspace, params, proven_unique=True)
    report = _Reports(workspace, reports or workspace.path("reports"))
    totals = watched.totals() if watched else None
    before = assess(source, profile_spec, rules, check, workspace, "before", totals=totals)
    profile_before = report.write(before.profile, "profile_before")
    checks_before = report.write(before.checks, "checks_before")
    components = report.write(found.components, "components")

    left = keep(components) if keep else keep_one(df, components, key)
    written = Watched(left.select(*columns), profile_spec, rules)
    place = Published(workspace.spark, output) if publish else None
    if place:
        parent = place.current()
        folder = place.write(written.frame)
        kept = workspace.spark.read.parquet(f"{place.root}/{folder}")
    else:
        write_table(written.frame, output)
        kept = workspace.spark.read.parquet(output)

    # A table with other columns than were meant to be written is read for its own totals.
    totals = written.totals() if kept.columns == columns else None
    after = assess(kept, profile_spec, rules, check, workspace, "after", totals=totals)
    profile_after = report.write(after.profile, "profile_after")
    checks_after = report.write(after.checks, "checks_after")
    row_count = report.write(row_count_gate(profile_before, profile_after), "row_count_gate")
    schema = report.write(schema_gate(profile_before, profile_after), "schema_gate")
    if strict:
        for name, results in (("before", checks_before), ("after", checks_after)):
            enforce(results.selectExpr("*", "constraint_status = 'Success' AS passed"), name)
    enforce(row_count, "row count")
    enforce(schema, "schema")
    if place:
        place.commit(parent, {TABLE: [folder]}, {TABLE: kept.schema})
    return JobResult(
        found.banding,
        kept,
        components,
        profile_before,
        profile_after,
        checks_before,
        checks_after,
        row_count,
        schema,
    )


def near_dedup_files(
    spark: SparkSession,
    source: str,
    text: str,
    workspace: Workspace,
    params: DedupParams = DedupParams(),
) -> DataFrame:
    """The rows of Parquet files without near-duplicates, of each component the first row stays.

    Rows are known by their place in the files: no key is needed and none is checked, nothing is
    copied, and removal is one scan with bitmaps, see ``without_places``.
    """
    rows = read_with_row_id(spark, source, workspace, _ROW_ID, [text])
    found = find_duplicates(rows, _ROW_ID, text, workspace, params, proven_unique=True)
    return without_places(spark, source, found.components, workspace)


def run_job_on_files(
    spark: SparkSession, source: str, output: str, workspace: Workspace, **options: Any
) -> JobResult:
    """The whole job over Parquet files without a key; ``options`` are those of ``run_job``."""
    return run_job(
        read_with_row_id(spark, source, workspace, _ROW_ID),
        output,
        workspace,
        key=_ROW_ID,
        keep_key=False,
        proven_unique=True,
        keep=lambda gone: without_places(spark, source, gone, workspace),
        **options,
    )


class _Reports:
    """Writes report tables under one folder."""

    def __init__(self, workspace: Workspace, folder: str):
        self.spark = workspace.spark
        self.folder = folder.rstrip("/")

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)
