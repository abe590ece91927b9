"""Near-duplicate removal, data quality and modelling of large tables on Spark."""

from twinsieve.functions.lsh import Banding, choose_banding
from twinsieve.operators.components import connected_components
from twinsieve.plans.near_dedup import (
    DedupParams,
    Duplicates,
    JobResult,
    find_duplicates,
    near_dedup,
    run_job,
)
from twinsieve.sources.tables import read_table, read_with_row_id, write_table
from twinsieve.sources.workspace import Workspace

__all__ = [
    "Banding",
    "DedupParams",
    "Duplicates",
    "JobResult",
    "Workspace",
    "choose_banding",
    "connected_components",
    "find_duplicates",
    "near_dedup",
    "read_table",
    "read_with_row_id",
    "run_job",
    "write_table",
]
