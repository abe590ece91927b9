import pytest
from pyspark.sql import functions as F

from twinsieve.operators.deletion import deletion_bitmaps, without_places
from twinsieve.sources.tables import numbered_files, read_with_row_id


@pytest.fixture(scope="module")
def source(spark, tmp_path_factory):
    """Five files of 100 to 70 000 rows."""
    path = str(tmp_path_factory.mktemp("deletion") / "table")
    for i, count in enumerate((100, 20_000, 70_000, 500, 40_000)):
        rows = spark.range(count).selectExpr(
            f"id + {i * 100_000} AS n", "repeat('x', 20) AS text", f"{i} AS file"
        )
        rows.coalesce(1).write.mode("append").parquet(path)
    return path


def kept(spark, source, removed, workspace, **options):
    left = without_places(spark, source, removed, workspace, column="row_id", **options)
    return left.agg(F.count("*"), F.sum("n"), F.count_distinct("n"))


@pytest.mark.parametrize("most_bytes", [1 << 28, 4096 * 2])
def test_rows_are_split_exactly(spark, source, workspace, most_bytes):
    rows = read_with_row_id(spark, source, workspace)
    for chosen in ("n % 3 = 0", "n = 270000 - 1", "file = 2", "true", "false"):
        gone = workspace.stage(rows.where(chosen).select("row_id"), "gone")
        found = kept(spark, source, gone, workspace, most_bytes=most_bytes).first()
        plain = spark.read.parquet(source).where(f"NOT ({chosen})")
        assert found == plain.agg(F.count("*"), F.sum("n"), F.count_distinct("n")).first()


def test_bitmaps_count_their_rows(spark, source, workspace):
    rows = read_with_row_id(spark, source, workspace).where("file = 2 AND n % 2 = 0")
    found = deletion_bitmaps(rows, numbered_files(spark, source, workspace), "row_id").collect()
    assert len(found) == 3 and sum(r.n for r in found) == 35_000
    assert len({r.path_hash for r in found}) == 1


def test_text_is_read_once_and_not_shuffled(spark, source, workspace):
    rows = read_with_row_id(spark, source, workspace)
    gone = workspace.stage(rows.where("n % 7 = 0").select("row_id"), "gone")
    left = without_places(spark, source, gone, workspace, ["text"], column="row_id")
    plan = left._jdf.queryExecution().executedPlan().toString()
    assert plan.count("text#") and plan.count("FileScan parquet [text#") == 1
    assert "hashpartitioning" not in plan and "SortMergeJoin" not in plan
    assert "file#" not in plan


def test_repeated_and_null_ids_change_nothing(spark, source, workspace):
    rows = read_with_row_id(spark, source, workspace).where("n = 5").select("row_id")
    gone = workspace.stage(rows.union(rows).union(rows.selectExpr("null")), "gone")
    assert kept(spark, source, gone, workspace).first()[0] == 130_599
