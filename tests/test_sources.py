import pytest
from pyspark.sql import functions as F

import plain
from twinsieve import Workspace, read_table, write_table
from twinsieve.operators.keys import dense_key, dense_scan_key
from twinsieve.sources import workspace as workspace_module
from twinsieve.sources.layout import clustered, range_bucket, write_layout
from twinsieve.sources import tables
from twinsieve.sources.tables import attach_row_id, fill_cluster, read_with_row_id


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json", "csv"])
def test_formats(spark, workspace, fmt):
    rows = spark.createDataFrame([(1, "a", 0.5), (2, None, 1.5)], "k long, s string, d double")
    path = workspace.path(fmt)
    write_table(rows, path, fmt)
    back = read_table(spark, path, fmt, ["k", "s"], "k long, s string, d double")
    assert plain.pairs(back, "k", "s") == {(1, "a"), (2, None)}


def test_catalog_view(spark):
    spark.range(3).createOrReplaceTempView("three")
    assert read_table(spark, "three").count() == 3


def test_files_are_limited_by_rows(spark, workspace):
    path = workspace.path("small_files")
    write_table(spark.range(100).coalesce(1), path, max_records_per_file=30)
    assert len(spark.read.parquet(path).inputFiles()) == 4


def test_scans_read_only_the_columns_asked_for(spark, workspace):
    path = workspace.path("wide")
    write_table(spark.range(10).selectExpr("id", "id a", "id b"), path)
    text = plan(read_table(spark, path, "parquet", ["a"]).where("a > 3"))
    assert "ReadSchema: struct<a:bigint>" in text and "GreaterThan(a,3)" in text


def test_staging_cuts_lineage_and_never_overwrites(spark, workspace):
    first = workspace.stage(spark.range(5), "t")
    assert workspace.stage(spark.range(7), "t").count() == 7
    assert first.count() == 5 and "Range" not in plan(first)


def test_workspace_is_removed(spark):
    space = Workspace(spark)
    path = spark._jvm.org.apache.hadoop.fs.Path(space.root)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    staged = spark._jvm.org.apache.hadoop.fs.Path(space.path("staged"))
    with space:
        table = space.stage(spark.range(1), "t")
        kept = space.stage(spark.range(2), "t")
        space.drop(table)
        assert len(system.listStatus(staged)) == 1 and kept.count() == 2
    assert not system.exists(path)


class _Session:
    def __init__(self, conf, master, folder=None):
        self.conf = conf
        self.sparkContext = self
        self.master = master
        self.getCheckpointDir = lambda: folder


def test_checkpoint_folder():
    root = workspace_module.checkpoint_root
    assert root(_Session({"spark.checkpoint.dir": "s3://x/y/"}, "yarn")) == "s3://x/y"
    assert root(_Session({}, "yarn", "hdfs://a/b")) == "hdfs://a/b"
    assert root(_Session({}, "local[2]"))
    with pytest.raises(ValueError):
        root(_Session({}, "yarn"))


def test_row_ids_are_unique_and_frozen(spark, workspace):
    rows = attach_row_id(spark.range(1000).repartition(7), workspace)
    first = plain.pairs(rows, "id", "row_id")
    assert len({r for _, r in first}) == 1000
    assert plain.pairs(rows, "id", "row_id") == first
    with pytest.raises(ValueError):
        attach_row_id(rows, workspace)


def test_file_row_ids_do_not_depend_on_the_scan(spark, workspace):
    """Same ids when the files are split otherwise, other columns are read or rows filtered."""
    path = workspace.path("files")
    rows = spark.range(5000).selectExpr("id", "sha2(cast(id as string), 512) AS text")
    rows.repartition(3).write.option("parquet.block.size", "20000").parquet(path)
    whole = read_with_row_id(spark, path, workspace)
    assert "SortMergeJoin" not in plan(whole) and "Exchange hashpartitioning" not in plan(whole)
    first = plain.pairs(whole, "id", "row_id")
    assert len({r for _, r in first}) == 5000
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "30000")
    try:
        again = read_with_row_id(spark, path, workspace, columns=["id"], name="again")
        assert again.columns == ["id", "row_id"]
        assert plain.pairs(again, "id", "row_id") == first
        some = plain.pairs(again.where("id >= 4000"), "id", "row_id")
        assert some == {pair for pair in first if pair[0] >= 4000}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    with pytest.raises(ValueError):
        read_with_row_id(spark, path, workspace, column="id")


def test_row_ids_by_key_are_those_of_one_sorted_file(spark, workspace):
    """However many files hold the rows, and in whatever order."""
    one, many = workspace.path("one"), workspace.path("many")
    rows = spark.range(3000).selectExpr("id * 3 AS id", "id % 7 AS n")
    rows.coalesce(1).write.parquet(one)
    rows.repartition(5, "id").write.parquet(many)
    expected = plain.pairs(read_with_row_id(spark, one, workspace), "id", "row_id")
    got = read_with_row_id(spark, many, workspace, columns=["n", "id"], order_by=["id"])
    assert got.columns == ["n", "id", "row_id"]
    assert plain.pairs(got, "id", "row_id") == expected
    got = read_with_row_id(spark, many, workspace, columns=["n"], order_by=["id"])
    assert got.columns == ["n", "row_id"]
    assert {r for _, r in plain.pairs(got, "n", "row_id")} == {r for _, r in expected}


def test_small_scans_fill_the_cluster_and_large_ones_stay(spark, workspace):
    small = workspace.stage(spark.range(100).coalesce(1), "small")
    assert "Exchange" in plan(fill_cluster(small, "id"))
    assert "Exchange" not in plan(fill_cluster(small, "id", split_bytes=10))


def test_range_buckets(spark):
    values = [-1, 0, 9999, 10000, 99999, 100000, 10**9, None]
    rows = spark.createDataFrame([(v,) for v in values], "v long")
    got = [r[0] for r in rows.select(range_bucket("v", 0, 100000, 10000)).collect()]
    assert got == [0, 1, 1, 2, 10, 11, 11, None]
    with pytest.raises(ValueError):
        range_bucket("v", 0, 10, 3)


def test_layout_prunes_partitions(spark, workspace):
    rows = spark.range(1000).selectExpr(
        "id", "cast(if(id % 3 = 0, 5, id) as long) AS owner", "nullif(id * 100, 700) AS stars"
    )
    path = workspace.path("layout")
    write_layout(rows, path, range_bucket("stars", 0, 100000, 10000), ["owner"], ["id"])
    back = spark.read.parquet(path)
    assert plain.pairs(back, "id", "owner", "stars") == plain.pairs(rows, "id", "owner", "stars")
    one = back.where("bucket = 3")
    assert "PartitionFilters: [isnotnull(bucket" in plan(one)
    assert sorted(r.id for r in one.collect()) == list(range(200, 300))
    assert back.where("bucket IS NULL").count() == 1


def test_clustering_splits_a_frequent_value(spark):
    rows = spark.range(9000).selectExpr("id", "if(id % 3 = 0, 'big', concat('o', id)) AS owner")
    sizes = (
        clustered(rows, ["owner"], ["id"])
        .withColumn("p", F.spark_partition_id())
        .groupBy("p")
        .agg(F.count_if(F.col("owner") == "big").alias("big"), F.count(F.lit(1)).alias("n"))
        .collect()
    )
    assert sum(r.n for r in sizes) == 9000 and sum(r.big for r in sizes) == 3000
    if len(sizes) > 1:
        assert max(r.big for r in sizes) < 3000


def test_dense_keys_follow_the_order(spark, workspace):
    rows = spark.range(5000).selectExpr("id * 7919 % 5000 AS pos", "id").repartition(6)
    keyed = dense_key(rows, ["pos"], "k", workspace, "keyed")
    assert keyed.columns == ["k", "pos", "id"]
    assert sorted(plain.pairs(keyed, "pos", "k")) == [(i, i + 1) for i in range(5000)]


def test_dense_keys_in_scan_order_take_no_shuffle(spark, workspace):
    source = workspace.stage(spark.range(0, 500, 1, 4), "source")
    keyed = dense_key(source, [], "k", workspace, "keyed")
    assert sorted(r.k for r in keyed.collect()) == list(range(1, 501))
    empty = dense_key(source.where("id < 0"), [], "k", workspace, "none")
    assert empty.count() == 0
    with pytest.raises(ValueError):
        dense_key(keyed, [], "k", workspace, "again")


def test_scan_keys_take_neither_a_copy_nor_a_shuffle(spark, workspace, tmp_path):
    path = str(tmp_path / "files")
    for i, count in enumerate((5, 1, 30)):
        rows = spark.range(count).selectExpr(f"id + {100 * i} AS n", "repeat('x', 50) AS text")
        rows.coalesce(1).write.mode("append").parquet(path)
    scan = spark.read.parquet(path).withColumn("twice", F.col("n") * 2)
    keyed = dense_scan_key(scan, "key", workspace, "counts")
    rows = keyed.collect()
    assert keyed.columns == ["key", "n", "text", "twice"]
    assert sorted(r.key for r in rows) == list(range(1, 37))
    # In a file the keys follow the rows.
    for i in range(3):
        own = sorted((r.key, r.n) for r in rows if r.n // 100 == i)
        assert [n for _, n in own] == sorted(n for _, n in own)
    plan = keyed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("text#") and "hashpartitioning" not in plan and "rangepartitioning" not in plan
    staged = [t.columns for t in workspace._staged]
    assert all("text" not in columns for columns in staged)
    assert dense_scan_key(scan.where("n > 3"), "key", workspace, "counts") is None
    assert dense_scan_key(spark.range(3), "key", workspace, "counts") is None
    with pytest.raises(ValueError):
        dense_scan_key(scan, "n", workspace, "counts")
