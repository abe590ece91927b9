import pytest

from twinsieve.operators import key_filter
from twinsieve.operators.removal import keep_one, removed


@pytest.mark.parametrize("most", [1 << 31, 1 << 5], ids=["sized", "full"])
@pytest.mark.parametrize("kind", ["long", "string"])
def test_rows_are_split_exactly(spark, monkeypatch, most, kind):
    monkeypatch.setattr(key_filter, "MOST_BITS", most)
    docs = spark.range(2000).selectExpr(f"cast(id as {kind}) AS key", "id AS n", "'t' AS text")
    parts = spark.range(0, 2000, 3).selectExpr(f"cast(id as {kind}) AS id", "0 AS component")
    kept, gone = keep_one(docs, parts, "key"), removed(docs, parts, "key")
    assert kept.schema.names == gone.schema.names == docs.schema.names
    assert sorted(r.n for r in kept.collect()) == [i for i in range(2000) if i % 3]
    assert sorted(r.n for r in gone.collect()) == list(range(0, 2000, 3))


def test_nothing_to_remove(spark):
    docs = spark.range(10).withColumnRenamed("id", "key")
    none = spark.createDataFrame([], "id long, component long")
    assert keep_one(docs, none, "key").count() == 10
    assert removed(docs, none, "key").count() == 0


def test_null_keys_are_kept(spark):
    docs = spark.createDataFrame([(None, "a"), (1, "b"), (2, "c")], "key long, t string")
    parts = spark.createDataFrame([(2, 1)], "id long, component long")
    assert sorted(r.t for r in keep_one(docs, parts, "key").collect()) == ["a", "b"]


def test_bit_array_follows_the_number_of_keys(spark):
    assert key_filter.bit_count(0) == key_filter.LEAST_BITS
    assert key_filter.bit_count(1_000_000) == 1 << 24
    assert key_filter.bit_count(10**12) == key_filter.MOST_BITS
    docs = spark.range(100_000).withColumnRenamed("id", "key")
    keys = docs.where("key % 10 = 0")
    marked = key_filter.with_maybe(docs, "key", keys, keys.count())
    passing = marked.where("__maybe")
    assert passing.where("key % 10 = 0").count() == 10_000
    assert passing.count() < 17_000


def test_kept_text_is_not_shuffled(spark):
    """Only rows whose bit is set reach an exchange."""
    docs = spark.range(1000).selectExpr("id AS key", "repeat('x', 100) AS text")
    parts = spark.range(0, 1000, 10).selectExpr("id", "0 AS component")
    plan = keep_one(docs, parts, "key")._jdf.queryExecution().executedPlan().toString()
    assert "Union" in plan
    sure = plan[plan.index("Union") :].split("ShuffledHashJoin")[0]
    assert "BroadcastHashJoin" in sure and "Exchange hashpartitioning(key" not in sure
