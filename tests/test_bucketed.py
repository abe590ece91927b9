"""Bucketed tables: the rows of the plain view, no exchange, and no bucket that one repository fills."""

import uuid

import pytest
from pyspark.sql import functions as F

from twinsieve.plans.bucketed import (
    PART,
    BucketedTables,
    bucket_count,
    bucketed_view,
    repository_parts,
    with_every_part,
    with_part,
    write_bucketed,
)
from twinsieve.plans.snowflake import wide_view

FILES = (
    "file_id long, repo_id long, path string, content string, size long, commit_sha string, "
    "languages_distribution string"
)
REPOSITORIES = (
    "repo_id long, language_id long, owner string, name string, is_fork boolean, forks long, "
    "stars long, issues double, license string"
)


@pytest.fixture(scope="module")
def tables(spark):
    """Repository 7 holds a third of the files, a tenth have none, and repository 3 is unknown."""
    files = []
    for i in range(3000):
        repo = 7 if i % 3 == 0 else None if i % 10 == 1 else i % 50
        files.append((i, repo, f"p{i}", f"text {i}", i, f"s{i % 5}", "null"))
    repositories = [
        (r, r % 4 or None, f"o{r}", f"n{r}", r % 2 == 0, r, r, r / 2, None)
        for r in range(60)
        if r != 3
    ] + [(None, 1, "o", "n", True, 1, 1, 1.0, "MIT")]
    languages = [(1, "A"), (2, "B"), (3, "N/A")]
    return (
        spark.createDataFrame(files, FILES),
        spark.createDataFrame(repositories, REPOSITORIES),
        spark.createDataFrame(languages, "language_id long, language_name string"),
    )


@pytest.fixture()
def names(spark):
    tag = uuid.uuid4().hex
    found = BucketedTables(f"files_{tag}", f"repositories_{tag}", f"languages_{tag}")
    yield found
    found.drop(spark)


def rows(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def test_view_has_the_rows_of_the_plain_one(spark, tables, names, workspace):
    write_bucketed(*tables, names, workspace, 8, workspace.path("bucketed"))
    plain = rows(wide_view(*tables))
    assert len(plain) == 3000
    assert rows(bucketed_view(spark, names)) == plain
    assert rows(bucketed_view(spark, names, broadcast_rows=0)) == plain
    # Written again under the same names: replaced, not added.
    write_bucketed(*tables, names, workspace, 8, workspace.path("bucketed"))
    assert rows(bucketed_view(spark, names)) == plain


def test_neither_files_nor_repositories_are_exchanged(spark, tables, names, workspace):
    write_bucketed(*tables, names, workspace, 8, workspace.path("bucketed"))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        view = bucketed_view(spark, names)
        view.collect()
        plan = view._jdf.queryExecution().executedPlan().toString()
        apart = wide_view(*tables)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "Exchange hashpartitioning" in apart
    assert "Exchange hashpartitioning" not in plan and "Exchange rangepartitioning" not in plan
    assert plan.count("BroadcastExchange") == plan.count("BroadcastHashJoin") > 0
    assert "SelectedBucketsCount: 8 out of 8" in view._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def test_no_bucket_is_filled_by_one_repository(tables, workspace):
    files, repositories, _ = tables
    buckets = 8
    parts = repository_parts(files, buckets, workspace)
    found = {r[0]: r[1] for r in parts.collect()}
    known = files.where("repo_id IS NOT NULL").count()
    share = -(-known // buckets)
    assert set(found) == {7} and len(found) < buckets
    dealt = with_part(files, parts, buckets)
    assert dealt.columns == [*files.columns, PART] and dealt.count() == files.count()
    most = dealt.groupBy("repo_id", PART).count().agg(F.max("count")).first()[0]
    assert most <= 1.3 * share
    every = with_every_part(repositories, parts)
    repeated = every.groupBy("repo_id").count().where("count > 1").collect()
    assert [(r["repo_id"], r["count"]) for r in repeated] == [(7, found[7])]
    assert every.count() < repositories.count() + 2 * buckets


def test_empty_tables(spark, tables, names, workspace):
    empty = [t.limit(0) for t in tables]
    write_bucketed(*empty, names, workspace, 4, workspace.path("bucketed"))
    assert bucketed_view(spark, names).collect() == []


def test_bucket_count():
    assert [bucket_count(n, 100) for n in (0, 100, 101, 900)] == [1, 1, 2, 16]
    assert bucket_count(1 << 60) == 1 << 16
