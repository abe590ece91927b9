import json

import pandas as pd
import pytest
from pyspark.sql import functions as F

import plain
from twinsieve.plans.snowflake import (
    WIDE_COLUMNS,
    file_facts,
    language_dimension,
    load_snowflake,
    repository_dimension,
    wide_view,
)

LANGUAGES = ["Kotlin", "Java", None, "C"]


@pytest.fixture(scope="module")
def flat_rows():
    """Repository 0 holds a third of the files; one repository has no id."""
    rows = []
    for i in range(300):
        repo = 0 if i % 3 == 0 else i % 40
        rows.append(
            dict(
                pos=i,
                repo_id=None if repo == 13 else repo,
                main_language=LANGUAGES[(i * 7 + repo) % 4],
                owner=f"o{i}",
                name=f"n{i}",
                is_fork=i % 2 == 0,
                forks=i,
                stars=i * 100,
                issues=i / 2,
                license=None if i % 5 == 0 else "MIT",
                path=f"p{i}",
                content=f"text {i}",
                size=i * 10,
                commit_sha=f"s{i}",
                languages_distribution={"Kotlin": i, "Java": 1},
            )
        )
    return rows


@pytest.fixture(scope="module")
def flat(spark, flat_rows):
    schema = (
        "pos long, repo_id long, main_language string, owner string, name string, "
        "is_fork boolean, forks long, stars long, issues double, license string, path string, "
        "content string, size long, commit_sha string, languages_distribution map<string, int>"
    )
    return spark.createDataFrame([tuple(r.values()) for r in flat_rows], schema).repartition(5)


def test_languages_are_numbered_by_first_appearance(flat, flat_rows, workspace):
    seen = pd.Series([r["main_language"] for r in flat_rows]).fillna("N/A").unique()
    got = plain.pairs(language_dimension(flat, "pos", workspace), "language_id", "language_name")
    assert got == {(i + 1, name) for i, name in enumerate(seen)}


def test_repositories_keep_the_first_row(flat, flat_rows, workspace):
    languages = language_dimension(flat, "pos", workspace)
    numbers = {r.language_name: r.language_id for r in languages.collect()}
    got = {r.repo_id: r for r in repository_dimension(flat, "pos", languages).collect()}
    first = {}
    for row in flat_rows:
        first.setdefault(row["repo_id"], row)
    assert set(got) == set(first)
    for repo, row in first.items():
        assert got[repo].language_id == numbers[row["main_language"] or "N/A"]
        for column in ("owner", "name", "is_fork", "forks", "stars", "issues", "license"):
            assert got[repo][column] == row[column]


def test_files_are_numbered_by_position(flat, flat_rows, workspace):
    got = {r.file_id: r for r in file_facts(flat, workspace, "pos").collect()}
    assert sorted(got) == list(range(1, len(flat_rows) + 1))
    for row in flat_rows:
        file = got[row["pos"] + 1]
        assert (file.path, file.content, file.size) == (row["path"], row["content"], row["size"])
        assert json.loads(file.languages_distribution) == row["languages_distribution"]


def test_files_in_scan_order(flat, workspace):
    ids = [r.file_id for r in file_facts(flat, workspace).select("file_id").collect()]
    assert sorted(ids) == list(range(1, 301))


def test_the_view_restores_the_flat_rows(spark, flat, flat_rows, workspace):
    languages = language_dimension(flat, "pos", workspace)
    repositories = repository_dimension(flat, "pos", languages)
    files = file_facts(flat, workspace, "pos")
    wide = wide_view(files, repositories, languages, "wide")
    assert tuple(wide.columns) == WIDE_COLUMNS
    rows = {r.path: r for r in spark.table("wide").collect()}
    assert len(rows) == len(flat_rows)
    first = {}
    for row in flat_rows:
        first.setdefault(row["repo_id"], row)
    for row in flat_rows:
        got, repo = rows[row["path"]], first[row["repo_id"]]
        assert got.content == row["content"] and got.repo_id == row["repo_id"]
        if row["repo_id"] is None:  # a null key joins nothing
            assert got.owner is None and got.main_language is None
        else:
            assert got.owner == repo["owner"]
            assert got.main_language == (repo["main_language"] or "N/A")


def test_unmatched_repositories_and_languages(spark, flat, workspace):
    languages = language_dimension(flat, "pos", workspace).where("language_id > 1")
    repositories = repository_dimension(flat, "pos", languages).where("repo_id > 5")
    wide = wide_view(file_facts(flat, workspace, "pos"), repositories, languages)
    assert wide.count() == 300
    assert wide.where(F.col("repo_id").isNull()).count() > 0
    assert wide.where("repo_id IS NOT NULL AND main_language IS NULL").count() > 0


def test_a_hot_repository_is_split(spark, workspace):
    """With dimensions too large to broadcast, AQE cuts the partition of a frequent key."""
    conf = {
        "spark.sql.shuffle.partitions": "32",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
    }
    old = {name: spark.conf.get(name, None) for name in conf}
    files = workspace.stage(
        spark.range(60_000, numPartitions=16).selectExpr(
            "if(id % 3 = 0, 0, id % 5000) AS repo_id",
            "concat('p', id) AS path",
            "concat(sha1(cast(id as string)), sha1(cast(-id as string))) AS content",
            "id AS size",
            "'s' AS commit_sha",
            "'{}' AS languages_distribution",
        ),
        "many_files",
    )
    repositories = workspace.stage(
        spark.range(5000).selectExpr(
            "id AS repo_id",
            "id % 3 AS language_id",
            "'o' AS owner",
            "'n' AS name",
            "false AS is_fork",
            "id AS forks",
            "id AS stars",
            "0.0D AS issues",
            "'MIT' AS license",
        ),
        "many_repositories",
    )
    languages = spark.createDataFrame(
        [(0, "a"), (1, "b"), (2, "c")], "language_id long, language_name string"
    )
    try:
        for name, value in conf.items():
            spark.conf.set(name, value)
        wide = wide_view(files, repositories, languages)
        assert len(wide.collect()) == 60_000
        assert "skew=true" in wide._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in old.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_loaded_tables_have_their_layouts(spark, flat, workspace):
    """Filters on a bucket read only its folder, and repositories without a position come last."""
    folder = workspace.path("loaded")
    languages, repositories, files, wide = load_snowflake(flat, folder, workspace, "pos", "loaded")
    assert files.count() == flat.count() == spark.table("loaded").count()
    assert repositories.count() == flat.select("repo_id").distinct().count()
    assert languages.columns == ["language_id", "language_name"]
    plan = files.where("bucket = 1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan
    again = load_snowflake(flat, folder, workspace, "pos")
    assert again[2].count() == flat.count()


def test_missing_distribution_and_positions(spark, workspace):
    rows = [(1, None, "a", None), (1, 7, "b", {"x": 1}), (2, None, "c", {"x": 2}), (None, 3, "d", None)]
    frame = spark.createDataFrame(
        rows, "repo_id long, pos long, main_language string, languages_distribution map<string, int>"
    )
    facts = file_facts(frame, workspace, columns=["pos"])
    texts = sorted(r.languages_distribution for r in facts.collect())
    assert texts == ["null", "null", '{"x":1}', '{"x":2}']
    languages = language_dimension(frame, "pos", workspace)
    names = {r.language_id: r.language_name for r in languages.collect()}
    dimension = repository_dimension(frame, "pos", languages, columns=["pos"])
    found = {(r.repo_id, r.pos, names[r.language_id]) for r in dimension.collect()}
    assert found == {(1, 7, "b"), (2, None, "c"), (None, 3, "d")}


def test_repositories_without_positions_are_repeatable(spark, workspace):
    rows = [("r", None, "L", f"o{i}") for i in (3, 1, 2)] + [("s", 4, "L", "x"), ("s", 2, "L", "y")]
    flat = spark.createDataFrame(rows, "repo_id string, at int, main_language string, owner string")
    languages = spark.createDataFrame([(1, "L")], "language_id long, language_name string")
    for parts in (1, 4):
        found = repository_dimension(flat.repartition(parts), "at", languages, columns=["owner"])
        assert sorted((r.repo_id, r.owner) for r in found.collect()) == [("r", "o1"), ("s", "y")]


def test_the_snowflake_job_copies_no_text(spark, workspace, tmp_path):
    """Ids of a whole scan are 1..n, and no staged table holds the contents."""
    path = str(tmp_path / "flat")
    names = "path owner commit_sha name license main_language".split()
    text = [f"concat('{n}', id % 5) AS {n}" for n in names]
    numbers = [f"id % 7 AS {n}" for n in ("repo_id", "forks", "stars")]
    flat = spark.range(50).selectExpr(
        *text,
        *numbers,
        "id AS position",
        "id % 2 = 0 AS is_fork",
        "1.0D AS issues",
        "id * 9000 AS size",
        "concat('content', id) AS content",
        "map('a', 1L) AS languages_distribution",
    )
    flat.repartition(3).write.parquet(path)
    *_, files, _ = load_snowflake(
        spark.read.parquet(path), str(tmp_path / "out"), workspace, "position"
    )
    assert sorted(r.file_id for r in files.select("file_id").collect()) == list(range(1, 51))
    assert all("content" not in t.columns for t in workspace._staged)
