import os

import pytest

import plain
from twinsieve import DedupParams, Workspace, find_duplicates
from twinsieve.plans import near_dedup
from twinsieve.plans.incremental import FileChanges, incremental_duplicates, update_signatures
from twinsieve.sources.manifest import (
    file_difference,
    file_path,
    file_stamp,
    source_files,
    source_stamp,
)

PARAMS = DedupParams(num_perm=64)


@pytest.fixture(scope="module")
def texts():
    found = plain.random_texts(60, 5, vocabulary=1500)
    return found + found[:10] + found[:5] + [None, "too short"]


@pytest.fixture()
def folder(tmp_path):
    return tmp_path / "source"


def add(spark, folder, texts, numbers, name):
    """One file of the texts with the given numbers."""
    rows = spark.createDataFrame([(i, texts[i]) for i in numbers], "key long, content string")
    rows.coalesce(1).write.parquet(str(folder / name))
    return next((folder / name).glob("*.parquet"))


def scan(spark, folder):
    return spark.read.option("recursiveFileLookup", "true").parquet(str(folder))


def signed(source):
    return {r.id: bytes(r.signature) for r in source.signatures.collect()}


def whole(spark, folder, workspace):
    found = near_dedup.stage_signatures(scan(spark, folder), "key", "content", PARAMS, workspace)
    return {r.id: bytes(r.signature) for r in found.collect()}


def make_unreadable(file):
    """The same path, size and time, but no rows to be had from it."""
    about = file.stat()
    (file.parent / f".{file.name}.crc").unlink(missing_ok=True)
    file.write_bytes(b"\0" * about.st_size)
    os.utime(file, ns=(about.st_atime_ns, about.st_mtime_ns))


def test_the_file_list_takes_no_python_worker(spark, folder, texts):
    add(spark, folder, texts, range(5), "a")
    listed = source_files(scan(spark, folder))
    assert listed.count() == 1
    assert "ExistingRDD" not in listed._jdf.queryExecution().executedPlan().toString()


def test_only_new_and_changed_files_are_read(spark, folder, texts, workspace, tmp_path):
    root = str(tmp_path / "state")

    def update():
        return update_signatures(scan(spark, folder), root, "key", "content", workspace, PARAMS)

    first = add(spark, folder, texts, range(20), "a")
    second = add(spark, folder, texts, range(20, 40), "b")
    found = update()
    assert found.changes == FileChanges(2, 0, 0, 0) and found.version == 1
    before = whole(spark, folder, workspace)
    assert signed(found) == before

    add(spark, folder, texts, range(40, 77), "c")
    data = first.read_bytes()
    make_unreadable(first)
    make_unreadable(second)
    found = spark.read.schema("key long, content string").option("recursiveFileLookup", "true")
    listed = found.parquet(str(folder))
    found = update_signatures(listed, root, "key", "content", workspace, PARAMS)
    assert found.changes == FileChanges(1, 0, 0, 2)
    # The unreadable files' signatures are still there.
    now = signed(found)
    assert {k: v for k, v in now.items() if k < 40} == before and max(now) > 60

    again = update_signatures(listed, root, "key", "content", workspace, PARAMS)
    assert again.changes == FileChanges(0, 0, 0, 3) and again.version == found.version

    second.unlink()
    first.unlink()
    first.write_bytes(data)
    found = update()
    assert found.changes == FileChanges(0, 1, 1, 1)
    assert signed(found) == whole(spark, folder, workspace)


def test_added_rows_are_compared_with_old_ones(spark, folder, texts, workspace, tmp_path):
    root = str(tmp_path / "state")
    add(spark, folder, texts, range(60), "a")
    args = root, "key", "content", workspace, PARAMS
    found, _ = incremental_duplicates(scan(spark, folder), *args)
    assert found.components.count() == 0
    add(spark, folder, texts, range(60, 77), "b")
    found, changes = incremental_duplicates(scan(spark, folder), *args)
    assert changes == FileChanges(1, 0, 0, 1)
    plainly = find_duplicates(scan(spark, folder), "key", "content", workspace, PARAMS)
    rows = sorted(map(tuple, found.components.collect()))
    assert rows == sorted(map(tuple, plainly.components.collect())) and len(rows) > 5


def test_many_updates_are_put_together(spark, folder, texts, workspace, tmp_path):
    for i in range(5):
        add(spark, folder, texts, range(10 * i, 10 * i + 10), f"f{i}")
        found = update_signatures(
            scan(spark, folder), str(tmp_path), "key", "content", workspace, PARAMS, most_folders=2
        )
    assert signed(found) == whole(spark, folder, workspace)
    assert found.version > 5


def test_other_parameters_have_another_state(spark, folder, texts, workspace, tmp_path):
    add(spark, folder, texts, range(20), "a")
    sizes = []
    for n in (64, 128):
        found = update_signatures(
            scan(spark, folder), str(tmp_path), "key", "content", workspace, DedupParams(num_perm=n)
        )
        assert found.changes.added == 1
        sizes.append(len(next(iter(signed(found).values()))))
    assert sizes[0] < sizes[1]


def test_an_update_that_dies_leaves_the_last_state(spark, folder, texts, workspace, tmp_path):
    root = str(tmp_path / "state")
    add(spark, folder, texts, range(20), "a")
    args = root, "key", "content", workspace, PARAMS
    update_signatures(scan(spark, folder), *args)
    file = add(spark, folder, texts, range(20, 40), "b")
    data = file.read_bytes()
    listed = spark.read.schema("key long, content string").option("recursiveFileLookup", "true")
    make_unreadable(file)
    with pytest.raises(Exception):
        update_signatures(listed.parquet(str(folder)), *args)
    file.write_bytes(data)
    found = update_signatures(scan(spark, folder), *args)
    assert found.changes == FileChanges(1, 0, 0, 1)
    assert signed(found) == whole(spark, folder, workspace)


def test_difference(spark):
    shape = "path string, stamp long"
    before = spark.createDataFrame([("a", 1), ("b", 1), ("c", 1)], shape)
    now = spark.createDataFrame([("a", 1), ("b", 2), ("d", 1)], shape)
    rows = dict(map(tuple, file_difference(before, now).collect()))
    assert rows == {"a": "same", "b": "changed", "c": "removed", "d": "added"}


def test_files_are_listed_by_the_paths_of_their_rows(spark, folder, texts):
    """Also paths with characters that a URL or a pattern gives another meaning."""
    for name in ("with space", "50%25+é", "{a}[b]", "plain/deeper"):
        file = add(spark, folder, texts, range(3), name)
    stamps = scan(spark, folder).select(file_path().alias("path"), file_stamp().alias("stamp"))
    expected = sorted(map(tuple, stamps.distinct().collect()))
    table = spark.read.schema("key long").option("recursiveFileLookup", "true")
    listed = table.parquet(str(folder))
    make_unreadable(file)
    assert sorted(map(tuple, source_files(listed).select("path", "stamp").collect())) == expected
    assert len(expected) == 4


def test_source_stamps(spark, folder, texts):
    add(spark, folder, texts, range(3), "a")
    files = [source_stamp(scan(spark, folder), "key", "content") for _ in range(2)]
    assert files[0] == files[1]
    add(spark, folder, texts, range(3, 5), "b")
    assert source_stamp(scan(spark, folder), "key", "content") != files[0]
    rows = spark.range(4).selectExpr("id % 2 AS key", "'t' AS content")
    assert source_stamp(rows, "key", "content") == source_stamp(rows, "key", "content")
    assert source_stamp(rows.limit(2), "key", "content") != source_stamp(rows, "key", "content")


def test_a_named_run_compares_rows_that_came_later(spark, folder, texts, tmp_path):
    """Under the same name, a changed source is not mistaken for the old one."""
    add(spark, folder, texts, range(60), "a")
    sizes = []
    for name in ("b", "c"):
        space = Workspace(spark, str(tmp_path / "work"), run="nightly")
        found = find_duplicates(scan(spark, folder), "key", "content", space, PARAMS)
        sizes.append(found.components.count())
        add(spark, folder, texts, range(60, 70) if name == "b" else range(70, 75), name)
    assert sizes[0] == 0 < sizes[1]
