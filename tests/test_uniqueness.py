import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from test_contraction import stages
from twinsieve.functions.packing import packed, unpacked
from twinsieve.operators import uniqueness
from twinsieve.operators.audits import KeyNotUnique, key_report, require_key
from twinsieve.operators.profile import key_uniqueness
from twinsieve.operators.uniqueness import key_counts, seen_twice, uniqueness_row


@settings(deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1) | st.integers(0, 300), max_size=50))
def test_numbers_come_back(numbers):
    ascending = np.sort(np.array(numbers, np.uint64))
    assert unpacked(packed(ascending)).tolist() == ascending.tolist()


@pytest.mark.parametrize("chunk, part", [(1 << 20, 1 << 21), (7, 10)])
def test_numbers_seen_twice(spark, monkeypatch, chunk, part):
    monkeypatch.setattr(uniqueness, "CHUNK", chunk)
    monkeypatch.setattr(uniqueness, "PART", part)
    numbers = [*range(0, 4000, 7), *range(0, 4000, 77), *([13] * 500)]
    frame = spark.createDataFrame([(n,) for n in numbers], "n long").repartition(5)
    found = sorted(r.hash for r in seen_twice(frame, 12, len(numbers)).collect())
    assert found == sorted({n for n in numbers if numbers.count(n) > 1})


ROWS = [("a", 1), ("a", 1), ("b", None), (None, 2), (None, 2), (None, None), (None, None), ("c", 3)]


@pytest.mark.parametrize("small", [0, 1 << 20])
@pytest.mark.parametrize("rows", [ROWS, ROWS[5:6], ROWS[2:3] + ROWS[7:], []])
def test_counts(spark, workspace, rows, small):
    frame = spark.createDataFrame(rows, "x string, y int")
    found = key_counts(frame, ["x", "y"], workspace, small)
    report = key_report(frame, ["x", "y"]).first()
    assert (found.rows, found.repeated_keys, found.repeated_rows, found.null_rows) == (
        report.n_rows,
        report.repeated_keys,
        report.repeated_rows,
        report.null_rows,
    )
    value = key_uniqueness(frame, ["x", "y"]).first().value
    assert found.uniqueness() == value
    assert uniqueness_row(frame, ["x", "y"], workspace, small).first().value == value


def test_a_key_that_a_third_of_all_rows_hold(spark, workspace):
    frame = spark.range(30_000).selectExpr("IF(id % 3 = 0, 'hot', concat('k', id)) AS k")
    found = key_counts(frame, ["k"], workspace, small=0)
    assert (found.repeated_keys, found.repeated_rows) == (1, 10_000)
    assert found.uniqueness() == pytest.approx(2 / 3)


def test_keys_that_are_no_keys_are_refused(spark, workspace):
    require_key(spark.range(10), ["id"], workspace)
    for rows in ([(1,), (1,)], [(1,), (None,)]):
        with pytest.raises(KeyNotUnique):
            require_key(spark.createDataFrame(rows, "id long"), ["id"], workspace)


def test_wide_keys_are_not_shuffled(spark, workspace):
    """A nearly unique key of 130 bytes: less than a tenth of its bytes pass through shuffles."""
    count = 400_000
    frame = spark.range(0, count, 1, 8).selectExpr(
        "concat(sha2(cast(least(id, 399990) AS string), 256), 'p', sha2(cast(id DIV 7 AS string), 256))"
        " AS path",
        "least(id, 399990) AS n",
    )
    frame = workspace.stage(frame, "wide")
    spark._jsc.sc().listenerBus().waitUntilEmpty()
    known = {s.stageId() for s in stages(spark)}
    found = key_counts(frame, ["path", "n"], workspace, small=0)
    spark._jsc.sc().listenerBus().waitUntilEmpty()
    written = sum(s.shuffleWriteBytes() for s in stages(spark) if s.stageId() not in known)
    assert 0 < found.repeated_rows < 20
    assert written < count * 137 / 10
