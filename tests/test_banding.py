import numpy as np
import pytest

import plain
from twinsieve import Banding
from twinsieve.operators.banding import bands, buckets, star_edges
from twinsieve.operators.skew import heavy_groups, with_group_min


def signed_frame(spark, signatures):
    rows = [(i, bytearray(np.array(s, dtype=">u4").tobytes())) for i, s in signatures.items()]
    return spark.createDataFrame(rows, "id long, signature binary")


@pytest.fixture(scope="module")
def signatures():
    """A third of the rows are copies of one text; others share bands by chance."""
    rng = np.random.default_rng(5)
    rows = {i: rng.integers(0, 3, 12).tolist() for i in range(400)}
    rows.update({i: rows[7] for i in range(1000, 1200)})
    return rows


@pytest.fixture(scope="module")
def signed(spark, signatures):
    return signed_frame(spark, signatures)


def test_bands_are_slices(signed, signatures):
    got = bands(signed, Banding(4, 3)).collect()
    assert len(got) == 4 * len(signatures)
    for row in got[:200]:
        part = signatures[row.id][row.band * 3 : row.band * 3 + 3]
        assert np.frombuffer(row.band_key, dtype=">u4").tolist() == part


def test_unused_values_are_in_no_band(signed):
    assert {r.band for r in bands(signed, Banding(2, 5)).collect()} == {0, 1}


@pytest.mark.parametrize("hot_rows", [10**9, 50, 1])
def test_star_edges(signed, signatures, workspace, hot_rows):
    """The same edges whether groups count as ordinary, a few as heavy, or nearly all."""
    edges = star_edges(bands(signed, Banding(4, 3)), workspace, hot_rows)
    got = [(r.src, r.dst) for r in edges.collect()]
    assert len(got) == len(set(got))
    assert set(got) == plain.star_edges(signatures, 4, 3)


def test_buckets(signed, signatures):
    groups = {}
    for i, s in signatures.items():
        for band in range(4):
            groups.setdefault((band, *s[band * 3 : band * 3 + 3]), []).append(i)
    expected = sorted((k[0], min(v), len(v)) for k, v in groups.items() if len(v) > 1)
    got = buckets(bands(signed, Banding(4, 3))).collect()
    assert sorted((r.band, r.min_id, r.n) for r in got) == expected


def test_heavy_groups_are_found(spark, workspace):
    rows = spark.createDataFrame(
        [("hot", i) for i in range(300)] + [(f"k{i % 200}", i) for i in range(600)],
        "k string, v long",
    )

    def heavy(frame, hot_rows):
        return heavy_groups(frame, ["k"], "v", "low", workspace, "heavy", hot_rows)

    assert plain.pairs(heavy(rows, 100), "k", "low") == {("hot", 0)}
    assert heavy(rows, 1000) is None
    assert heavy(rows.where("v < 0"), 1) is None


def test_a_known_bound_skips_the_search(spark, workspace):
    rows = spark.createDataFrame([("a", 2), ("a", 1), ("b", 3)], "k string, v long")
    got = with_group_min(rows, ["k"], "v", "low", workspace, hot_rows=5, at_most=3)
    assert plain.pairs(got, "k", "v", "low") == {("a", 2, 1), ("a", 1, 1), ("b", 3, 3)}
