import pytest
from pyspark.sql import functions as F

from twinsieve.operators.profile import ProfileSpec, profile
from twinsieve.operators.profile_state import merged, profile_of, profile_state
from twinsieve.sources.publication import Published

SPEC = ProfileSpec(("k", "s", "absent"), ("n", "d"), ("k", "s"))


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(3000).selectExpr(
        "IF(id % 11 = 0, null, id % 700) AS k",
        "IF(id % 11 = 0 OR id % 3 = 0, null, concat('s', id % 5)) AS s",
        "id - 7 AS n",
        "IF(id < 2000, id / 8.0D, null) AS d",
    )


def values(metrics):
    found = {(r.entity, r.instance, r.name): r.value for r in metrics.collect()}
    return {k: v if k[2] == "schema" else round(float(v), 9) for k, v in found.items()}


@pytest.mark.parametrize("ranges", [1, 16])
def test_one_state_is_the_profile(rows, ranges):
    state = profile_state(rows, SPEC, ranges)
    assert values(profile_of(state, SPEC)) == values(profile(rows, SPEC))


def test_parts_add_up(spark, rows, workspace):
    """Parts of a table, some of them empty, kept one after the other and merged in two ways."""
    parts = [rows.where(f"n % 4 = {i}") for i in range(3)] + [rows.where("n % 4 NOT IN (0, 1, 2)")]
    parts.append(rows.limit(0))
    place = Published(spark, workspace.path("states"))
    for part in parts:
        place.append(profile_state(part, SPEC, 8))
    expected = values(profile(rows, SPEC))
    assert values(profile_of(merged(place.read()), SPEC)) == expected
    first = merged(place.read(2))
    for part in parts[2:]:
        first = merged(first.unionByName(profile_state(part, SPEC, 8)))
    assert values(profile_of(first, SPEC)) == expected


def test_repeats_across_parts_are_seen(spark):
    part = spark.range(100).selectExpr("id AS k", "'x' AS s", "id AS n", "1.0D AS d")
    other = part.where("k < 30")
    both = merged(profile_state(part, SPEC, 4).unionByName(profile_state(other, SPEC, 4)))
    key = ("Multicolumn", "k,s", "Uniqueness")
    assert values(profile_of(both, SPEC))[key] == round(70 / 130, 9)


def test_empty_tables(rows):
    state = merged(profile_state(rows.limit(0), SPEC, 4))
    assert values(profile_of(state, SPEC)) == values(profile(rows.limit(0), SPEC))


def test_other_schemas_have_no_common_one(rows):
    changed = rows.withColumn("n", F.col("n").cast("double"))
    both = merged(profile_state(rows, SPEC, 4).unionByName(profile_state(changed, SPEC, 4)))
    assert ("Dataset", "*", "schema") not in values(profile_of(both, SPEC))


def test_ranges_are_a_power_of_two(rows):
    with pytest.raises(ValueError):
        profile_state(rows, SPEC, 12)
