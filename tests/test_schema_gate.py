from pyspark.sql.types import StructType

from twinsieve.operators.gates import schema_fields, structural_schema_gate
from twinsieve.operators.profile import ProfileSpec, profile


def changes(spark, before, after):
    frames = [spark.createDataFrame([], StructType.fromDDL(s)) for s in (before, after)]
    gate = structural_schema_gate(*[profile(f, ProfileSpec()) for f in frames])
    return {r.path: (r.change, r.passed) for r in gate.collect()}


def test_paths():
    schema = StructType.fromDDL(
        "a int NOT NULL, b struct<c: array<struct<d: string>>, e: map<string, array<int>>>"
    )
    assert schema_fields(schema) == {
        "a": ("int", False),
        "b": ("struct", True),
        "b.c": ("array", True),
        "b.c[]": ("struct", True),
        "b.c[].d": ("string", True),
        "b.e": ("map", True),
        "b.e.key": ("string", False),
        "b.e.value": ("array", True),
        "b.e.value[]": ("int", True),
    }


def test_a_field_inside_a_struct_is_named_by_its_path(spark):
    found = changes(spark, "a int, b struct<c: int>", "a int, b struct<c: int, d: string>")
    assert found == {
        "a": ("same", True),
        "b": ("same", True),
        "b.c": ("same", True),
        "b.d": ("added", False),
    }


def test_all_kinds_of_change(spark):
    found = changes(
        spark,
        "a int NOT NULL, b int, c array<int>, m map<string, int>, gone struct<x: int>",
        "a int, b string, c array<bigint>, m array<string>",
    )
    failed = {path: change for path, (change, passed) in found.items() if not passed}
    assert failed == {
        "a": "nullability",
        "b": "retyped",
        "c[]": "retyped",
        "gone": "dropped",
        "gone.x": "dropped",
        "m": "retyped",
        "m.key": "dropped",
        "m.value": "dropped",
        "m[]": "added",
    }
    assert found["c"] == ("same", True)


def test_a_profile_without_a_schema_fails_all(spark):
    frame = spark.range(1)
    metrics = profile(frame, ProfileSpec())
    gate = structural_schema_gate(metrics, metrics.where("name = 'Size'"))
    assert [(r.path, r.change, r.passed) for r in gate.collect()] == [("id", "dropped", False)]
