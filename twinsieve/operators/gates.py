"""Gates between the profiles of a table before and after a job."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

from twinsieve.operators.profile import metric


class GateFailed(RuntimeError):
    """A gate did not pass."""


def row_count_gate(
    before: DataFrame, after: DataFrame, low: float = 0.0, high: float = 30.0
) -> DataFrame:
    """One row: the counts, the per cent removed and whether it lies strictly inside the bounds.

    ``passed`` is false if a profile has no size, or the first one is empty.
    """
    sizes = _side(before, "Size", "before").unionByName(_side(after, "Size", "after"))
    count = F.col("value").cast("double").cast("bigint")
    counts = sizes.agg(
        F.max(F.when(F.col("side") == "before", count)).alias("rows_before"),
        F.max(F.when(F.col("side") == "after", count)).alias("rows_after"),
    )
    gone = F.try_divide(F.col("rows_before") - F.col("rows_after"), F.col("rows_before")) * 100
    inside = (F.col("pct_removed") > low) & (F.col("pct_removed") < high)
    return counts.withColumn("pct_removed", gone).withColumn(
        "passed", F.coalesce(inside, F.lit(False))
    )


def schema_gate(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row for each column of either table: its types, the change and whether it passes.

    Reads the schema rows of the two profiles, so the data's own schemas are compared. A
    profile without a schema row makes all columns of the other fail.
    """
    shape = "struct<fields: array<struct<name: string, type: string>>>"
    sides = _side(before, "schema", "before").unionByName(_side(after, "schema", "after"))
    fields = sides.select("side", F.explode(F.from_json("value", shape)["fields"]).alias("f"))
    types = fields.groupBy(F.col("f.name").alias("column")).agg(
        F.max(F.when(F.col("side") == "before", F.col("f.type"))).alias("type_before"),
        F.max(F.when(F.col("side") == "after", F.col("f.type"))).alias("type_after"),
    )
    change = (
        F.when(F.col("type_before").isNull(), "added")
        .when(F.col("type_after").isNull(), "dropped")
        .when(F.col("type_before") != F.col("type_after"), "retyped")
        .otherwise("same")
    )
    return types.withColumn("change", change).withColumn("passed", F.col("change") == "same")


def schema_fields(schema: StructType) -> dict[str, tuple[str, bool]]:
    """The type and nullability of each column, field, element, key and value, by its path."""
    found: dict[str, tuple[str, bool]] = {}

    def walk(path: str, kind: DataType, nullable: bool) -> None:
        inner: list[tuple[str, DataType, bool]] = []
        name = kind.simpleString()
        if isinstance(kind, StructType):
            name = "struct"
            inner = [(f"{path}.{f.name}", f.dataType, f.nullable) for f in kind.fields]
        elif isinstance(kind, ArrayType):
            name = "array"
            inner = [(f"{path}[]", kind.elementType, kind.containsNull)]
        elif isinstance(kind, MapType):
            name = "map"
            inner = [
                (f"{path}.key", kind.keyType, False),
                (f"{path}.value", kind.valueType, kind.valueContainsNull),
            ]
        found[path] = name, nullable
        for part in inner:
            walk(*part)

    for field in schema.fields:
        walk(field.name, field.dataType, field.nullable)
    return found


def structural_schema_gate(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row for each path of either table's schema, at any depth, that says what has changed.

    ``change`` is same, added, dropped, retyped or nullability. What is below a path that was
    added, dropped or retyped has rows of its own. Reads the schema rows of two profiles, one
    value each.
    """
    sides = []
    for metrics in (before, after):
        found = metric(metrics, "schema").first()
        schema = StructType.fromJson(json.loads(found["value"])) if found else StructType([])
        sides.append(schema_fields(schema))
    rows = []
    for path in sorted(sides[0].keys() | sides[1].keys()):
        old, new = (side.get(path, (None, None)) for side in sides)
        if old[0] is None or new[0] is None:
            change = "added" if old[0] is None else "dropped"
        elif old[0] != new[0]:
            change = "retyped"
        else:
            change = "same" if old == new else "nullability"
        rows.append((path, *old, *new, change, change == "same"))
    return before.sparkSession.createDataFrame(
        rows,
        "path string, type_before string, nullable_before boolean, type_after string, "
        "nullable_after boolean, change string, passed boolean",
    )


def enforce(gate: DataFrame, name: str) -> None:
    """Raise unless the gate has rows and all of them pass."""
    total, passed, sample = gate.agg(
        F.count(F.lit(1)),
        F.count_if("passed"),
        F.max(F.when(~F.col("passed"), F.to_json(F.struct(*gate.columns)))),
    ).first()
    if total == 0:
        raise GateFailed(f"{name}: nothing to compare")
    if passed < total:
        raise GateFailed(f"{name}: {total - passed} of {total} rows failed, such as {sample}")


def _side(metrics: DataFrame, name: str, side: str) -> DataFrame:
    return metric(metrics, name).withColumn("side", F.lit(side))
