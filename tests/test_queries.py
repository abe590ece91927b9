"""Every registered query against its SQL on a second engine."""

import math
import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as registered

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = registered.queries(), registered.oracle_sql()

pytestmark = pytest.mark.skipif(not Path(FOLDER).is_dir(), reason="no test tables")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for file in Path(FOLDER).glob("*.parquet"):
        connection.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def plain_rows(rows):
    def value(v):
        return None if isinstance(v, float) and math.isnan(v) else v

    return sorted((tuple(value(v) for v in row) for row in rows), key=repr)


def test_every_own_query_has_sql():
    assert set(registered.own_queries()) == set(registered.oracles.statements())
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", SQL)
def test_query(spark, database, name):
    frame = QUERIES[name](spark, FOLDER)
    columns = sorted(frame.columns)
    relation = database.sql(SQL[name])
    assert sorted(relation.columns) == columns
    quoted = ", ".join(f'"{c}"' for c in columns)
    expected = database.sql(f"SELECT {quoted} FROM ({SQL[name]})").fetchall()
    assert plain_rows(map(tuple, frame.select(*columns).collect())) == plain_rows(expected)


def test_flagship(spark):
    frame = registered.entry(spark)
    assert 0 < frame.count() <= 200
