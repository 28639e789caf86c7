"""Every registered query against its DuckDB counterpart, on the smallest test tables."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from harness import queries as catalog

DATA = Path("/root/testdata/sf0.001")
QUERIES, ORACLES = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in DATA.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def normal(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)

    def cell(value):
        return "NaN" if isinstance(value, float) and math.isnan(value) else repr(value)

    return sorted(tuple(cell(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, duck, name):
    result = QUERIES[name](spark, str(DATA))
    expected = duck.execute(ORACLES[name])
    columns = [d[0] for d in expected.description]
    assert sorted(result.columns) == sorted(columns)
    rows = normal(result.columns, result.collect())
    assert rows and rows == normal(columns, expected.fetchall())


def test_every_query_has_a_counterpart():
    assert set(catalog.queries()) <= set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert contract.entry(spark).count() > 0
