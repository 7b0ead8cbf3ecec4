"""Every registered query against its SQL, over the smallest driver tables."""

import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_module
from driftwright import catalog

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no driver tables here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(FOLDER).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def rows(values):
    return sorted(tuple(f"{v:.9g}" if isinstance(v, float) else str(v) for v in row) for row in values)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_equals_sql(spark, duck, name):
    df = catalog.QUERIES[name](spark, FOLDER)
    expected = duck.execute(catalog.ORACLES[name])
    columns = sorted(c[0] for c in expected.description)
    assert sorted(df.columns) == columns
    order = [[c[0] for c in expected.description].index(c) for c in columns]
    assert rows(df.select(*(f"`{c}`" for c in columns)).collect()) == rows([r[k] for k in order] for r in expected.fetchall())


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_query_runs(spark, name):
    assert catalog.QUERIES[name](spark, FOLDER).count() > 0


def test_registry():
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
    assert set(catalog.QUERIES) <= set(entry_module.queries())


def test_entry(spark):
    assert entry_module.entry(spark).columns == ["yr", "n", "avg_price"]


def test_filters_and_columns_reach_the_scan(spark):
    plan = catalog.QUERIES["trips_since_year"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "IsNotNull(o_orderdate)" in plan and "o_custkey" not in plan
