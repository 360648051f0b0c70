"""Every registered query against its SQL on the driver's tables."""

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as registry
from bazaargraph.plans.queries import QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in os.listdir(SF_DIR):
        name = file.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{file}'")
    return connection


def normal(frame: pd.DataFrame) -> list[tuple]:
    def plain(value):
        if value is None or value is pd.NaT or value != value:
            return None
        if isinstance(value, pd.Timestamp):
            return value.isoformat()
        if hasattr(value, "item"):
            return value.item()
        return value

    columns = sorted(frame.columns)
    rows = [tuple(plain(v) for v in row) for row in frame[columns].itertuples(index=False)]
    return sorted(rows, key=repr)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(registry.queries())
    assert set(QUERIES) <= set(registry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    result = registry.queries()[name](spark, SF_DIR)
    expected = duck.execute(registry.oracle_sql()[name]).df()
    found = result.toPandas()
    assert sorted(found.columns) == sorted(expected.columns)
    assert len(found) > 0
    plan = result._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python"):
        assert unwanted not in plan
    assert normal(found) == normal(expected)
