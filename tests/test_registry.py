"""Every registered query against its SQL, on the small tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SMALL
from ledgerbrook.plans import registry

TABLES = [name.removesuffix(".parquet") for name in os.listdir(SMALL) if name.endswith(".parquet")]
# The text operators have tests of their own.
QUERIES = {name: run for name, run in entry.queries().items() if name in registry.QUERIES}
ORACLES = {name: sql for name, sql in entry.oracle_sql().items() if name in registry.QUERIES}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return connection


def by_name(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def same(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-12)
    return a == b


def test_entry(spark):
    assert entry.entry(spark).columns == ["report_date", "total_purchase_amt", "total_redeem_amt"]


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLES) == {"forecast_flow", "forecast_flow_hashed"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_sql(spark, duck, name):
    frame = QUERIES[name](spark, SMALL)
    got = by_name(frame.columns, [tuple(r) for r in frame.collect()])
    cursor = duck.execute(ORACLES[name])
    columns = [c[0] for c in cursor.description]
    want = by_name(columns, cursor.fetchall())
    assert sorted(columns) == sorted(frame.columns)
    assert len(got) == len(want)
    # No order was placed on the day asked for in the smallest tables.
    assert want or name == "city_average_balance"
    for left, right in zip(got, want):
        assert all(same(a, b) for a, b in zip(left, right)), (left, right)


def test_forecast_has_thirty_days(spark):
    rows = QUERIES["forecast_flow"](spark, SMALL).collect()
    assert len(rows) == 30
    assert all(r.purchase > 0 and r.redeem >= 0 for r in rows)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"forecast_flow", "forecast_flow_hashed"}))
def test_no_python_worker_and_no_cross_join(spark, name):
    plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    for operator in ("Python", "ArrowEval", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in plan
