"""Every registered workload against its SQL definition, on the smallest tables."""

import math
import os

import duckdb
import pytest

from voltline.workloads import ORACLES, QUERIES

from .conftest import SF_DIR

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
TYPES = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean", "DATE": "date", "TIMESTAMP": "timestamp_ntz"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def _clean(value):
    return None if isinstance(value, float) and math.isnan(value) else value


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    check_plan(df)
    expected = duck.sql(ORACLES[name])
    columns = sorted(df.columns)
    assert columns == sorted(expected.columns)
    types = dict(zip(expected.columns, map(str, expected.types)))
    assert {c: TYPES[types[c]] for c in columns} == {c: t for c, t in df.dtypes}
    order = ", ".join(f'"{c}"' for c in columns)
    want = sorted((tuple(map(_clean, r)) for r in expected.project(order).fetchall()), key=repr)
    got = sorted((tuple(map(_clean, r)) for r in df.select(*columns).collect()), key=repr)
    assert got == want


def test_workload_without_sql_has_rows(spark):
    for name in set(QUERIES) - set(ORACLES):
        df = QUERIES[name](spark, SF_DIR)
        check_plan(df)
        assert df.count() > 0


def check_plan(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "BatchEvalPython" not in plan  # no row-at-a-time Python


def test_contract_module():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.queries()) and os.path.exists(SF_DIR)


def test_gap_check_scans_its_source_once(spark):
    df = QUERIES["gap_check_many_series"](spark, SF_DIR)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("FileScan") == 1 and "ReusedExchange" in final


def test_filters_and_columns_reach_the_scan(spark):
    from voltline.functions.timeutil import ntz
    from voltline.operators.panels import capacity_snapshot
    from voltline.workloads.registry import table
    from pyspark.sql import functions as F

    orders = table(spark, SF_DIR, "orders")
    df = capacity_snapshot(
        orders, ["o_orderstatus"], ntz("1999-06-30"), capacity="o_totalprice", start="o_orderdate", end="o_orderdate"
    )
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderdate), LessThanOrEqual(o_orderdate" in plan
    assert "o_custkey" not in plan
    assert df.filter(F.lit(False)).count() == 0
