"""Registered queries against their SQL, and the shape of their plans."""

import os

import duckdb
import pytest

from checks.compare import TABLES, compare
from checks.oracle import oracles
from checks.queries import REGISTRY

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
PYTHON_ALLOWED = {"depreciation_rows", "depreciation_year", "exec_summary_depreciation", "farm_with_depreciation", "flex_lease", "melt_terms"}
STREAMS = {n for n in REGISTRY if n.startswith("stream_")}

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(oracles()) == set(REGISTRY)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_equals_sql(spark, con, name):
    report = compare(spark, con, name, FOLDER, oracles()[name])
    assert report.startswith("same") and "inexact" not in report, report


@pytest.mark.parametrize("name", sorted(set(REGISTRY) - STREAMS))
def test_plan_is_distributed(spark, name):
    plan = REGISTRY[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    if name not in PYTHON_ALLOWED:
        assert "Python" not in plan and "Pandas" not in plan


def test_columns_are_pruned(spark):
    plan = REGISTRY["account_totals"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    line = next(part for part in plan.split("\n") if "l_extendedprice" in part and "ReadSchema" in part)
    assert "l_returnflag" not in line.split("ReadSchema")[1] and "l_shipdate" not in line.split("ReadSchema")[1]


def test_year_range_reaches_the_scan(spark):
    plan = REGISTRY["exec_summary"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate,1998-01-01" in plan and "LessThan(o_orderdate," in plan
