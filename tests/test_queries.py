"""Every registered query against its SQL twin, and the shape of the plans."""

from __future__ import annotations

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as driver  # noqa: E402
from cratebook.testbed import queries as testbed  # noqa: E402
from tools.check import TABLES, normal  # noqa: E402

QUERIES, ORACLES = testbed.QUERIES, testbed.ORACLES
# Writing or streaming runs while the query is built; the plan says nothing more.
PLANNED = [n for n in QUERIES if not n.startswith(("stream", "sync", "save", "export", "load_table", "consolidation"))]


@pytest.fixture(scope="module")
def database(small):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{small}/{table}.parquet'")
    return con


def test_entry(spark):
    assert driver.entry(spark).count() > 0


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, small, database, name):
    df = QUERIES[name](spark, small)
    got = [tuple(r) for r in df.collect()]
    if name not in ORACLES:
        assert got
        return
    result = database.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert normal(got, df.columns) == normal(result.fetchall(), columns)


@pytest.mark.parametrize("name", PLANNED)
def test_no_cross_join_and_no_row_python(spark, small, name):
    plan = QUERIES[name](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan
    if name not in ("publishable_description", "description_delta"):
        assert "ArrowEvalPython" not in plan


def test_filters_and_columns_reach_the_scan(spark, small):
    plan = QUERIES["most_played_month"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(l_shipdate" in plan and "LessThan(l_shipdate" in plan
    assert "l_extendedprice" not in plan and "o_totalprice" not in plan
    errors = QUERIES["error_patterns"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(event_type,error)" in errors


@pytest.mark.parametrize("name", ["most_played_every_month", "discovery_every_month", "discovery_every_year", "top_genres"])
def test_top_lists_are_cut_before_the_shuffle(spark, small, name):
    plan = QUERIES[name](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2


def test_long_top_lists_are_cut_before_the_shuffle(spark, small):
    from pyspark.sql import functions as F

    from cratebook.operators.grouping import top_per_group

    lines = spark.read.parquet(f"{small}/lineitem.parquet").select("l_returnflag", "l_orderkey")
    plan = top_per_group(lines, ["l_returnflag"], [F.col("l_orderkey")], 5000)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2


def test_every_registered_query_of_the_library_is_offered():
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLES) <= set(driver.oracle_sql())
