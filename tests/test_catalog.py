"""Every registered query against its SQL, and checks on the plans."""

import re

import pytest

from __spark_entry__ import entry
from carelake.catalog import ORACLES, QUERIES
from tools.compare import compare, duck

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_sql(spark, con, name):
    line = compare(spark, con, SMALL, name, QUERIES[name], ORACLES.get(name))
    assert line.startswith(("ok", "rows")), line


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_or_nested_loop_join(spark, name):
    text = plan(QUERIES[name](spark, SMALL))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "PythonUDF" not in text and "ArrowEvalPython" not in text


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry_is_the_daily_summary(spark):
    df = entry(spark)
    assert {"hospital_code", "kpi_date", "readmission_rate_pct"} <= set(df.columns) and df.count() > 0


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(QUERIES["scan_parquet"](spark, SMALL))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(o_orderdate", text)
    assert re.search(r"ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderdate:timestamp_ntz>", text)


def test_claim_counts_do_not_join(spark):
    """Measures that need no patient or diagnosis read one table."""
    text = plan(QUERIES["denial_rate"](spark, SMALL))
    assert "Join" not in text and text.count("FileScan") >= 1
