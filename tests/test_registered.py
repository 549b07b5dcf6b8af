"""Every registered query with SQL must agree with it on whole tables."""

import os

import pytest

import __spark_entry__ as entry
from compare import compare, duck, schema_gap

SQL = entry.oracle_sql()
# each trains several models; test_workflows covers the same jobs on small logs
SEVERAL_MODELS = {"t3_backtest", "t3_backtest_two_behind", "t8_retrain", "t9_start_mode"}
CHECKED = sorted(SQL if os.environ.get("ALL_QUERIES") else SQL.keys() - SEVERAL_MODELS)


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_names_line_up():
    assert set(SQL) <= set(entry.queries())


@pytest.mark.parametrize("name", CHECKED)
def test_agrees_with_sql(spark, sf_dir, con, name):
    df = entry.queries()[name](spark, sf_dir)
    assert compare(df, con, SQL[name]) is None
    assert schema_gap(df, con, SQL[name]) == []


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "url" in df.columns
