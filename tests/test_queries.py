"""Every registered query against its SQL in DuckDB, on the given tables."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb
import pytest

from logtally import queries as catalogue

from tests.conftest import TESTDATA

QUERIES = catalogue.queries()
SQL = catalogue.oracle_sql()

pytestmark = pytest.mark.skipif(not Path(TESTDATA).exists(), reason="no test data here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.sql(f"CREATE VIEW events AS SELECT * FROM '{TESTDATA}/events.parquet'")
    return connection


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    result = QUERIES[name](spark, TESTDATA)
    expected = duck.sql(SQL[name])
    columns = sorted(expected.columns)
    assert sorted(result.columns) == columns
    got = Counter(tuple(row) for row in result.select(*columns).collect())
    want = Counter(expected.select(*[f'"{column}"' for column in columns]).fetchall())
    assert got == want


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_on_the_executors(spark):
    for name in ("parse_delimited", "full_record", "batch_summary", "millisecond_summary", "sms_mo_projection"):
        plan = plan_of(QUERIES[name](spark, TESTDATA))
        assert "Python" not in plan and "Arrow" not in plan, name


def test_the_flagship_splits_once_and_shuffles_once(spark):
    plan = plan_of(QUERIES["text_file_summary"](spark, TESTDATA))
    assert plan.count("Exchange") == 1
    assert "partial_count" in plan
    assert plan.count("Generate explode(array(split(") == 1
    # The filter stands above the split, not below it with splits of its own.
    assert plan.index("Filter (CASE") < plan.index("Generate explode")
    assert "ReadSchema: struct<value:string>" in plan


def test_only_the_needed_event_columns_are_read(spark):
    plan = plan_of(QUERIES["batch_summary"](spark, TESTDATA))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string>" in plan
