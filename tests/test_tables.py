from __future__ import annotations

import pytest

from logtally.operators import CountLedger, SummaryTable, append_all
from logtally.plans import DAILY_SUMMARY
from logtally.storage import fresh_dir

from tests.conftest import rows

SCHEMA = "time_stamp string, app_id string, count bigint"


@pytest.fixture
def table(spark, request):
    made = SummaryTable(spark, DAILY_SUMMARY, fresh_dir(spark, "table"), f"t_{abs(hash(request.node.name))}")
    made.create()
    yield made
    made.drop()


@pytest.fixture
def counts(spark):
    return lambda *given: spark.createDataFrame(list(given), SCHEMA)


def test_create_is_idempotent_and_all_text(table, counts):
    assert rows(table.read()) == []
    assert table.read().schema.simpleString() == "struct<time_stamp:string,app_id:string,count:string>"
    table.insert(counts(("d", "a", 1)))
    table.create()
    assert rows(table.read()) == [("d", "a", "1")]


def test_insert_goes_by_name(spark, table, counts):
    table.insert(counts(("d", "a", 1)).select("count", "app_id", "time_stamp"))
    counts(("e", "b", 2)).createOrReplaceTempView("more")
    table.insert_from("more")
    assert rows(table.read()) == [("d", "a", "1"), ("e", "b", "2")]


def test_recounted_adds_up(table, counts):
    table.insert(counts(("d", "a", 1), ("d", "b", 1)))
    table.insert(counts(("d", "a", 2)))
    assert rows(table.recounted()) == [("d", "a", "3"), ("d", "b", "1")]
    assert table.read().count() == 3


def test_fold_replaces_the_table_it_reads(table, counts):
    for _ in range(4):
        table.fold(counts(("d", "a", 1), ("e", "a", 2)))
    assert rows(table.read()) == [("d", "a", "4"), ("e", "a", "8")]
    assert len(table.files.children(table.root)) == 2


def test_a_fold_that_dies_leaves_the_table_as_it_was(spark, table, counts, monkeypatch):
    table.fold(counts(("d", "a", 1)))
    staged = table._staged

    def die(content):
        staged(content)
        raise OSError("gone")

    with monkeypatch.context() as patched:
        patched.setattr(table, "_staged", die)
        with pytest.raises(OSError):
            table.fold(counts(("d", "a", 1)))
    assert rows(table.read()) == [("d", "a", "1")]
    table.fold(counts(("d", "a", 1)))
    assert rows(table.read()) == [("d", "a", "2")]


def test_a_reader_of_the_old_content_goes_on(spark, table, counts):
    table.fold(counts(("d", "a", 1)))
    before = spark.read.parquet(table._location())
    table.fold(counts(("d", "a", 1)))
    assert rows(before) == [("d", "a", "1")]


def test_quotes_in_the_path(spark, counts):
    made = SummaryTable(spark, DAILY_SUMMARY, f"{fresh_dir(spark, 'table')}/it's", "quoted_table")
    made.create()
    made.fold(counts(("d", "a", 1)))
    assert rows(made.read()) == [("d", "a", "1")]
    made.drop()


def test_truncate_twice(table, counts):
    table.insert(counts(("d", "a", 1)))
    table.truncate()
    table.truncate()
    assert rows(table.read()) == []
    table.insert(counts(("d", "a", 1)))
    assert rows(table.read()) == [("d", "a", "1")]


def test_publish_and_show(spark, table, counts, capsys):
    ledger = CountLedger.for_spec(spark, fresh_dir(spark, "ledger"), DAILY_SUMMARY)
    ledger.write_batch(counts(("d", "a", 1)), "r", 0)
    table.publish(ledger)
    ledger.write_batch(counts(("d", "a", 1)), "r", 1)
    table.publish(ledger)
    assert rows(spark.sql(f"SELECT * FROM {table.name}")) == [("d", "a", "2")]
    table.show()
    assert "time_stamp" in capsys.readouterr().out


def test_append_all(spark, table, counts):
    counts(("d", "a", 1)).selectExpr("time_stamp", "app_id", "cast(count as string)").createOrReplaceTempView("whole")
    append_all(spark, "whole", table.name)
    append_all(spark, "whole", table.name)
    assert rows(table.read()) == [("d", "a", "1")] * 2
