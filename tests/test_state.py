"""Queries that keep state: running counts, totals in the state itself, records delivered twice, restarts, killed drivers."""

from __future__ import annotations

import os
import signal
import subprocess
import sys
import time

import pytest
from pyspark.sql.types import StructType

from logtally.operators import RunningCounts, keep, parse, summarise
from logtally.operators.batches import BatchTable, Part
from logtally.plans import DAILY_SUMMARY, MILLISECOND_SUMMARY, TRANSACTION_FIELDS
from logtally.plans.transactions import record_spec
from logtally.sources import read_lines, stream_lines
from logtally.storage import fresh_dir
from logtally.streaming import (
    BatchMetrics,
    StopRequest,
    daily_counts,
    start_running_count,
    start_state_summary,
    start_stored_batches,
    state_summary,
    state_totals,
    stored_rows,
    without_redelivered,
)
from logtally.streaming.state import ROCKSDB, settings

from tests.conftest import ROOT, rows


def line(stamp, app, number=0):
    given = {"id": str(number), "time_stamp": f"{stamp} 10:00:00 000", "app_id": app, "channel_type": "sms", "travel_direction": "mo"}
    return "|".join(given.get(name, "") for name in TRANSACTION_FIELDS)


@pytest.fixture
def add(tmp_path):
    """Adds files that a stream reads in this order."""

    def write(*lines):
        i = len(list(tmp_path.iterdir()))
        path = tmp_path / f"{i:03}.txt"
        path.write_text("".join(f"{x}\n" for x in lines))
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))

    write.folder = str(tmp_path)
    return write


@pytest.fixture
def checkpoint(spark):
    return fresh_dir(spark, "checkpoint")


def stream(spark, add):
    return stream_lines(spark, add.folder, max_files_per_trigger=1)


def records(spark, add):
    return keep(parse(stream(spark, add), MILLISECOND_SUMMARY), MILLISECOND_SUMMARY.where)


# Running counts


def test_running_counts_take_late_records_and_go_on_after_a_restart(spark, add, checkpoint):
    counts = RunningCounts(spark, fresh_dir(spark, "counts"), ["app_id"])
    run = lambda: start_running_count(records(spark, add), counts, checkpoint, interval_seconds=None, compact_every=None).awaitTermination(120)
    add(line("2024-05-01", "a"), line("2024-05-02", "b"))
    add(line("2024-05-03", "a"))
    run()
    assert rows(counts.current()) == [("a", 2), ("b", 1)]
    # A batch sends the keys that it has changed, and no others.
    assert rows(counts.updates()) == [(0, "a", 1), (0, "b", 1), (1, "a", 2)]
    add(line("2019-01-01", "b"), line("2019-01-01", "c"))
    run()
    assert rows(counts.current()) == [("a", 2), ("b", 2), ("c", 1)]
    assert counts.compact() == 1 and rows(counts.current()) == [("a", 2), ("b", 2), ("c", 1)]
    add(line("2024-05-04", "c"))
    run()
    assert rows(counts.current()) == [("a", 2), ("b", 2), ("c", 2)]


def test_a_batch_of_running_counts_is_written_twice_in_vain(spark, add, checkpoint):
    counts = RunningCounts(spark, fresh_dir(spark, "counts"), ["app_id"])
    add(line("2024-05-01", "a"))
    add(line("2024-05-01", "a"))
    upsert = counts.upsert

    def die(changed, batch_id):
        upsert(changed, batch_id)
        if batch_id == 1:
            raise OSError("gone")

    counts.upsert = die
    with pytest.raises(Exception, match="gone"):
        start_running_count(records(spark, add), counts, checkpoint, interval_seconds=None).awaitTermination(120)
    counts.upsert = upsert
    counts.compact()
    add(line("2024-05-01", "a"))
    start_running_count(records(spark, add), counts, checkpoint, interval_seconds=None, compact_every=1).awaitTermination(120)
    assert rows(counts.current()) == [("a", 3)]


def test_running_counts_by_hand(spark):
    counts = RunningCounts(spark, fresh_dir(spark, "counts"), ["app_id"])
    make = lambda *given: spark.createDataFrame(list(given), "app_id string, count long")
    assert rows(counts.current()) == []
    for i, given in enumerate([[("a", 5), (None, 1)], [("b", 1)], [("a", 4)], []]):
        assert counts.upsert(make(*given), i)
    # The newest value holds, not the largest.
    assert rows(counts.current()) == sorted([("a", 4), ("b", 1), (None, 1)], key=repr)
    assert counts.compact() == 1 and not counts.upsert(make(("a", 99)), 1)
    assert rows(counts.current()) == sorted([("a", 4), ("b", 1), (None, 1)], key=repr)
    with pytest.raises(ValueError):
        RunningCounts(spark, "x", [])


# Totals in the state


def test_totals_are_read_from_the_state(spark, add, checkpoint):
    for i in range(4):
        add(*[line(f"2024-05-0{1 + j % 3}", f"app{j % 5}") for j in range(i, 30)], "no record")
    start_state_summary(stream(spark, add), DAILY_SUMMARY, checkpoint, interval_seconds=None).awaitTermination(120)
    want = rows(summarise(read_lines(spark, add.folder), DAILY_SUMMARY))
    assert rows(state_totals(spark, checkpoint, DAILY_SUMMARY)) == want
    assert rows(state_summary(spark, checkpoint, DAILY_SUMMARY)) == [(*keys, str(n)) for *keys, n in want]
    first = state_totals(spark, checkpoint, DAILY_SUMMARY, batch_id=0)
    assert first.agg({"count": "sum"}).first()[0] == 30


def test_settings_are_put_back(spark):
    name = next(iter(ROCKSDB))
    before = spark.conf.get(name)
    with pytest.raises(ZeroDivisionError), settings(spark, ROCKSDB):
        assert spark.conf.get(name) == ROCKSDB[name]
        1 / 0
    assert spark.conf.get(name) == before


CHILD = """
import os, signal, sys, threading, time
from pyspark.sql import SparkSession
from logtally.plans import DAILY_SUMMARY
from logtally.sources import stream_lines
from logtally.streaming import BatchMetrics, start_state_summary

source, checkpoint = sys.argv[1:]
spark = SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "2").config("spark.ui.enabled", "false").getOrCreate()
kill = lambda row: os.kill(os.getpid(), signal.SIGKILL) if row[1] == 2 else None
with BatchMetrics(spark, kill):
    start_state_summary(stream_lines(spark, source, max_files_per_trigger=1), DAILY_SUMMARY, checkpoint, interval_seconds=None).awaitTermination()
    time.sleep(60)
"""


def test_a_killed_driver_and_its_state(spark, add, checkpoint):
    for i in range(12):
        add(*[line(f"2024-05-0{1 + j % 3}", f"app{j % 4}") for j in range(i, 40)])
    child = subprocess.run(
        [sys.executable, "-c", CHILD, add.folder, checkpoint], env={**os.environ, "PYTHONPATH": str(ROOT)}, capture_output=True, timeout=300, check=False
    )
    assert child.returncode == -signal.SIGKILL, child.stderr.decode()[-2000:]
    time.sleep(3)  # The child's JVM ends on its own once its Python side is gone.
    start_state_summary(stream(spark, add), DAILY_SUMMARY, checkpoint, interval_seconds=None).awaitTermination(120)
    assert rows(state_totals(spark, checkpoint, DAILY_SUMMARY)) == rows(summarise(read_lines(spark, add.folder), DAILY_SUMMARY))


# Restarts and records delivered twice


def test_windows_survive_a_stop_between_batches(spark, add, checkpoint):
    for day in ("01", "01", "02", "03", "20"):
        add(line(f"2024-05-{day}", "a"))
    table = BatchTable(spark, fresh_dir(spark, "days"), StructType.fromDDL("day string, app_id string, count long"))
    stop = StopRequest()
    stop.ask()
    start_stored_batches(daily_counts(records(spark, add), "5 days"), table, checkpoint, interval_seconds=None, stop=stop)
    assert stop.wait(60)
    assert len(table.parts()) <= 2 and rows(stored_rows(table)) == []
    with BatchMetrics(spark) as metrics:
        query = start_stored_batches(daily_counts(records(spark, add), "5 days"), table, checkpoint, interval_seconds=None)
        query.awaitTermination(120)
        states = metrics.state_rows(query)
    assert states and states[0][1] >= 1
    assert rows(stored_rows(table)) == [("2024-05-01", "a", 2), ("2024-05-02", "a", 1), ("2024-05-03", "a", 1)]


def test_a_record_counts_once_within_the_delay(spark, add, checkpoint):
    add(line("2024-05-01", "a", 1), line("2024-05-01", "a", 2), line("2024-05-01", "a", 1))
    add(line("2024-05-01", "a", 1), line("2024-05-02", "b", 3), line("not a day", "b", 4))
    add(line("2024-05-03", "a", 2), line("2024-05-03", "a", 5))
    spec = record_spec("id", "time_stamp", "app_id")
    table = BatchTable(spark, fresh_dir(spark, "records"), StructType.fromDDL("id string, app_id string"))
    with BatchMetrics(spark) as metrics:
        kept = without_redelivered(parse(stream(spark, add), spec), "5 days")
        query = start_stored_batches(kept, table, checkpoint, interval_seconds=None)
        query.awaitTermination(120)
        total = metrics.table(query).groupBy().sum("repeated_rows", "unreadable_times", "late_rows").first()
    got = rows(stored_rows(table))
    assert [r for r in got if r[0] != "4"] == [("1", "a"), ("2", "a"), ("3", "b"), ("5", "a")]
    assert total[0] == 3 and total[1] == 1


def test_a_batch_that_is_repeated_replaces_itself(spark):
    table = BatchTable(spark, fresh_dir(spark, "days"), StructType.fromDDL("day string"))
    for _ in range(2):
        table.write(spark.createDataFrame([("x",)], "day string"), Part("stream", 0, 0))
    assert rows(stored_rows(table)) == [("x",)]
