from __future__ import annotations

import os
import random
import threading
import time

import pytest

from logtally import FieldSpec, SummarySpec
from logtally.functions import decode_value
from logtally.operators import CountLedger, pick, parse, summarise
from logtally.plans import DAILY_SUMMARY, MILLISECOND_SUMMARY, TRANSACTION_FIELDS, jobs
from logtally.sources import read_lines, stream_lines
from logtally.storage import Files, fresh_dir
from logtally.streaming import (
    BatchMetrics,
    StopRequest,
    batch_timings,
    daily_counts,
    start_archive,
    start_parquet_sink,
    start_preview,
    start_summary,
)
from logtally.streaming.summary import LedgerInUse, run_of

from tests.conftest import rows

SPEC = SummarySpec(
    fields=(FieldSpec("day", 1, (0, 10)), FieldSpec("app", 2), FieldSpec("kind", 3)),
    group_by=("day", "app"),
    where="kind = 'sms'",
    field_count=4,
)


class Input:
    """A directory of line files whose order of arrival is the order of ``add``."""

    def __init__(self, folder):
        self.folder = folder
        self.count = 0

    def add(self, lines):
        path = self.folder / f"{self.count:03d}.txt"
        path.write_text("".join(line + "\n" for line in lines), encoding="utf-8")
        stamp = time.time() - 1000 + 10 * self.count
        os.utime(path, (stamp, stamp))
        self.count += 1

    def add_random(self, files, seed=0):
        draw = random.Random(seed)
        for _ in range(files):
            self.add(
                f"2024-01-0{draw.randint(1, 5)} 10:00|{draw.choice('abc')}|{draw.choice(['sms', 'web'])}|"
                for _ in range(50)
            )


@pytest.fixture
def source(tmp_path):
    return Input(tmp_path)


@pytest.fixture
def ledger(spark):
    return CountLedger.for_spec(spark, fresh_dir(spark, "ledger"), SPEC)


@pytest.fixture
def checkpoint(spark):
    return fresh_dir(spark, "checkpoint")


def run(spark, source, ledger, checkpoint, **options):
    lines = stream_lines(spark, str(source.folder), max_files_per_trigger=1)
    query = start_summary(lines, SPEC, ledger, checkpoint, interval_seconds=None, **options)
    query.awaitTermination(120)
    return query


def batch_result(spark, source):
    return [(*keys, str(n)) for *keys, n in rows(summarise(read_lines(spark, str(source.folder)), SPEC))]


@pytest.mark.parametrize("compact_every", [None, 2])
def test_stream_equals_batch(spark, source, ledger, checkpoint, compact_every):
    source.add_random(5)
    query = run(spark, source, ledger, checkpoint, compact_every=compact_every)
    assert rows(ledger.summary()) == batch_result(spark, source)
    timings = batch_timings(query)
    assert [t["batch_id"] for t in timings] == [0, 1, 2, 3, 4]
    assert all(t["input_rows"] == 50 and t["millis"] >= 0 for t in timings)
    assert all(t["observed"]["lines"] == {"all_lines": 50, "null_lines": 0} for t in timings)
    assert ledger.runs() == {run_of(spark, checkpoint)["run"]}


def test_restart_takes_only_what_is_new(spark, source, ledger, checkpoint):
    source.add_random(2)
    run(spark, source, ledger, checkpoint)
    before = rows(ledger.summary())
    run(spark, source, ledger, checkpoint)
    assert rows(ledger.summary()) == before == batch_result(spark, source)
    source.add_random(2, seed=1)
    run(spark, source, ledger, checkpoint)
    assert rows(ledger.summary()) == batch_result(spark, source)


@pytest.mark.parametrize("after_the_write", [True, False])
def test_a_failing_batch_is_retried(spark, source, ledger, checkpoint, monkeypatch, after_the_write):
    source.add_random(4)
    write = ledger.write_batch

    def die_in_batch_two(counts, run_id, batch_id, **options):
        if batch_id == 2 and not after_the_write:
            raise OSError("gone")
        write(counts, run_id, batch_id, **options)
        if batch_id == 2:
            raise OSError("gone")

    with monkeypatch.context() as patched:
        patched.setattr(ledger, "write_batch", die_in_batch_two)
        with pytest.raises(Exception, match="gone"):
            run(spark, source, ledger, checkpoint)
    run(spark, source, ledger, checkpoint)
    assert rows(ledger.summary()) == batch_result(spark, source)


@pytest.mark.parametrize("merged_before", [True, False])
def test_a_lost_commit_mark_changes_nothing(spark, source, ledger, checkpoint, merged_before):
    source.add_random(3)
    run(spark, source, ledger, checkpoint)
    if merged_before:
        ledger.compact()
        ledger.compact()
    Files(spark, checkpoint).delete(f"{checkpoint}/commits/2")
    source.add_random(1, seed=1)
    run(spark, source, ledger, checkpoint)
    assert rows(ledger.summary()) == batch_result(spark, source)


def test_null_lines_are_counted_and_left_out(spark, ledger, checkpoint):
    path = fresh_dir(spark, "values")
    spark.createDataFrame([(b"2024-01-01|a|sms",), (None,)], "value binary").write.parquet(path)
    lines = decode_value(spark.readStream.schema("value binary").parquet(path))
    query = start_summary(lines, SPEC, ledger, checkpoint, interval_seconds=None)
    query.awaitTermination(120)
    assert rows(ledger.summary()) == [("2024-01-01", "a", "1")]
    assert batch_timings(query)[0]["observed"]["lines"] == {"all_lines": 2, "null_lines": 1}
    archive = fresh_dir(spark, "archive")
    start_archive(lines, archive, fresh_dir(spark, "cp"), interval_seconds=None).awaitTermination(120)
    assert rows(spark.read.parquet(archive)) == [("2024-01-01|a|sms",)]


def test_batches_can_be_bounded_by_bytes(spark, source, ledger, checkpoint):
    source.add_random(4)
    size = max(path.stat().st_size for path in source.folder.iterdir())
    lines = stream_lines(spark, str(source.folder), max_bytes_per_trigger=size)
    query = start_summary(lines, SPEC, ledger, checkpoint, interval_seconds=None)
    query.awaitTermination(120)
    assert len(batch_timings(query)) >= 3
    assert rows(ledger.summary()) == batch_result(spark, source)


def test_a_new_checkpoint_is_refused_unless_its_input_is_new(spark, source, ledger, checkpoint):
    source.add_random(2)
    run(spark, source, ledger, checkpoint)
    other = fresh_dir(spark, "checkpoint")
    with pytest.raises(LedgerInUse):
        run(spark, source, ledger, other)
    assert rows(ledger.summary()) == batch_result(spark, source)
    run(spark, source, ledger, other, add_run=True)
    assert rows(ledger.summary()) == [(d, a, str(2 * int(n))) for d, a, n in batch_result(spark, source)]
    run(spark, source, ledger, other)
    run(spark, source, ledger, checkpoint)
    assert rows(ledger.summary()) == [(d, a, str(2 * int(n))) for d, a, n in batch_result(spark, source)]
    ledger.reset()
    run(spark, source, ledger, fresh_dir(spark, "checkpoint"))
    assert rows(ledger.summary()) == batch_result(spark, source)


def test_a_batch_without_matches_is_fine(spark, source, ledger, checkpoint):
    source.add(["2024-01-01|a|web", ""])
    source.add(["2024-01-01|a|sms"])
    run(spark, source, ledger, checkpoint)
    assert rows(ledger.summary()) == [("2024-01-01", "a", "1")]


def test_interval_trigger_and_stop(spark, source, ledger, checkpoint):
    source.add_random(2)
    lines = stream_lines(spark, str(source.folder), max_files_per_trigger=1)
    query = start_summary(lines, SPEC, ledger, checkpoint, interval_seconds=0.2, name="tally")
    try:
        query.processAllAvailable()
        source.add_random(1, seed=1)
        query.processAllAvailable()
        assert query.name == "tally" and query.isActive
    finally:
        query.stop()
    assert rows(ledger.summary()) == batch_result(spark, source)


def test_stopping_lets_the_batch_finish(spark, source, ledger, checkpoint, monkeypatch):
    source.add_random(2)
    write, started = ledger.write_batch, threading.Event()

    def slow(*args, **options):
        started.set()
        time.sleep(1.5)
        return write(*args, **options)

    monkeypatch.setattr(ledger, "write_batch", slow)
    lines = stream_lines(spark, str(source.folder))
    stop = StopRequest()
    query = start_summary(lines, SPEC, ledger, checkpoint, interval_seconds=60, stop=stop)
    assert started.wait(60)
    stop.ask()
    assert stop.wait(60)
    assert not query.isActive and query.exception() is None
    assert rows(ledger.summary()) == batch_result(spark, source)


def test_a_busy_stream_stops_between_batches(spark, source, ledger, checkpoint):
    for i in range(120):
        source.add([f"{i}|a|b|c|d"])
    lines = stream_lines(spark, str(source.folder), max_files_per_trigger=1)
    stop = StopRequest()
    done, write = [], ledger.write_batch

    def noted(counts, run_id, batch_id, **options):
        done.append(batch_id)
        if batch_id == 2:
            stop.ask()
        return write(counts, run_id, batch_id, **options)

    ledger.write_batch = noted
    query = start_summary(lines, SPEC, ledger, checkpoint, interval_seconds=0, stop=stop)
    assert stop.wait(60) and query.exception() is None
    assert max(done) <= 3
    run(spark, source, ledger, checkpoint)
    assert rows(ledger.summary()) == batch_result(spark, source)


def test_an_idle_stream_stops(spark, source, ledger, checkpoint):
    source.add_random(1)
    stop = StopRequest()
    query = start_summary(stream_lines(spark, str(source.folder)), SPEC, ledger, checkpoint, interval_seconds=60, stop=stop)
    query.processAllAvailable()
    stop.ask()
    assert stop.wait(30) and query.exception() is None


def batch_counts(spark):
    return spark.createDataFrame([("2024-01-01", "a", 1)], "day string, app string, count long")


def test_an_emptied_ledger_refuses_its_old_checkpoint(spark, source, ledger, checkpoint):
    source.add_random(3)
    run(spark, source, ledger, checkpoint)
    ledger.reset()
    source.add_random(1)
    with pytest.raises(LedgerInUse, match="lacks"):
        run(spark, source, ledger, checkpoint)
    ledger.write_batch(batch_counts(spark), "other", 0)
    with pytest.raises(LedgerInUse, match="lacks"):
        run(spark, source, ledger, checkpoint)
    ledger.reset()
    run(spark, source, ledger, fresh_dir(spark, "cp"))
    assert rows(ledger.summary()) == batch_result(spark, source)


def test_a_failing_merge_does_not_stop_the_stream(spark, source, ledger, checkpoint, monkeypatch):
    source.add_random(2)
    monkeypatch.setattr(ledger, "compact", lambda **_: 1 / 0)
    lines = stream_lines(spark, str(source.folder), max_files_per_trigger=1)
    start_summary(lines, SPEC, ledger, checkpoint, interval_seconds=None, compact_every=1).awaitTermination(120)
    assert rows(ledger.summary()) == batch_result(spark, source)


def test_metrics_have_every_batch(spark, tmp_path):
    for i in range(110):
        (tmp_path / f"{i:03}.txt").write_text(f"line {i}\n")
    lines = stream_lines(spark, str(tmp_path), max_files_per_trigger=1)
    with BatchMetrics(spark) as metrics:
        query = lines.writeStream.foreachBatch(lambda batch, i: None).option("checkpointLocation", fresh_dir(spark, "cp"))
        query = query.trigger(availableNow=True).start()
        query.awaitTermination(300)
        got = metrics.table(query)
    assert got.where("batch_id >= 0").select("batch_id").distinct().count() >= 110


def test_metrics_count_what_is_left_out(spark, source, checkpoint):
    source.add([transaction("2024-01-01 10:00:00 000", "a"), transaction("no time", "a")])
    source.add([transaction("2024-01-20 10:00:00 000", "a")])
    source.add([transaction("2024-01-01 10:00:00 000", "a"), transaction("2024-01-30 10:00:00 000", "a")])
    source.add([transaction("2024-01-01 10:00:00 000", "a")])
    records = parse(stream_lines(spark, str(source.folder), max_files_per_trigger=1), MILLISECOND_SUMMARY)
    with BatchMetrics(spark) as metrics:
        query = start_parquet_sink(daily_counts(records), fresh_dir(spark, "out"), checkpoint, interval_seconds=None)
        query.awaitTermination(120)
        got = metrics.table(query).groupBy().sum("unreadable_times", "late_rows").first()
    assert got[0] == 1 and got[1] >= 1


def test_running_count_agrees(spark, source):
    """Spark's own complete-mode count over the stream, as a cross-check of the ledger."""
    source.add_random(3)
    lines = stream_lines(spark, str(source.folder), max_files_per_trigger=1)
    query = summarise(lines, SPEC).writeStream.outputMode("complete").format("memory").queryName("running")
    query.trigger(availableNow=True).start().awaitTermination(120)
    assert [(d, a, str(n)) for d, a, n in rows(spark.table("running"))] == batch_result(spark, source)


def test_parquet_sink_and_preview_side_by_side(spark, source, capsys):
    source.add_random(3)
    records = pick(parse(stream_lines(spark, str(source.folder)), SPEC), "day", "app", where="kind = 'sms'")
    path, pools = fresh_dir(spark, "sink"), []

    def show(batch, batch_id):
        pools.append(batch.sparkSession.sparkContext.getLocalProperty("spark.scheduler.pool"))

    stored = start_parquet_sink(records, path, fresh_dir(spark, "cp"), interval_seconds=None, pool="pool1")
    shown = start_preview(records, show=show, interval_seconds=None, pool="pool2")
    assert stored.awaitTermination(120) and shown.awaitTermination(120)
    assert pools == ["pool2"]
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None
    expected = pick(parse(read_lines(spark, str(source.folder)), SPEC), "day", "app", where="kind = 'sms'")
    assert rows(spark.read.parquet(path)) == rows(expected)
    capsys.readouterr()
    start_preview(records, rows=2, interval_seconds=None).awaitTermination(120)
    assert "only showing top 2 rows" in capsys.readouterr().out


def test_parquet_sink_after_a_lost_commit_mark(spark, source):
    source.add_random(2)
    path, checkpoint = fresh_dir(spark, "sink"), fresh_dir(spark, "cp")

    def go():
        records = parse(stream_lines(spark, str(source.folder), max_files_per_trigger=1), SPEC)
        start_parquet_sink(records, path, checkpoint, interval_seconds=None).awaitTermination(120)

    go()
    Files(spark, checkpoint).delete(f"{checkpoint}/commits/1")
    go()
    assert rows(spark.read.parquet(path)) == rows(parse(read_lines(spark, str(source.folder)), SPEC))


def test_archive_keeps_lines_as_they_are(spark, source):
    lines = ["a|b||", "||", "", " x "]
    source.add(lines)
    path = fresh_dir(spark, "archive")
    archived = stream_lines(spark, str(source.folder))
    start_archive(archived, path, fresh_dir(spark, "cp"), interval_seconds=None).awaitTermination(120)
    assert {row.line for row in spark.read.parquet(path).collect()} == set(lines)
    assert spark.read.parquet(path).count() == len(lines)
    assert spark.read.parquet(path).columns == ["line"]


def transaction(stamp, app):
    given = {"time_stamp": stamp, "app_id": app, "channel_type": "sms", "travel_direction": "mo"}
    return "|".join(given.get(name, "") for name in TRANSACTION_FIELDS)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_daily_counts_send_closed_days_and_drop_what_is_too_late(spark, source, zone):
    source.add([transaction("2024-01-01 10:00:00 000", "a"), transaction("2024-01-01 23:59:59 999", "b")])
    source.add([transaction("2024-01-02 00:05:00 000", "a"), transaction("2024-01-01 23:58:00 000", "a")])
    source.add([transaction("2024-01-02 12:00:00 000", "a"), transaction("no time", "a")])
    source.add([transaction("2024-01-02 12:01:00 000", "b")])
    source.add([transaction("2024-01-01 09:00:00 000", "a"), transaction("2024-01-03 00:10:00 000", "a")])
    path, checkpoint = fresh_dir(spark, "daily"), fresh_dir(spark, "cp")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        records = parse(stream_lines(spark, str(source.folder), max_files_per_trigger=1), MILLISECOND_SUMMARY)
        start_parquet_sink(daily_counts(records), path, checkpoint, interval_seconds=None).awaitTermination(120)
        got = rows(spark.read.parquet(path))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == [("2024-01-01", "a", 2), ("2024-01-01", "b", 1), ("2024-01-02", "a", 2), ("2024-01-02", "b", 1)]


def test_jobs(spark, source, capsys):
    source.add([transaction("2024-01-01 10:00:00 000", "a"), transaction("2024-01-01 11:00:00 000", "a")])
    source.add([transaction("2024-01-01 12:00:00 000", "a"), "x|y"])
    ledger_path, checkpoint = fresh_dir(spark, "ledger"), fresh_dir(spark, "cp")
    lines = stream_lines(spark, str(source.folder), max_files_per_trigger=1)
    for _ in range(2):
        jobs.keep_summary(lines, ledger_path, checkpoint, interval_seconds=None, compact_every=1).awaitTermination(120)
    ledger = CountLedger.for_spec(spark, ledger_path, DAILY_SUMMARY)
    assert rows(ledger.summary()) == [("2024-01-01", "a", "3")]
    assert [(part.first, part.last) for part in ledger.batches.live()] == [(0, 1)]

    seen = []
    jobs.show_batch_counts(
        lines, interval_seconds=None, show=lambda counts, batch_id: seen.append((batch_id, rows(counts)))
    ).awaitTermination(120)
    assert seen == [(0, [("2024-01-01", "a", 2)]), (1, [("2024-01-01", "a", 1)])]

    path = fresh_dir(spark, "records")
    for query in jobs.store_and_show_records(lines, path, fresh_dir(spark, "cp"), interval_seconds=None):
        query.awaitTermination(120)
    assert spark.read.parquet(path).count() == 3
    assert "batch 1" in capsys.readouterr().out
