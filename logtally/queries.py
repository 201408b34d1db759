"""The package's queries over the given ``events`` table, each with the SQL that must give the same rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from logtally.faults import INTERRUPTED, InterruptedLedger, StoppingTable, WatchedLedger, must
from logtally.fixtures import event_lines, stage_batches, stage_part, stage_slices
from logtally.functions import create_parse_function
from logtally.functions.delimited import decode_value
from logtally.operators import (
    CountLedger,
    RunningCounts,
    SummaryTable,
    append_all,
    keep,
    parse,
    pick,
    recount,
    summarise,
    summarise_sql,
)
from logtally.plans import (
    DAILY_SUMMARY,
    MILLISECOND_SUMMARY,
    TRANSACTION_FIELDS,
    full_records,
    record_spec,
    sms_mo_records,
)
from logtally.operators.batches import BatchTable
from logtally.operators.summary import count_groups
from logtally.plans.jobs import show_batch_counts, store_and_count_records, store_and_show_records
from logtally.sources import read_lines, starting_point, stream_lines
from logtally.storage import Files, fresh_dir
from logtally.streaming import (
    BatchMetrics,
    Pace,
    StopRequest,
    daily_counts,
    run_paced,
    start_archive,
    start_parquet_sink,
    start_running_count,
    start_state_summary,
    start_stored_batches,
    start_summary,
    stored_rows,
    without_redelivered,
)
from logtally.streaming import state_summary as read_state_summary
from logtally.streaming.summary import LedgerInUse

BATCHES = 4

#: Bytes that a micro-batch of the file streams takes, whatever there is in all. A file is taken whole.
BATCH_BYTES = 64 << 20

#: How late a record may be in the watermark query: longer than one of its slices of time.
WATERMARK_DAYS = 10


def _events_path(sf_dir: str) -> str:
    return f"{sf_dir}/events.parquet"


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_lines(spark.read.parquet(_events_path(sf_dir))).select("value")


def _staged_lines(spark: SparkSession, sf_dir: str) -> str:
    return stage_batches(spark, _events_path(sf_dir), fresh_dir(spark, "lines"), BATCHES)


def _line_stream(spark: SparkSession, sf_dir: str, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    return stream_lines(spark, _staged_lines(spark, sf_dir), max_bytes_per_trigger=batch_bytes)


def _file_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file per micro-batch, so that there are several however little there is."""
    return stream_lines(spark, _staged_lines(spark, sf_dir), max_files_per_trigger=1)


def _ledger(spark: SparkSession) -> CountLedger:
    return CountLedger.for_spec(spark, fresh_dir(spark, "ledger"), DAILY_SUMMARY)


def _finish(query: StreamingQuery) -> None:
    """Wait for a query over available input; its failure is raised here."""
    query.awaitTermination()


def _append_staged_batches(spark: SparkSession, sf_dir: str, ledger: CountLedger, ids: range = range(BATCHES)) -> None:
    folder = _staged_lines(spark, sf_dir)
    for batch_id in ids:
        batch = read_lines(spark, f"{folder}/batch={batch_id}")
        ledger.write_batch(summarise(batch, DAILY_SUMMARY), "backfill", batch_id)


def _view_name(label: str) -> str:
    return f"logtally_{label}_{uuid.uuid4().hex}"


def _batch_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts per batch and group, the batches being those that the staged lines have."""
    lines = event_lines(spark.read.parquet(_events_path(sf_dir)))
    records = lines.select(F.coalesce(F.pmod("event_id", F.lit(BATCHES)), F.lit(0)).alias("batch"), "value")
    batches = [
        summarise(records.where(F.col("batch") == i).select("value"), DAILY_SUMMARY).withColumn("batch", F.lit(i))
        for i in range(BATCHES)
    ]
    return reduce(DataFrame.unionByName, batches)


def _new_table(spark: SparkSession) -> SummaryTable:
    root = fresh_dir(spark, "daily_summary")
    table = SummaryTable(spark, DAILY_SUMMARY, root, root.rsplit("/", 1)[1].replace("-", "_"))
    table.create()
    return table


# Parsing, projecting, filtering


def parse_delimited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Record values as bytes, as Kafka delivers them, to fields; field 60 is beyond the end of every line."""
    records = _lines(spark, sf_dir).select(F.encode("value", "UTF-8").alias("value"))
    spec = record_spec("id", "time_stamp", "app_id", "channel_type", "travel_direction", "col_60")
    return parse(decode_value(records), spec)


def select_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse(_lines(spark, sf_dir), MILLISECOND_SUMMARY)


def field_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = record_spec("time_stamp", "app_id").with_substring("time_stamp", (0, 10), strict=True)
    return parse(_lines(spark, sf_dir), spec)


def full_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    return full_records(_lines(spark, sf_dir))


def filter_sms_mo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep(parse(_lines(spark, sf_dir), MILLISECOND_SUMMARY), MILLISECOND_SUMMARY.where)


def sms_mo_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sms_mo_records(_lines(spark, sf_dir))


# Counting


def batch_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summarise(_lines(spark, sf_dir), DAILY_SUMMARY)


def text_file_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summarise(read_lines(spark, _staged_lines(spark, sf_dir)), DAILY_SUMMARY)


def millisecond_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summarise(_lines(spark, sf_dir), MILLISECOND_SUMMARY)


def sql_over_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = _view_name("transactions")
    try:
        return summarise_sql(spark, _lines(spark, sf_dir), DAILY_SUMMARY, view)
    finally:
        spark.catalog.dropTempView(view)


# The cumulative table


def append_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = _ledger(spark)
    _append_staged_batches(spark, sf_dir, ledger)
    return ledger.batch_counts().drop("run_id")


def cumulative_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = _ledger(spark)
    _append_staged_batches(spark, sf_dir, ledger)
    return ledger.summary()


def compacted_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merge, add a batch, replay a merged one, merge again, read both parts."""
    ledger = _ledger(spark)
    _append_staged_batches(spark, sf_dir, ledger, range(BATCHES - 1))
    must(ledger.compact() == 1, "nothing was merged")
    _append_staged_batches(spark, sf_dir, ledger, range(BATCHES - 2, BATCHES))
    ledger.compact()
    return ledger.summary()


def recast_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Add up a table whose counts are text and whose groups have a row per batch."""
    table = _new_table(spark)
    table.insert(_batch_counts(spark, sf_dir))
    return recount(table.read(), DAILY_SUMMARY)


def summary_table_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Insert a first batch from a view, fold in the rest at once, select all."""
    counts = _batch_counts(spark, sf_dir)
    table = _new_table(spark)
    view = _view_name("first_batch")
    counts.where("batch = 0").createOrReplaceTempView(view)
    try:
        table.insert_from(view)
    finally:
        spark.catalog.dropTempView(view)
    table.fold(counts.where("batch > 0"))
    return spark.sql(f"SELECT * FROM {table.name}")


def published_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger's totals swapped into the catalog table, over what it held before."""
    ledger = _ledger(spark)
    table = _new_table(spark)
    _append_staged_batches(spark, sf_dir, ledger, range(BATCHES - 1))
    table.publish(ledger)
    _append_staged_batches(spark, sf_dir, ledger, range(BATCHES - 1, BATCHES))
    table.publish(ledger)
    return table.read()


def append_whole_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every column of a view, appended to a table that was just emptied; the counts are made once."""
    first, table = _new_table(spark), _new_table(spark)
    first.insert(summarise(_lines(spark, sf_dir), DAILY_SUMMARY))
    table.insert(first.read().limit(1))
    table.truncate()
    view = _view_name("whole")
    first.read().createOrReplaceTempView(view)
    try:
        append_all(spark, view, table.name)
    finally:
        spark.catalog.dropTempView(view)
    return table.read()


# Streams


def stream_file_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = _ledger(spark)
    checkpoint = fresh_dir(spark, "checkpoint")
    lines = _line_stream(spark, sf_dir)
    _finish(start_summary(lines, DAILY_SUMMARY, ledger, checkpoint, interval_seconds=None, compact_every=3))
    return ledger.summary()


def _die_in(spark: SparkSession, lines: DataFrame, ledger: CountLedger, checkpoint: str, batch: int) -> None:
    """Run a summary stream up to the moment when a batch is written and Spark has not noted it."""
    doomed = InterruptedLedger.for_spec(spark, ledger.path, DAILY_SUMMARY)
    doomed.dies_in = batch
    died = False
    try:
        _finish(start_summary(lines, DAILY_SUMMARY, doomed, checkpoint, interval_seconds=None))
    except Exception as failure:
        if INTERRUPTED not in str(failure):
            raise
        died = True
    must(died, "the stream was not interrupted")


def restart_from_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream that dies between writing a batch and committing it, and is started again."""
    ledger = _ledger(spark)
    checkpoint = fresh_dir(spark, "checkpoint")
    lines = _file_stream(spark, sf_dir)
    _die_in(spark, lines, ledger, checkpoint, 1)
    _finish(start_summary(lines, DAILY_SUMMARY, ledger, checkpoint, interval_seconds=None))
    return ledger.summary()


def replay_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream that dies with its last batch written and merged: Spark runs that batch again, and it is left alone."""
    ledger = WatchedLedger.for_spec(spark, fresh_dir(spark, "ledger"), DAILY_SUMMARY)
    checkpoint = fresh_dir(spark, "checkpoint")
    lines = _file_stream(spark, sf_dir)
    last = BATCHES - 1
    _die_in(spark, lines, ledger, checkpoint, last)
    must(ledger.compact() == 1, "nothing was merged")
    _finish(start_summary(lines, DAILY_SUMMARY, ledger, checkpoint, interval_seconds=None))
    must(ledger.asked.count((last, False)) == 1, f"batch {last} was not replayed: {ledger.asked}")
    return ledger.summary()


def recovered_after_reset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ledger that was emptied: its old checkpoint would skip what it has read and is refused, a new one reads all."""
    ledger = _ledger(spark)
    checkpoint = fresh_dir(spark, "checkpoint")
    lines = _file_stream(spark, sf_dir)
    _finish(start_summary(lines, DAILY_SUMMARY, ledger, checkpoint, interval_seconds=None))
    ledger.reset()
    refused = False
    try:
        start_summary(lines, DAILY_SUMMARY, ledger, checkpoint, interval_seconds=None).stop()
    except LedgerInUse:
        refused = True
    must(refused, "the old checkpoint was taken")
    _finish(start_summary(lines, DAILY_SUMMARY, ledger, fresh_dir(spark, "checkpoint"), interval_seconds=None))
    return ledger.summary()


def stopped_and_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A busy stream is asked to stop in its first batch, ends after it without a failure, and is taken up again."""
    ledger = WatchedLedger.for_spec(spark, fresh_dir(spark, "ledger"), DAILY_SUMMARY)
    checkpoint = fresh_dir(spark, "checkpoint")
    lines = _file_stream(spark, sf_dir)
    stop = StopRequest()
    stop.ask()
    start_summary(lines, DAILY_SUMMARY, ledger, checkpoint, interval_seconds=0, stop=stop)
    stop.wait()
    must(1 <= len(ledger.asked) <= 2, f"the stream did not stop between two batches: {ledger.asked}")
    _finish(start_summary(lines, DAILY_SUMMARY, ledger, checkpoint, interval_seconds=None))
    return ledger.summary()


def batch_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Input rows of all batches, as a listener has counted them."""
    with BatchMetrics(spark) as metrics:
        query = start_summary(
            _file_stream(spark, sf_dir), DAILY_SUMMARY, _ledger(spark), fresh_dir(spark, "checkpoint"), interval_seconds=None
        )
        _finish(query)
        table = metrics.table(query)
    return table.agg(F.sum("input_rows").alias("input_rows"), F.sum("null_lines").alias("null_lines"))


def rate_limited_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts per micro-batch added up: a limit on files per batch cuts the input, but loses none of it."""
    ledger = _ledger(spark)
    checkpoint = fresh_dir(spark, "checkpoint")
    with BatchMetrics(spark) as metrics:
        query = start_summary(_file_stream(spark, sf_dir), DAILY_SUMMARY, ledger, checkpoint, interval_seconds=None, compact_every=None)
        _finish(query)
        batches = [rows for _, _, rows, *_ in metrics.rows(query) if rows]
    must(len(batches) >= 2 and max(batches) < sum(batches), f"the limit did not cut the input: {batches}")
    return recount(ledger.batch_counts(), DAILY_SUMMARY)


def stream_parquet_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_dir(spark, "records")
    records = sms_mo_records(_line_stream(spark, sf_dir))
    _finish(start_parquet_sink(records, path, fresh_dir(spark, "checkpoint"), interval_seconds=None))
    return spark.read.parquet(path)


def fan_out_sinks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two queries over one stream definition, each with its own checkpoint and scheduler pool."""
    path = fresh_dir(spark, "records")
    shown_rows: dict[int, int] = {}
    with BatchMetrics(spark) as metrics:
        stored, shown = store_and_show_records(
            _file_stream(spark, sf_dir),
            path,
            fresh_dir(spark, "checkpoint"),
            show_checkpoint=fresh_dir(spark, "checkpoint"),
            interval_seconds=None,
            # Standard output is left alone here.
            show=lambda batch, batch_id: shown_rows.update({batch_id: len(batch.take(20))}),
        )
        _finish(stored)
        _finish(shown)
        kept = {batch_id for _, batch_id, rows, *_ in metrics.rows(stored) if rows}
    must(kept <= set(shown_rows) and any(shown_rows.values()), f"stored {sorted(kept)}, shown {sorted(shown_rows)}")
    return spark.read.parquet(path)


def previewed_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the preview of each batch's counts was offered, added up; it has a checkpoint and is started a second time."""
    offered: dict[int, int] = {}
    checkpoint = fresh_dir(spark, "checkpoint")

    def show(counts: DataFrame, batch_id: int) -> None:
        counts.take(20)
        offered[batch_id] = counts.agg(F.sum("count")).first()[0] or 0

    lines = _file_stream(spark, sf_dir)
    _finish(show_batch_counts(lines, checkpoint=checkpoint, interval_seconds=None, show=show))
    before = dict(offered)
    _finish(show_batch_counts(lines, checkpoint=checkpoint, interval_seconds=None, show=show))
    must(len(before) >= 2 and offered == before, f"the second start showed batches again: {before}, {offered}")
    return spark.createDataFrame([(sum(offered.values()),)], "records long")


def raw_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids read back from the archived lines."""
    path = fresh_dir(spark, "archive")
    _finish(start_archive(_line_stream(spark, sf_dir), path, fresh_dir(spark, "checkpoint"), interval_seconds=None))
    archived = spark.read.parquet(path).select(F.col("line").alias("value"))
    return pick(parse(archived, record_spec("id")), "id")


def watermarked_app_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed days only, from micro-batches in order of time; the delay covers the length of a slice."""
    folder, length = stage_slices(spark, _events_path(sf_dir), fresh_dir(spark, "slices"), BATCHES)
    must(length < WATERMARK_DAYS * 86_400, f"a slice of {length} s is longer than the delay")
    lines = stream_lines(spark, folder, max_files_per_trigger=1)
    path = fresh_dir(spark, "app_counts")
    records = keep(parse(lines, MILLISECOND_SUMMARY), MILLISECOND_SUMMARY.where)
    with BatchMetrics(spark) as metrics:
        counts = daily_counts(records, f"{WATERMARK_DAYS} days")
        query = start_parquet_sink(counts, path, fresh_dir(spark, "checkpoint"), interval_seconds=None)
        _finish(query)
        rows = metrics.rows(query)
    must(sum(1 for row in rows if row[2]) >= BATCHES, f"not {BATCHES} batches with data")
    must(not any(late for *_, late in rows), "rows came behind the watermark")
    return spark.read.parquet(path)


def stateful_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same counts from a query that is stopped between two batches and loads its state from the checkpoint."""
    folder, length = stage_slices(spark, _events_path(sf_dir), fresh_dir(spark, "slices"), BATCHES)
    must(length < WATERMARK_DAYS * 86_400, f"a slice of {length} s is longer than the delay")
    checkpoint = fresh_dir(spark, "checkpoint")
    table = StoppingTable(spark, fresh_dir(spark, "app_counts"), StructType.fromDDL("day string, app_id string, count long"))

    def run(stop: StopRequest) -> list[tuple[int, int, int]]:
        records = keep(parse(stream_lines(spark, folder, max_files_per_trigger=1), MILLISECOND_SUMMARY), MILLISECOND_SUMMARY.where)
        with BatchMetrics(spark) as metrics:
            counts = daily_counts(records, f"{WATERMARK_DAYS} days")
            query = start_stored_batches(counts, table, checkpoint, interval_seconds=None, stop=stop)
            stop.wait()
            return metrics.state_rows(query)

    table.stop = StopRequest()
    run(table.stop)
    stored = table.parts()
    must(2 <= len(stored) <= 3, f"the stream did not stop between two batches: {stored}")
    table.stop = None
    states = run(StopRequest())
    # State that a batch has not made itself was there before it.
    must(bool(states) and states[0][0] > 0 and states[0][1] > states[0][2], f"no state was loaded: {states}")
    return stored_rows(table)


def redelivered_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of a stream in which a slice of time is delivered twice."""
    folder, length = stage_slices(spark, _events_path(sf_dir), fresh_dir(spark, "slices"), BATCHES)
    must(length < WATERMARK_DAYS * 86_400, f"a slice of {length} s is longer than the delay")
    files = Files(spark, folder)
    # The second slice comes again behind it, in files of its own; the next one waits.
    read_lines(spark, f"{folder}/slice=1").write.text(f"{folder}/slice=1/again")
    then = files.modified_millis(f"{folder}/slice=2/{files.children(f'{folder}/slice=2')[-1]}")
    for name in files.children(f"{folder}/slice=1/again"):
        files.set_modified(f"{folder}/slice=1/again/{name}", then - 500)
    spec = record_spec("id", "time_stamp", "app_id", "channel_type", "travel_direction", where=MILLISECOND_SUMMARY.where)
    lines = stream_lines(spark, folder, max_files_per_trigger=1)
    records = without_redelivered(keep(parse(lines, spec), spec.where), f"{WATERMARK_DAYS} days")
    kept = BatchTable(spark, fresh_dir(spark, "records"), StructType.fromDDL("id string, time_stamp string, app_id string"))
    with BatchMetrics(spark) as metrics:
        query = start_stored_batches(records, kept, fresh_dir(spark, "checkpoint"), interval_seconds=None)
        _finish(query)
        rows = metrics.rows(query)
    must(sum(row[-2] for row in rows) > 0, "nothing was delivered twice")
    must(not any(row[-1] for row in rows), "rows came behind the watermark")
    return count_groups(stored_rows(kept).withColumn("time_stamp", F.substring("time_stamp", 1, 10)), DAILY_SUMMARY)


def running_app_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records per application since the stream began, those of the earliest days coming last."""
    folder, _ = stage_slices(spark, _events_path(sf_dir), fresh_dir(spark, "slices"), BATCHES)
    files = Files(spark, folder)
    newest = files.modified_millis(folder)
    for i in range(BATCHES):
        for name in files.children(f"{folder}/slice={i}"):
            files.set_modified(f"{folder}/slice={i}/{name}", newest - 1000 * i)
    records = keep(parse(stream_lines(spark, folder, max_files_per_trigger=1), MILLISECOND_SUMMARY), MILLISECOND_SUMMARY.where)
    counts = RunningCounts(spark, fresh_dir(spark, "app_counts"), ["app_id"])
    with BatchMetrics(spark) as metrics:
        query = start_running_count(records, counts, fresh_dir(spark, "checkpoint"), interval_seconds=None, compact_every=3)
        _finish(query)
        rows = metrics.rows(query)
    must(sum(1 for row in rows if row[2]) >= BATCHES, f"not {BATCHES} batches with data")
    return counts.current()


def state_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals that Spark keeps in the query's state, read from its checkpoint; the query is stopped once on the way."""
    checkpoint = fresh_dir(spark, "checkpoint")
    lines = _file_stream(spark, sf_dir)
    stop = StopRequest()
    stop.ask()
    start_state_summary(lines, DAILY_SUMMARY, checkpoint, interval_seconds=None, stop=stop)
    stop.wait()
    _finish(start_state_summary(lines, DAILY_SUMMARY, checkpoint, interval_seconds=None))
    return read_state_summary(spark, checkpoint, DAILY_SUMMARY)


def new_files_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that are there before the first start add nothing; those that come later count, also while it is down."""
    folder, checkpoint, ledger = fresh_dir(spark, "lines"), fresh_dir(spark, "checkpoint"), _ledger(spark)
    path = _events_path(sf_dir)
    must(stage_part(spark, path, folder, 0, BATCHES) > 0, "no files before the start")
    for part in range(1, BATCHES):
        since = starting_point(spark, checkpoint)
        lines = stream_lines(spark, folder, max_files_per_trigger=1, since_millis=since)
        _finish(start_summary(lines, DAILY_SUMMARY, ledger, checkpoint, interval_seconds=None))
        if part == 1:
            must(ledger.totals().isEmpty(), "files from before the start were counted")
        stage_part(spark, path, folder, part, BATCHES)
    lines = stream_lines(spark, folder, since_millis=starting_point(spark, checkpoint))
    _finish(start_summary(lines, DAILY_SUMMARY, ledger, checkpoint, interval_seconds=None))
    return ledger.summary()


def paced_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs whose byte limit goes by the time that batches take: far below the target, so it grows up to its cap."""
    folder, checkpoint, ledger = fresh_dir(spark, "lines"), fresh_dir(spark, "checkpoint"), _ledger(spark)
    path = _events_path(sf_dir)
    stage_part(spark, path, folder, 0, BATCHES, 8)
    files = Files(spark, folder)
    # A little more than a file, as those of later parts may be somewhat larger.
    one = max(files.size(f"{folder}/{name}") for name in files.children(folder) if name.startswith("part-")) * 11 // 10 + 1
    pace = Pace(3600, one, 3 * one)
    start = lambda limit, stop: start_summary(
        stream_lines(spark, folder, max_bytes_per_trigger=limit), DAILY_SUMMARY, ledger, checkpoint, interval_seconds=None, stop=stop
    )
    limits, most = [], []
    for part in range(1, BATCHES + 1):
        limits.append(pace.limit)
        most.append(max(rows for _, rows, _ in run_paced(spark, pace, start)))
        if part < BATCHES:
            stage_part(spark, path, folder, part, BATCHES, 8)
    must(limits[0] < limits[1] < limits[2] == limits[3] == 3 * one, f"the limit did not go up to its cap: {limits}")
    must(most[0] < most[1] < most[2], f"batches did not grow: {most}")
    return ledger.summary()


def fan_out_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One query stores the records and folds their counts; the source is read once for both."""
    ledger = _ledger(spark)
    spec = record_spec("id", "sp_id", "app_id", "time_stamp")
    records = BatchTable(spark, fresh_dir(spark, "records"), spec.record_schema())
    with BatchMetrics(spark) as metrics:
        query = store_and_count_records(
            _file_stream(spark, sf_dir), records, ledger, fresh_dir(spark, "checkpoint"), interval_seconds=None
        )
        _finish(query)
        read = sum(row[2] for row in metrics.rows(query))
    events = spark.read.parquet(_events_path(sf_dir)).count()
    must(read == events, f"{read} input rows for {events} lines")
    stored = stored_rows(records)
    counts = count_groups(stored.withColumn("time_stamp", F.substring("time_stamp", 1, 10)), DAILY_SUMMARY)
    must(counts.exceptAll(ledger.totals()).isEmpty() and ledger.totals().exceptAll(counts).isEmpty(), "the sinks differ")
    return stored


def sql_parse_function(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parse rules as a table function in SQL."""
    view, function = _view_name("lines"), _view_name("parse")
    _lines(spark, sf_dir).createOrReplaceTempView(view)
    create_parse_function(spark, MILLISECOND_SUMMARY, function)
    try:
        return spark.sql(f"SELECT p.* FROM {view} AS l, LATERAL {function}(l.value) AS p WHERE l.value IS NOT NULL")
    finally:
        spark.sql(f"DROP TEMPORARY FUNCTION {function}")
        spark.catalog.dropTempView(view)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    listed = [
        parse_delimited,
        select_fields,
        field_substring,
        full_record,
        filter_sms_mo,
        sms_mo_projection,
        batch_summary,
        text_file_summary,
        millisecond_summary,
        sql_over_view,
        append_batches,
        cumulative_summary,
        compacted_summary,
        recast_count,
        summary_table_read,
        published_table,
        append_whole_view,
        stream_file_summary,
        restart_from_checkpoint,
        replay_idempotent,
        recovered_after_reset,
        stopped_and_resumed,
        batch_metrics,
        rate_limited_stream,
        stream_parquet_sink,
        fan_out_sinks,
        previewed_batches,
        raw_archive,
        watermarked_app_count,
        stateful_restart,
        redelivered_records,
        running_app_count,
        state_summary,
        new_files_only,
        paced_stream,
        fan_out_once,
        sql_parse_function,
    ]
    return {query.__name__: query for query in listed}


# The same results as SQL over the base columns of ``events``; no line is built or parsed here.

_RECORDS = """
WITH m AS (
  SELECT event_id, ts,
         CAST(event_id AS VARCHAR) AS id,
         '' AS sp_id,
         strftime(ts, '%Y-%m-%d %H:%M:%S %g') AS time_stamp,
         strftime(ts, '%Y-%m-%d') AS day,
         'APP_' || lpad(CAST(user_id % 50 AS VARCHAR), 6, '0') AS app_id,
         CASE WHEN event_type IN ('click', 'view') THEN 'sms' ELSE 'ussd' END AS channel_type,
         CASE WHEN event_id % 2 = 0 THEN 'mo' ELSE 'mt' END AS travel_direction
  FROM events)
"""
_SMS_MO = "channel_type = 'sms' AND travel_direction = 'mo'"


def _full_record_sql() -> str:
    filled = {"id", "time_stamp", "app_id", "channel_type", "travel_direction"}
    last = TRANSACTION_FIELDS.index("travel_direction")
    columns = [
        name if name in filled else f"{chr(39) * 2 if i < last else chr(39) + ' ' + chr(39)} AS {name}"
        for i, name in enumerate(TRANSACTION_FIELDS)
    ]
    return f"{_RECORDS} SELECT {', '.join(columns)} FROM m"


def oracle_sql() -> dict[str, str]:
    counted = f"""{_RECORDS}
SELECT day AS time_stamp, app_id, count(*) AS "count" FROM m WHERE {_SMS_MO} GROUP BY day, app_id"""
    cumulative = f"""{_RECORDS}
SELECT day AS time_stamp, app_id, CAST(count(*) AS VARCHAR) AS "count" FROM m WHERE {_SMS_MO} GROUP BY day, app_id"""
    projected = f"{_RECORDS} SELECT id, sp_id, app_id, time_stamp FROM m WHERE {_SMS_MO}"
    fields = "time_stamp, app_id, channel_type, travel_direction"
    closed_days = f"""{_RECORDS},
kept AS (SELECT * FROM m WHERE {_SMS_MO}),
mark AS (SELECT date_trunc('millisecond', max(ts)) - INTERVAL {WATERMARK_DAYS} DAY AS closed_until FROM kept)
SELECT day, app_id, count(*) AS "count" FROM kept, mark
WHERE date_trunc('day', ts) + INTERVAL 1 DAY <= closed_until GROUP BY day, app_id"""
    return {
        "parse_delimited": f"{_RECORDS} SELECT id, {fields}, ' ' AS col_60 FROM m",
        "select_fields": f"{_RECORDS} SELECT {fields} FROM m",
        "field_substring": f"{_RECORDS} SELECT day AS time_stamp, app_id FROM m",
        "full_record": _full_record_sql(),
        "filter_sms_mo": f"{_RECORDS} SELECT {fields} FROM m WHERE {_SMS_MO}",
        "sms_mo_projection": projected,
        "batch_summary": counted,
        "text_file_summary": counted,
        "millisecond_summary": f"""{_RECORDS}
SELECT time_stamp, app_id, count(*) AS "count" FROM m WHERE {_SMS_MO} GROUP BY time_stamp, app_id""",
        "sql_over_view": counted,
        "append_batches": f"""{_RECORDS}
SELECT event_id % {BATCHES} AS batch_id, day AS time_stamp, app_id, count(*) AS "count"
FROM m WHERE {_SMS_MO} GROUP BY event_id % {BATCHES}, day, app_id""",
        "cumulative_summary": cumulative,
        "compacted_summary": cumulative,
        "recast_count": cumulative,
        "summary_table_read": cumulative,
        "published_table": cumulative,
        "append_whole_view": cumulative,
        "stream_file_summary": cumulative,
        "restart_from_checkpoint": cumulative,
        "replay_idempotent": cumulative,
        "rate_limited_stream": cumulative,
        "recovered_after_reset": cumulative,
        "stopped_and_resumed": cumulative,
        "batch_metrics": "SELECT count(*) AS input_rows, CAST(0 AS BIGINT) AS null_lines FROM events",
        "previewed_batches": f"{_RECORDS} SELECT count(*) AS records FROM m WHERE {_SMS_MO}",
        "stream_parquet_sink": projected,
        "fan_out_sinks": projected,
        "raw_archive": f"{_RECORDS} SELECT id FROM m",
        "watermarked_app_count": closed_days,
        "stateful_restart": closed_days,
        "redelivered_records": counted,
        "running_app_count": f"""{_RECORDS} SELECT app_id, count(*) AS "count" FROM m WHERE {_SMS_MO} GROUP BY app_id""",
        "state_summary": cumulative,
        "new_files_only": f"""{_RECORDS}
SELECT day AS time_stamp, app_id, CAST(count(*) AS VARCHAR) AS "count" FROM m
WHERE {_SMS_MO} AND event_id % {BATCHES} != 0 GROUP BY day, app_id""",
        "paced_stream": cumulative,
        "fan_out_once": projected,
        "sql_parse_function": f"{_RECORDS} SELECT {fields} FROM m",
    }
