"""Counts that Spark itself keeps, in a stream's state, and what is done with them.

A stateful query keeps one row per group in its state store. It is saved with the checkpoint, batch by batch: a restart loads
the state of the last finished batch, so a replayed batch is added to what stood before it and never twice. With RocksDB the
state lives on the executors' disks rather than in memory, and with a changelog a batch saves what it has changed, not all.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from logtally.functions.counts import as_text
from logtally.operators.batches import BatchTable, Part
from logtally.operators.records import count_lines, keep, parse
from logtally.operators.running import RunningCounts
from logtally.operators.summary import count_groups
from logtally.spec import SummarySpec
from logtally.streaming.starting import INTERVAL_SECONDS, StopRequest, start

# Spark's own settings for state in RocksDB, saved as changes.
ROCKSDB: Mapping[str, str] = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def settings(spark: SparkSession, given: Mapping[str, str]) -> Iterator[None]:
    """Session settings for queries that start in here: a query keeps those that it was started with."""
    before = {name: spark.conf.get(name, None) for name in given}
    try:
        for name, value in given.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def start_running_count(
    records: DataFrame,
    counts: RunningCounts,
    checkpoint: str,
    *,
    interval_seconds: float | None = INTERVAL_SECONDS,
    compact_every: int | None = 90,
    stop: StopRequest | None = None,
    pool: str | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Count records per key over the whole stream, however late they come, and upsert the keys that a batch has changed.

    There is no window and no watermark, so nothing is ever dropped and the state has a row for each key there is.
    """
    running = records.groupBy(*counts.keys).count().withColumnRenamed("count", counts.count_column)

    def upsert(changed: DataFrame, batch_id: int) -> None:
        if not counts.upsert(changed, batch_id):
            _advance(changed)
        if compact_every and batch_id % compact_every == compact_every - 1:
            counts.compact(keep_seconds=600)

    writer = running.writeStream.outputMode("update").foreachBatch(stop.pausing(upsert) if stop else upsert)
    with settings(records.sparkSession, ROCKSDB):
        query = start(writer, checkpoint=checkpoint, interval_seconds=interval_seconds, pool=pool, name=name)
    return stop.attach(query) if stop else query


def start_state_summary(
    lines: DataFrame,
    spec: SummarySpec,
    checkpoint: str,
    *,
    interval_seconds: float | None = INTERVAL_SECONDS,
    stop: StopRequest | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Keep the cumulative summary in the query's state and nowhere else; ``state_totals`` reads it."""
    counted = count_groups(keep(parse(count_lines(lines), spec), spec.where), spec)
    writer = counted.writeStream.outputMode("update")
    writer = writer.foreachBatch(stop.pausing(_advance)) if stop else writer.format("noop")
    with settings(lines.sparkSession, ROCKSDB):
        query = start(writer, checkpoint=checkpoint, interval_seconds=interval_seconds, name=name)
    return stop.attach(query) if stop else query


def _advance(batch: DataFrame, batch_id: int | None = None) -> None:
    """Run a batch for its state alone: one whose rows nobody asks for would leave the state as it was."""
    batch.write.format("noop").mode("overwrite").save()


def state_totals(spark: SparkSession, checkpoint: str, spec: SummarySpec, batch_id: int | None = None) -> DataFrame:
    """``group..., count`` as BIGINTs, from the state behind the last finished batch, or behind an earlier one."""
    reader = spark.read.format("statestore")
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    state = reader.load(checkpoint)
    return state.select(*[state["key"][key].alias(key) for key in spec.group_by], state["value"]["count"].alias(spec.count_column))


def state_summary(spark: SparkSession, checkpoint: str, spec: SummarySpec) -> DataFrame:
    """The totals as the summary table shows them: all text."""
    return state_totals(spark, checkpoint, spec).withColumn(spec.count_column, as_text(spec.count_column))


def start_stored_batches(
    rows: DataFrame,
    table: BatchTable,
    checkpoint: str,
    *,
    interval_seconds: float | None = INTERVAL_SECONDS,
    stop: StopRequest | None = None,
    pool: str | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Append the rows of a stateful query, each batch as a partition of its own, with the state in RocksDB.

    A batch that is repeated after a restart replaces its first attempt. ``stop`` ends the query between two batches.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        table.write(batch, Part("stream", batch_id, batch_id))

    writer = rows.writeStream.outputMode("append").foreachBatch(stop.pausing(store) if stop else store)
    with settings(rows.sparkSession, ROCKSDB):
        query = start(writer, checkpoint=checkpoint, interval_seconds=interval_seconds, pool=pool, name=name)
    return stop.attach(query) if stop else query


def stored_rows(table: BatchTable) -> DataFrame:
    """What ``start_stored_batches`` has put there."""
    return table.read(table.live()).select(*table.content.fieldNames())
