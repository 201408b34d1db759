"""The standing jobs: a source, a plan and a sink wired together. Each takes any stream of lines.

    spark = build_session("daily-summary", metastore_uri="thrift://...", fair_scheduling=True)
    lines = KafkaSource("broker:9092", "transactions").stream(spark)
    query = keep_summary(lines, "hdfs:///summary/ledger", "hdfs:///summary/checkpoint")
    query.awaitTermination()
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from logtally.operators.batches import BatchTable, Part
from logtally.operators.ledger import CountLedger
from logtally.operators.records import keep, parse
from logtally.operators.summary import count_groups
from logtally.functions.delimited import cut
from logtally.plans.transactions import DAILY_SUMMARY, sms_mo_records
from logtally.spec import SummarySpec
from logtally.streaming.sinks import start_fan_out, start_parquet_sink, start_preview
from logtally.streaming.starting import INTERVAL_SECONDS, StopRequest
from logtally.streaming.summary import COMPACT_EVERY, bound_run, start_summary


def keep_summary(
    lines: DataFrame,
    ledger_path: str,
    checkpoint: str,
    spec: SummarySpec = DAILY_SUMMARY,
    *,
    interval_seconds: float | None = INTERVAL_SECONDS,
    compact_every: int | None = COMPACT_EVERY,
    stop: StopRequest | None = None,
) -> StreamingQuery:
    """Fold a stream into the cumulative summary; call it again with the same folders after a crash.

    ``stop.on_signal()`` lets the process end between two batches when it is told to.
    """
    ledger = CountLedger.for_spec(lines.sparkSession, ledger_path, spec)
    return start_summary(
        lines, spec, ledger, checkpoint, interval_seconds=interval_seconds, compact_every=compact_every, stop=stop
    )


def show_batch_counts(
    lines: DataFrame,
    spec: SummarySpec = DAILY_SUMMARY,
    *,
    rows: int = 20,
    checkpoint: str | None = None,
    interval_seconds: float | None = INTERVAL_SECONDS,
    show: Callable[[DataFrame, int], None] | None = None,
) -> StreamingQuery:
    """Print the counts of each batch by itself; nothing is kept. With a checkpoint it goes on where it was."""

    def print_counts(batch: DataFrame, batch_id: int) -> None:
        counts = count_groups(batch, spec)
        if show:
            show(counts, batch_id)
        else:
            counts.show(rows, truncate=False)

    matching = keep(parse(lines, spec), spec.where).select(*spec.group_by)
    return start_preview(matching, show=print_counts, checkpoint=checkpoint, interval_seconds=interval_seconds)


def store_and_show_records(
    lines: DataFrame,
    path: str,
    checkpoint: str,
    *,
    interval_seconds: float | None = INTERVAL_SECONDS,
    show: Callable[[DataFrame, int], None] | None = None,
    show_checkpoint: str | None = None,
    pools: tuple[str, str] = ("store", "show"),
) -> tuple[StreamingQuery, StreamingQuery]:
    """The filtered projection to parquet and, as a query of its own in another scheduler pool, to the console.

    Each query reads the source itself, so a slow or stopped one does not hold up the other.
    """
    records = sms_mo_records(lines)
    stored = start_parquet_sink(records, path, checkpoint, interval_seconds=interval_seconds, pool=pools[0])
    shown = start_preview(
        records, show=show, checkpoint=show_checkpoint, interval_seconds=interval_seconds, pool=pools[1]
    )
    return stored, shown


def store_and_count_records(
    lines: DataFrame,
    records: BatchTable,
    ledger: CountLedger,
    checkpoint: str,
    *,
    interval_seconds: float | None = INTERVAL_SECONDS,
    stop: StopRequest | None = None,
) -> StreamingQuery:
    """The filtered projection into a table of batches and its daily counts into a ledger, from one reading of the source.

    Both take a batch that is repeated as the one they have.
    """
    run_id = bound_run(ledger, checkpoint)
    fields = {field.name: field for field in DAILY_SUMMARY.fields}

    def store(batch: DataFrame, batch_id: int) -> None:
        records.write(batch, Part(run_id, batch_id, batch_id))

    def count(batch: DataFrame, batch_id: int) -> None:
        keys = batch.select(*[cut(batch[name], fields[name]).alias(name) for name in DAILY_SUMMARY.group_by])
        ledger.write_batch(count_groups(keys, DAILY_SUMMARY), run_id, batch_id, replace=False)

    return start_fan_out(sms_mo_records(lines), [store, count], checkpoint, interval_seconds=interval_seconds, stop=stop)
