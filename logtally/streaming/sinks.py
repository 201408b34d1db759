"""Streams of records or raw lines to parquet, to several sinks at once, and a look at them on the console."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.storagelevel import StorageLevel

from logtally.streaming.starting import INTERVAL_SECONDS, StopRequest, start


def start_parquet_sink(
    df: DataFrame,
    path: str,
    checkpoint: str,
    *,
    interval_seconds: float | None = INTERVAL_SECONDS,
    pool: str | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Append to parquet files. Readers go by the sink's commit log, so a file counts once or not at all."""
    writer = df.writeStream.format("parquet").outputMode("append").option("path", path)
    return start(writer, checkpoint=checkpoint, interval_seconds=interval_seconds, pool=pool, name=name)


def start_archive(
    lines: DataFrame,
    path: str,
    checkpoint: str,
    *,
    interval_seconds: float | None = INTERVAL_SECONDS,
    pool: str | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Keep the raw lines, as they came, in a one-column table ``line``."""
    archived = lines.where(F.col("value").isNotNull()).select(F.col("value").alias("line"))
    return start_parquet_sink(
        archived, path, checkpoint, interval_seconds=interval_seconds, pool=pool, name=name
    )


def start_preview(
    df: DataFrame,
    *,
    rows: int = 20,
    show: Callable[[DataFrame, int], None] | None = None,
    checkpoint: str | None = None,
    interval_seconds: float | None = INTERVAL_SECONDS,
    pool: str | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Print the first rows of each batch.

    Spark's console sink brings whole batches to the driver before it prints twenty rows; this asks for the rows it
    prints and no more.
    """

    def print_rows(batch: DataFrame, batch_id: int) -> None:
        print(f"batch {batch_id}")
        batch.show(rows, truncate=False)

    writer = df.writeStream.foreachBatch(show or print_rows)
    return start(writer, checkpoint=checkpoint, interval_seconds=interval_seconds, pool=pool, name=name)


def start_console(
    df: DataFrame,
    *,
    rows: int = 20,
    truncate: bool = False,
    output_mode: str = "append",
    checkpoint: str | None = None,
    interval_seconds: float | None = INTERVAL_SECONDS,
    pool: str | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Spark's console sink: each batch with its number, its first rows as a table.

    It brings whole batches to the driver before it prints; ``start_preview`` is for batches of any size.
    """
    writer = df.writeStream.format("console").outputMode(output_mode).option("numRows", rows).option("truncate", truncate)
    return start(writer, checkpoint=checkpoint, interval_seconds=interval_seconds, pool=pool, name=name)


def start_fan_out(
    df: DataFrame,
    sinks: Sequence[Callable[[DataFrame, int], None]],
    checkpoint: str,
    *,
    interval_seconds: float | None = INTERVAL_SECONDS,
    stop: StopRequest | None = None,
    pool: str | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Give each batch to several sinks, one after the other, and read and parse it only once.

    The batch is kept while they are at work, in memory or else on the executors' disks; of what an executor takes with it,
    Spark reads that part again. A sink gets the batch and its id; as a batch is repeated for all of them when one has
    failed, each must take a second writing of the same id as the first.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for sink in sinks:
                sink(batch, batch_id)
        finally:
            batch.unpersist()

    writer = df.writeStream.foreachBatch(stop.pausing(each) if stop else each)
    query = start(writer, checkpoint=checkpoint, interval_seconds=interval_seconds, pool=pool, name=name)
    return stop.attach(query) if stop else query
