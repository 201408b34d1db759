"""What the streaming queries share: trigger and scheduler pool."""

from __future__ import annotations

import signal
import threading
import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

# Fixed value: the micro-batch interval in seconds.
INTERVAL_SECONDS = 7


def start(
    writer: DataStreamWriter,
    *,
    checkpoint: str | None,
    interval_seconds: float | None = INTERVAL_SECONDS,
    pool: str | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Start a query. An interval of ``None`` processes what is available, in as many batches as the source's rate
    limit makes of it, and stops.

    A query keeps the scheduler pool that is set when it starts; with ``spark.scheduler.mode=FAIR`` queries in different
    pools share the executors.
    """
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    if interval_seconds is None:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=f"{round(interval_seconds * 1000)} milliseconds")
    context = writer._spark.sparkContext
    before = context.getLocalProperty("spark.scheduler.pool")
    if pool:
        context.setLocalProperty("spark.scheduler.pool", pool)
    try:
        return writer.start()
    finally:
        if pool:
            context.setLocalProperty("spark.scheduler.pool", before)


class StopRequest:
    """A stop that takes effect between two batches.

    A batch function that is wrapped with ``pausing`` does its work and then, if a stop was asked for, waits until the
    query is being stopped: the batch is whole and no other begins. The stop itself comes from a thread of its own. Spark
    may not get to note that last batch as done and then repeats it at the restart, which the ledger takes for what it is.
    """

    def __init__(self) -> None:
        self._asked = threading.Event()
        self._paused = threading.Event()
        self._query: StreamingQuery | None = None
        self._stopper: threading.Thread | None = None
        self._batches = 0
        self._attached = threading.Event()

    def ask(self, *_: object) -> None:
        """Ask for the stop; also fits as a signal handler."""
        self._asked.set()

    @property
    def asked(self) -> bool:
        return self._asked.is_set()

    def on_signal(self, number: int = signal.SIGTERM) -> None:
        """Ask for the stop when the process gets this signal. Only the main thread can set this up."""
        signal.signal(number, self.ask)

    def pausing(self, function: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
        def run(batch: DataFrame, batch_id: int) -> None:
            self._batches += 1
            function(batch, batch_id)
            if self._asked.is_set():
                self._paused.set()
                self._attached.wait()
                while self._query.isActive:
                    time.sleep(0.01)

        return run

    def attach(self, query: StreamingQuery) -> StreamingQuery:
        self._query = query
        self._attached.set()
        self._stopper = threading.Thread(target=self._stop_when_asked, daemon=True)
        self._stopper.start()
        return query

    def _stop_when_asked(self) -> None:
        query = self._query
        while not self._asked.wait(0.2):
            if not query.isActive:
                return
        quiet, seen = 0, self._batches
        while query.isActive and not self._paused.wait(0.1):
            # A query that waits for input has no batch function to stop at; one look may fall between two batches.
            quiet = quiet + 1 if self._batches == seen and not query.status["isTriggerActive"] else 0
            seen = self._batches
            if quiet >= 5:
                break
        query.stop()

    def wait(self, timeout_seconds: float | None = None) -> bool:
        """Until the query has ended; its failure is raised here."""
        ended = self._query.awaitTermination(timeout_seconds) if timeout_seconds else self._query.awaitTermination() or True
        if ended and self._stopper is not None:
            self._stopper.join(10)
        return bool(ended)
