"""How batches went: one row per batch, none left out."""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

BATCH_SCHEMA = (
    "query string, batch_id long, input_rows long, millis long, null_lines long, unreadable_times long, repeated_rows long, late_rows long"
)


class BatchMetrics(StreamingQueryListener):
    """Listens to a session's queries; Spark itself keeps only the last hundred updates of each.

    Counters come from ``observe``: ``null_lines`` and ``unreadable_times`` are added up over whatever a query observes.
    ``repeated_rows`` is what state operators dropped as seen before, ``late_rows`` what they dropped behind the watermark.
    ``on_batch`` is called with each row as it comes in, in the listener's own thread.
    """

    def __init__(self, spark: SparkSession, on_batch: Callable[[tuple], None] | None = None) -> None:
        self._spark = spark
        self._on_batch = on_batch
        self._rows: list[tuple] = []
        self._groups: list[tuple[str, int, int, int]] = []
        self._ended: set[str] = set()
        self._change = threading.Condition()

    def __enter__(self) -> BatchMetrics:
        self._spark.streams.addListener(self)
        return self

    def __exit__(self, *_: object) -> None:
        self._spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:  # noqa: ANN001, N802
        pass

    def onQueryIdle(self, event) -> None:  # noqa: ANN001, N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: ANN001, N802
        p = event.progress
        observed = [row.asDict() for row in p.observedMetrics.values()]
        counted = [sum(o.get(name) or 0 for o in observed) for name in ("null_lines", "unreadable_times")]
        late = sum(s.numRowsDroppedByWatermark for s in p.stateOperators)
        repeated = sum((s.customMetrics or {}).get("numDroppedDuplicateRows", 0) for s in p.stateOperators)
        row = (str(p.id), p.batchId, p.numInputRows, p.batchDuration, *counted, repeated, late)
        with self._change:
            self._rows.append(row)
            self._groups.append((str(p.runId), p.batchId, sum(s.numRowsTotal for s in p.stateOperators), sum(s.numRowsUpdated for s in p.stateOperators)))
        if self._on_batch:
            self._on_batch(row)

    def onQueryTerminated(self, event) -> None:  # noqa: ANN001, N802
        with self._change:
            self._ended.add(str(event.runId))
            self._change.notify_all()

    def rows(self, query: StreamingQuery, timeout_seconds: float = 60) -> list[tuple]:
        """The rows of a query that has ended, once its last event is in; events come a little later than the end."""
        with self._change:
            if not self._change.wait_for(lambda: str(query.runId) in self._ended, timeout_seconds):
                raise TimeoutError(f"no end of query {query.id} within {timeout_seconds} s")
            return [row for row in self._rows if row[0] == str(query.id)]

    def state_rows(self, query: StreamingQuery) -> list[tuple[int, int, int]]:
        """Per batch of this start of a query: its id, the rows of state behind it, and those that it has changed."""
        self.rows(query)
        return [tuple(row) for run, *row in self._groups if run == str(query.runId)]

    def table(self, query: StreamingQuery) -> DataFrame:
        return self._spark.createDataFrame(self.rows(query), BATCH_SCHEMA)


def batch_timings(query: StreamingQuery) -> list[dict]:
    """A look at the last batches that Spark keeps (``spark.sql.streaming.numRecentProgressUpdates``): id, input rows,
    milliseconds, and the counters attached with ``observe``. For all batches use ``BatchMetrics``."""
    return [
        {
            "batch_id": progress.batchId,
            "input_rows": progress.numInputRows,
            "millis": progress.batchDuration,
            "observed": {name: row.asDict() for name, row in progress.observedMetrics.items()},
        }
        for progress in query.recentProgress
    ]
