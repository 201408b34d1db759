"""Runs over what is available whose batch size follows the time that batches take."""

from __future__ import annotations

from collections.abc import Callable
from statistics import median

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from logtally.streaming.progress import BatchMetrics
from logtally.streaming.starting import StopRequest


class Pace:
    """A byte limit for micro-batches that aims at ``target_seconds`` for each, between ``least`` and ``most`` bytes.

    After a run the limit goes by the middle one of its batch times, at most to double or half: time that does not depend
    on the batch's size, as that of a start, then does no harm.
    """

    def __init__(self, target_seconds: float, least: int, most: int, limit: int | None = None) -> None:
        if not 0 < least <= most or target_seconds <= 0:
            raise ValueError(f"need 0 < least <= most and a target above 0, got {least}, {most}, {target_seconds}")
        self.target_seconds = target_seconds
        self.least, self.most = least, most
        self.limit = min(max(limit or least, least), most)

    def learn(self, seconds: list[float]) -> int:
        """The limit for the next run, from the times of the last run's batches; without batches it stays."""
        if seconds:
            step = min(2.0, max(0.5, self.target_seconds / max(median(seconds), 1e-3)))
            self.limit = min(max(int(self.limit * step), self.least), self.most)
        return self.limit

    def far_above(self, seconds: float) -> bool:
        """Whether a batch took so long that the run should not go on with this limit."""
        return seconds > 2 * self.target_seconds and self.limit > self.least


def run_paced(spark: SparkSession, pace: Pace, start_run: Callable[[int, StopRequest], StreamingQuery]) -> list[tuple[int, int, float]]:
    """Work off what is available; returns (batch, input rows, seconds) of its batches and sets the pace's next limit.

    ``start_run`` starts the stream with this many bytes per trigger, without an interval, and with this stop request. Each
    call goes on where the last one was. A run whose batches take far too long is stopped between two of them and taken up
    again with a smaller limit at once.
    """
    done: list[tuple[int, int, float]] = []
    while True:
        stop = StopRequest()

        def watch(row: tuple, stop: StopRequest = stop) -> None:
            if row[2] and pace.far_above(row[3] / 1000):
                stop.ask()

        with BatchMetrics(spark, watch) as metrics:
            query = start_run(pace.limit, stop)
            stop.wait()
            batches = [(batch, rows, millis / 1000) for _, batch, rows, millis, *_ in metrics.rows(query) if rows]
        done += batches
        pace.learn([seconds for *_, seconds in batches])
        if not stop.asked:
            return done
