"""Faults that the registered queries put in on purpose, and the checks that they have happened."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from logtally.operators import CountLedger
from logtally.operators.batches import BatchTable, Part
from logtally.streaming import StopRequest

INTERRUPTED = "interrupted on purpose"


class NotHappened(AssertionError):
    """A query that shows how a fault is borne did not meet the fault."""


def must(happened: bool, what: str) -> None:
    if not happened:
        raise NotHappened(what)


class WatchedLedger(CountLedger):
    """Notes which batches it was asked to write, and whether it did."""

    def write_batch(self, counts: DataFrame, run_id: str, batch_id: int, *, replace: bool = True) -> bool:
        written = super().write_batch(counts, run_id, batch_id, replace=replace)
        self.__dict__.setdefault("asked", []).append((batch_id, written))
        return written


class InterruptedLedger(CountLedger):
    """Dies after a batch is written and before Spark can note that it is done; ``dies_in`` says in which one."""

    dies_in = 1

    def write_batch(self, counts: DataFrame, run_id: str, batch_id: int, *, replace: bool = True) -> bool:
        written = super().write_batch(counts, run_id, batch_id, replace=replace)
        if batch_id == self.dies_in:
            raise RuntimeError(INTERRUPTED)
        return written


class StoppingTable(BatchTable):
    """Asks for a stop once its second batch is written."""

    stop: StopRequest | None = None

    def write(self, rows: DataFrame, part: Part, order: Sequence[str] = ()) -> None:
        super().write(rows, part, order)
        if self.stop and part.last == 1:
            self.stop.ask()
