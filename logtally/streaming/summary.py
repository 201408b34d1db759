"""The summary stream: every micro-batch is counted and folded into the ledger exactly once."""

from __future__ import annotations

import json
import logging
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from logtally.operators.ledger import CountLedger
from logtally.operators.records import count_lines, keep, parse
from logtally.operators.summary import count_groups
from logtally.spec import SummarySpec
from logtally.storage import Files
from logtally.streaming.starting import INTERVAL_SECONDS, StopRequest, start

# About ten minutes of batches at the default interval.
COMPACT_EVERY = 90
KEEP_SECONDS = 600

_log = logging.getLogger(__name__)


class LedgerInUse(RuntimeError):
    """Ledger and checkpoint don't belong together: one of them has batches that the other lacks."""


def run_of(spark: SparkSession, checkpoint: str) -> dict[str, str] | None:
    """The run that a checkpoint stands for, and its ledger: a note of ours, which is lost where the checkpoint is."""
    path = f"{checkpoint.rstrip('/')}/logtally-run.json"
    files = Files(spark, checkpoint)
    return json.loads(files.read(path)) if files.exists(path) else None


def bound_run(ledger: CountLedger, checkpoint: str, add_run: bool = False) -> str:
    """The run id of this checkpoint, which belongs to this ledger from its first start on."""
    run, own = run_of(ledger.spark, checkpoint), ledger.claim()
    if run is None:
        if (others := ledger.runs()) and not add_run:
            raise LedgerInUse(
                f"{ledger.path} holds batches of {sorted(others)}; reset() it, or pass add_run=True if this input is new"
            )
        run = {"run": uuid.uuid4().hex, "ledger": own}
        Files(ledger.spark, checkpoint).publish(f"{checkpoint.rstrip('/')}/logtally-run.json", json.dumps(run))
    if run["ledger"] != own:
        raise LedgerInUse(f"{ledger.path} lacks the batches of {checkpoint}; start again with a new checkpoint")
    return run["run"]


def start_summary(
    lines: DataFrame,
    spec: SummarySpec,
    ledger: CountLedger,
    checkpoint: str,
    *,
    interval_seconds: float | None = INTERVAL_SECONDS,
    compact_every: int | None = COMPACT_EVERY,
    add_run: bool = False,
    stop: StopRequest | None = None,
    pool: str | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Fold a stream of lines into ``ledger``; the same call starts it, and resumes it after a crash.

    Batches are filed under the checkpoint's run id and their batch id. A batch that is replayed after a failure is written
    only if its first attempt did not finish. A new checkpoint would read old input again, and count it again; it is
    refused where the ledger holds other runs, unless ``add_run`` says that its input is new. A checkpoint whose ledger was
    emptied would go on behind the batches that are gone; it is refused, too.

    ``compact_every`` merges the ledger after each so many batches, between two batches of this query; a merge that fails
    is logged and left to the next one. What a merge has made redundant is removed by a later one, ``KEEP_SECONDS`` after it
    at the least, by when the readers of the old files should be done. ``stop`` ends the query between two batches.
    """
    run_id = bound_run(ledger, checkpoint, add_run)

    def fold(batch: DataFrame, batch_id: int) -> None:
        ledger.write_batch(count_groups(batch, spec), run_id, batch_id, replace=False)
        if compact_every and batch_id % compact_every == compact_every - 1:
            try:
                ledger.compact(keep_seconds=KEEP_SECONDS)
            except Exception:
                _log.exception("merging %s failed; the next merge will take in its batches", ledger.path)

    # The counter tells lines without a record from lines read. Parse and filter belong to the stream's own plan, so
    # that only matching records cross over into the batch function.
    matching = keep(parse(count_lines(lines), spec), spec.where).select(*spec.group_by)
    writer = matching.writeStream.foreachBatch(stop.pausing(fold) if stop else fold)
    query = start(writer, checkpoint=checkpoint, interval_seconds=interval_seconds, pool=pool, name=name)
    return stop.attach(query) if stop else query
