"""A driver that is killed in the middle of a batch, for real, and a new one that goes on."""

from __future__ import annotations

import os
import signal
import subprocess
import sys
import time

import pytest

from logtally.operators import CountLedger, summarise
from logtally.plans import DAILY_SUMMARY, TRANSACTION_FIELDS
from logtally.sources import read_lines, stream_lines
from logtally.storage import fresh_dir
from logtally.streaming import start_summary

from tests.conftest import ROOT, rows

CHILD = """
import os, signal, sys
from pyspark.sql import SparkSession
from logtally.operators import CountLedger
from logtally.plans import DAILY_SUMMARY
from logtally.sources import stream_lines
from logtally.streaming import start_summary

source, path, checkpoint, moment = sys.argv[1:]


class Doomed(CountLedger):
    def write_batch(self, counts, run_id, batch_id, **options):
        if batch_id == 2 and moment == "before":
            os.kill(os.getpid(), signal.SIGKILL)
        written = super().write_batch(counts, run_id, batch_id, **options)
        if batch_id == 2:
            os.kill(os.getpid(), signal.SIGKILL)
        return written


spark = SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "2").getOrCreate()
lines = stream_lines(spark, source, max_files_per_trigger=1)
ledger = Doomed.for_spec(spark, path, DAILY_SUMMARY)
start_summary(lines, DAILY_SUMMARY, ledger, checkpoint, interval_seconds=None, compact_every=2).awaitTermination()
"""


def line(day, app):
    given = {"time_stamp": f"2024-01-{day:02d} 10:00:00 000", "app_id": app}
    given.update(channel_type="sms", travel_direction="mo")
    return "|".join(given.get(name, "") for name in TRANSACTION_FIELDS)


@pytest.mark.parametrize("moment", ["before", "after"])
def test_a_killed_driver(spark, tmp_path, moment):
    for i in range(5):
        content = "".join(line(1 + j % 3, f"app{j % 4}") + "\n" for j in range(i, 40))
        (tmp_path / f"{i}.txt").write_text(content)
        os.utime(tmp_path / f"{i}.txt", (1_700_000_000 + i, 1_700_000_000 + i))
    path, checkpoint = fresh_dir(spark, "ledger"), fresh_dir(spark, "checkpoint")
    child = subprocess.run(
        [sys.executable, "-c", CHILD, str(tmp_path), path, checkpoint, moment],
        env={**os.environ, "PYTHONPATH": str(ROOT)},
        capture_output=True,
        timeout=300,
        check=False,
    )
    assert child.returncode == -signal.SIGKILL, child.stderr.decode()[-2000:]
    time.sleep(3)  # The child's JVM ends on its own once its Python side is gone.
    ledger = CountLedger.for_spec(spark, path, DAILY_SUMMARY)
    assert ledger.totals().agg({"count": "sum"}).first()[0] == (79 if moment == "before" else 117)
    lines = stream_lines(spark, str(tmp_path), max_files_per_trigger=1)
    query = start_summary(lines, DAILY_SUMMARY, ledger, checkpoint, interval_seconds=None, compact_every=2)
    assert query.awaitTermination(120)
    assert rows(ledger.totals()) == rows(summarise(read_lines(spark, str(tmp_path)), DAILY_SUMMARY))
