"""The cumulative summary as per-batch counts that are added up when they are read.

Folding a batch writes that batch's counts, as a partition of its own, and nothing else. Its cost does not depend on how much
has piled up, and writing the same batch again replaces it instead of adding to it. Totals are ``groupBy().sum()`` over what is
there; a merge replaces many batches by their sum, ordered by group so that a filter on a day skips files and row groups.

``ledger.json`` holds the ledger's own id, its columns and the whole spec they come from, so that nobody reads or adds what was
parsed, filtered or grouped in another way.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import LongType, StringType, StructField, StructType

from logtally.functions.counts import as_text, strict_count
from logtally.operators.batches import BatchTable, Part
from logtally.operators.summary import add_up
from logtally.spec import SummarySpec
from logtally.storage import Files


class CountLedger:
    """Exactly-once totals per group, whoever replays what."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        keys: Sequence[str],
        count_column: str = "count",
        spec: SummarySpec | None = None,
    ) -> None:
        if not keys:
            raise ValueError("a ledger needs group columns")
        self.spark = spark
        self.path = path.rstrip("/")
        self.keys = tuple(keys)
        self.count_column = count_column
        self.spec = spec
        self.files = Files(spark, self.path)
        self.batches = BatchTable(spark, f"{self.path}/batches", self.counts_schema)

    @classmethod
    def for_spec(cls, spark: SparkSession, path: str, spec: SummarySpec) -> CountLedger:
        return cls(spark, path, spec.group_by, spec.count_column, spec)

    @property
    def counts_schema(self) -> StructType:
        keys = [StructField(key, StringType(), True) for key in self.keys]
        return StructType([*keys, StructField(self.count_column, LongType(), True)])

    # Writing

    def write_batch(self, counts: DataFrame, run_id: str, batch_id: int, *, replace: bool = True) -> bool:
        """Store one batch's counts under its id, replacing an earlier attempt.

        A batch that a merge has already taken in is left alone and reported as ``False``. So is one that is there, with
        ``replace=False``: where a replay brings the same counts, readers then never miss them in between.
        """
        self.claim()
        own = Part(run_id, batch_id, batch_id)
        there = [part for part in self.batches.parts() if part.spans(own) or part == own]
        if any(part != own for part in there) or (there and not replace):
            return False
        # A count that is no number must fail here and not become a total that is too low.
        columns = [*self.keys, strict_count(self.count_column).alias(self.count_column)]
        self.batches.write(counts.select(*columns), own)
        return True

    # Reading

    def batch_counts(self) -> DataFrame:
        """The unmerged batches as stored: ``run_id, batch_id, group..., count``."""
        self._check()
        single = [part for part in self.batches.live() if part.first == part.last]
        return self.batches.read(single).select("run_id", "batch_id", *self.keys, self.count_column)

    def totals(self) -> DataFrame:
        """``group..., count`` with BIGINT counts. A filter on group columns reaches the parquet scan."""
        self._check()
        live = self.batches.live()
        counts = self.batches.read(live).select(*self.keys, self.count_column)
        # A merged partition has one row per group already.
        return counts if len(live) == 1 and live[0].first < live[0].last else add_up(counts, self.keys, self.count_column)

    def summary(self) -> DataFrame:
        """The totals as the summary table shows them: all text."""
        return self.totals().withColumn(self.count_column, as_text(self.count_column))

    def runs(self) -> set[str]:
        """Every run that has put anything in here."""
        return {part.run_id for part in self.batches.parts()}

    def last_batch(self, run_id: str) -> int | None:
        return max((part.last for part in self.batches.parts() if part.run_id == run_id), default=None)

    # Upkeep

    def compact(self, full: bool = False, keep_seconds: float = 0) -> int:
        """Add up each run's younger batches into one partition; ``full`` takes in older sums, too. Returns how many are new.

        Batches that were added up ``keep_seconds`` ago are removed: readers of that time must be done by now. One process at
        a time may do this for a ledger; the summary stream does it between two of its batches.
        """
        self._check()
        return len(self.batches.merge(self._summed, self.keys, full=full, keep_seconds=keep_seconds))

    def reset(self) -> None:
        """Forget everything, as truncating the table would. A checkpoint that has filled it is refused from now on."""
        self.files.delete(self.path)

    def _summed(self, rows: DataFrame) -> DataFrame:
        """Sums first, so that what is put in order, and read twice for it, is one row per group and not per batch."""
        return add_up(rows, self.keys, self.count_column)

    # What it is

    def claim(self) -> str:
        """This ledger's id; a new ledger gets one, with the columns and the spec it is for."""
        path = f"{self.path}/ledger.json"
        if not self.files.exists(path):
            try:
                self.files.publish(path, json.dumps({"id": uuid.uuid4().hex, **self._meaning()}))
            except FileExistsError:
                pass  # Another writer was first; what it wrote is compared below.
        self._check()
        return json.loads(self.files.read(path))["id"]

    def _meaning(self) -> dict:
        given = {"keys": self.keys, "count": self.count_column, "spec": self.spec and self.spec.meaning()}
        return json.loads(json.dumps(given))

    def _check(self) -> None:
        """Refuse a ledger that was written with other columns."""
        path = f"{self.path}/ledger.json"
        if self.files.exists(path):
            found = json.loads(self.files.read(path))
            found.pop("id")
            if found != self._meaning():
                raise ValueError(f"{self.path} holds {found}, not {self._meaning()}")
