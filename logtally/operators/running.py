"""Running counts per key: the newest value of each key that a stream has sent, whatever it sent before.

A batch's changed keys are a partition of their own, by dynamic partition overwrite, so a replayed batch replaces itself. A
key's row in a later batch takes the place of its rows in earlier ones when the table is read; a merge does the same for good.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from logtally.operators.batches import BatchTable, Part

_RUN = "stream"


class RunningCounts:
    """The target of an update-mode stream of ``(key..., count)``; one stream, and one checkpoint, per folder."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], count_column: str = "count") -> None:
        if not keys:
            raise ValueError("running counts need key columns")
        self.keys = tuple(keys)
        self.count_column = count_column
        fields = [StructField(key, StringType()) for key in self.keys]
        self.batches = BatchTable(spark, path, StructType([*fields, StructField(count_column, LongType())]))

    def upsert(self, changed: DataFrame, batch_id: int) -> bool:
        """Put the changed keys in place; a batch that is part of a merge already is left alone, and reported as ``False``."""
        own = Part(_RUN, batch_id, batch_id)
        if any(part.spans(own) for part in self.batches.parts()):
            return False
        self.batches.write(changed, own)
        return True

    def current(self) -> DataFrame:
        """``key..., count``: one row per key."""
        return self._newest(self.batches.read(self.batches.live()))

    def updates(self) -> DataFrame:
        """``batch_id, key..., count``: what each batch that wasn't merged has changed."""
        single = [part for part in self.batches.live() if part.first == part.last]
        return self.batches.read(single).select("batch_id", *self.keys, self.count_column)

    def compact(self, full: bool = False, keep_seconds: float = 0) -> int:
        """Merge younger batches; see ``BatchTable.merge``."""
        return len(self.batches.merge(self._newest, self.keys, full=full, keep_seconds=keep_seconds))

    def _newest(self, rows: DataFrame) -> DataFrame:
        newest = F.max_by(F.col(self.count_column), F.col("batch_id")).alias(self.count_column)
        return rows.groupBy(*self.keys).agg(newest)
