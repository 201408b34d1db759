"""Records that a source hands out twice, told by their id."""

from __future__ import annotations

from pyspark.sql import DataFrame

from logtally.streaming.watermark import event_time


def without_redelivered(records: DataFrame, delay: str, key: str = "id") -> DataFrame:
    """Records whose id has not come within ``delay`` of event time; a second delivery must be no later than that.

    Needs ``time_stamp`` among the records; the column ``event_time`` is added and carries the watermark. The state holds the
    ids of the last ``delay``, not all there ever were. A record whose time cannot be read has no place in time and is left
    out, as is one from behind the watermark; ``BatchMetrics`` reports both, and how many records were dropped as repeated.
    """
    return event_time(records).withWatermark("event_time", delay).dropDuplicatesWithinWatermark([key])
