"""Counts of closed days from a stream whose records may come late."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: how the record time is written, with a space before the milliseconds.
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss SSS"
SECONDS_PER_DAY = 86400


def event_time(records: DataFrame) -> DataFrame:
    """``time_stamp`` as a point in time in ``event_time``, null where it cannot be read; how often that is so is observed."""
    # Read as UTC, so that days begin at midnight as written, whatever zone the session has.
    read = F.try_to_timestamp(F.concat("time_stamp", F.lit("Z")), F.lit(TIME_FORMAT + "X"))
    timed = records.withColumn("event_time", read)
    return timed.observe("event_times", F.count_if(F.col("event_time").isNull()).alias("unreadable_times"))


def daily_counts(records: DataFrame, delay: str = "10 minutes", key: str = "app_id") -> DataFrame:
    """``(day, key, count)`` per day of event time, each day sent once the watermark has passed its end.

    A record whose day was sent already is dropped, so input must be in time order up to ``delay``. One whose time
    cannot be read is left out. ``BatchMetrics`` reports both numbers for each batch.
    """
    counted = (
        event_time(records)
        .withWatermark("event_time", delay)
        .groupBy(F.window("event_time", "1 day").alias("window"), key)
        .agg(F.count(F.lit(1)).alias("count"))
    )
    day = F.date_from_unix_date((F.unix_seconds("window.start") / SECONDS_PER_DAY).cast("int")).cast("string")
    return counted.select(day.alias("day"), key, "count")
