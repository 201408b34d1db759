"""Transaction lines made from an ``events`` table, for trying the package out on given data.

``events(event_id, ts, user_id, event_type, ...)`` fills five of the sixty fields: id, time stamp, application, channel
(``sms`` for clicks and views, else ``ussd``) and direction (``mo`` for even ids, else ``mt``). The others are empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logtally.plans.transactions import FIELD_COUNT, TRANSACTION_FIELDS
from logtally.storage import Files

APPLICATIONS = 50


def event_lines(events: DataFrame, *others: Column) -> DataFrame:
    """One line per event as ``value``; ``event_id`` stays beside it, as do others, for splitting the lines into batches."""
    # The text of a timestamp drops trailing zeros of its fraction; no session time zone is involved.
    written = F.col("ts").cast("string")
    millis = F.rpad(F.substring(written, 21, 3), 3, "0")
    given = {
        "id": F.col("event_id").cast("string"),
        "time_stamp": F.concat(F.substring(written, 1, 19), F.lit(" "), millis),
        "app_id": F.concat(F.lit("APP_"), F.lpad((F.col("user_id") % APPLICATIONS).cast("string"), 6, "0")),
        "channel_type": F.when(F.col("event_type").isin("click", "view"), "sms").otherwise("ussd"),
        "travel_direction": F.when(F.col("event_id") % 2 == 0, "mo").otherwise("mt"),
    }
    last = max(TRANSACTION_FIELDS.index(name) for name in given)
    # A null part is an empty field; left out, it would move all that follow.
    parts = [F.coalesce(given.get(name, F.lit("")), F.lit("")) for name in TRANSACTION_FIELDS[: last + 1]]
    trailing = F.lit("|" * (FIELD_COUNT - 1 - last))
    return events.select("event_id", F.concat(F.concat_ws("|", *parts), trailing).alias("value"), *others)


def stage_batches(spark: SparkSession, events_path: str, root: str, batches: int = 4) -> str:
    """Write the lines as text files below ``batch=0 .. batch=N-1`` of ``root``, a new folder, and return it."""
    lines = event_lines(spark.read.parquet(events_path))
    batch = F.coalesce(F.pmod(F.col("event_id"), F.lit(batches)), F.lit(0)).alias("batch")
    lines.select("value", batch).write.partitionBy("batch").text(root)
    return root


def stage_slices(spark: SparkSession, events_path: str, root: str, slices: int = 4) -> tuple[str, float]:
    """Write the lines as text files in order of time, slice after slice; also returns a slice's length in seconds.

    A file source reads older files first, so the files of a slice are made to look a second older than those of the next:
    a stream over the folder is in order up to the length of a slice.
    """
    events = spark.read.parquet(events_path)
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    first, last = events.agg(F.min(seconds), F.max(seconds)).first()
    first, last = first or 0, last or 0
    length = (last - first) / slices + 1
    part = F.coalesce(F.floor((seconds - first) / length), F.lit(0)).alias("slice")
    event_lines(events, part).select("value", "slice").write.partitionBy("slice").text(root)
    files = Files(spark, root)
    now = files.modified_millis(root)
    for name in files.children(root):
        if name.startswith("slice="):
            for file in files.children(f"{root}/{name}"):
                files.set_modified(f"{root}/{name}/{file}", now - 1000 * (slices - int(name.removeprefix("slice="))))
    return root, length


def stage_part(spark: SparkSession, events_path: str, root: str, part: int, parts: int, files: int = 1) -> int:
    """Add the lines of every ``parts``-th event to a folder, as so many files; returns how many lines that is."""
    events = spark.read.parquet(events_path).where(F.coalesce(F.pmod("event_id", F.lit(parts)), F.lit(0)) == part)
    event_lines(events).select("value").repartition(files).write.mode("append").text(root)
    return events.count()
