"""Lines of text files, as a batch or as a stream of the files that appear in a directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logtally.storage import Files


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Every line below ``path`` as ``value``. Plain files are split across tasks, however large a single one is."""
    return spark.read.option("recursiveFileLookup", "true").text(path)


def stream_lines(
    spark: SparkSession,
    path: str,
    *,
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: int | None = None,
    since_millis: int | None = None,
) -> DataFrame:
    """The same as a stream. Files that are there at the first start are part of it, unless ``since_millis`` leaves them out.

    A micro-batch can be bounded by files or, where their sizes differ, by bytes. With ``since_millis``, files that were last
    changed before that point in time are passed over without being read; ``starting_point`` gives one for a checkpoint.
    """
    reader = spark.readStream.format("text").option("recursiveFileLookup", "true")
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if max_bytes_per_trigger is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    lines = reader.load(path)
    if since_millis is None:
        return lines
    # On a file's own time Spark leaves files out when it plans the batch, before any is opened.
    return lines.where(F.col("_metadata.file_modification_time") >= F.timestamp_millis(F.lit(since_millis))).select("value")


def starting_point(spark: SparkSession, checkpoint: str) -> int:
    """When the stream of this checkpoint was first started, in milliseconds, noted with the checkpoint at the first call.

    It is the time that the store gives the note, so that files and note go by the same clock. A restart gets the same point
    again: files that came while the stream was down count. A file that is moved here keeps its old time and is passed over.
    """
    files, path = Files(spark, checkpoint), f"{checkpoint.rstrip('/')}/logtally-start.json"
    if not files.exists(path):
        try:
            files.publish(path, "{}")
        except FileExistsError:
            pass  # Another start was first, and its point counts.
    return files.modified_millis(path)
