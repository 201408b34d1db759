"""Record values of Kafka topics.

Needs Spark's Kafka connector on the class path (``--packages org.apache.spark:spark-sql-kafka-0-10_2.13:<version>``).
Offsets live in the query's checkpoint, so there is nothing to commit to the broker.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from logtally.functions.delimited import decode_value


@dataclass(frozen=True)
class KafkaSource:
    """Where to read and how fast.

    ``max_records_per_partition`` and ``min_partitions`` let Spark cut the offset range of a Kafka partition that holds
    far more than the others into several tasks; ``max_offsets_per_trigger`` bounds a micro-batch.
    """

    bootstrap_servers: str
    topics: str | tuple[str, ...]
    separator: str = ","
    group_id: str | None = None
    starting_offsets: str = "latest"
    max_offsets_per_trigger: int | None = None
    max_records_per_partition: int | None = None
    min_partitions: int | None = None
    fail_on_data_loss: bool = True
    consumer: Mapping[str, str] = field(default_factory=dict)

    def topic_list(self) -> list[str]:
        """The distinct topics, from a tuple or from one string with separators."""
        names = self.topics.split(self.separator) if isinstance(self.topics, str) else self.topics
        topics = list(dict.fromkeys(name.strip() for name in names if name.strip()))
        if not topics:
            raise ValueError("no Kafka topic given")
        return topics

    def options(self) -> dict[str, str]:
        """Reader options; ``consumer`` settings go to the Kafka client as they are."""
        options = {
            "kafka.bootstrap.servers": self.bootstrap_servers,
            "subscribe": ",".join(self.topic_list()),
            "startingOffsets": self.starting_offsets,
            "failOnDataLoss": str(self.fail_on_data_loss).lower(),
        }
        if self.group_id:
            options["kafka.group.id"] = self.group_id
        if self.max_offsets_per_trigger is not None:
            options["maxOffsetsPerTrigger"] = str(self.max_offsets_per_trigger)
        if self.max_records_per_partition is not None:
            options["maxRecordsPerPartition"] = str(self.max_records_per_partition)
        if self.min_partitions is not None:
            options["minPartitions"] = str(self.min_partitions)
        options.update({f"kafka.{name}": value for name, value in self.consumer.items()})
        return options

    def stream(self, spark: SparkSession, *, with_time: bool = False) -> DataFrame:
        """Record values as a stream of ``value`` strings; ``with_time`` adds the record's own time as ``record_time``."""
        return _values(spark.readStream.format("kafka").options(**self.options()).load(), with_time)

    def read(
        self, spark: SparkSession, start: str = "earliest", end: str = "latest", *, with_time: bool = False
    ) -> DataFrame:
        """What the topics hold between two offsets, for back-filling. The stream's own start has no part in it."""
        return _values(spark.read.format("kafka").options(**self.batch_options(start, end)).load(), with_time)

    def batch_options(self, start: str = "earliest", end: str = "latest") -> dict[str, str]:
        """Reader options of a batch, which has no triggers and cannot start at the latest offset."""
        if start == "latest":
            raise ValueError("a batch cannot start at the latest offset")
        options = self.options() | {"startingOffsets": start, "endingOffsets": end}
        options.pop("maxOffsetsPerTrigger", None)
        return options


def _values(records: DataFrame, with_time: bool) -> DataFrame:
    decoded = decode_value(records, "timestamp") if with_time else decode_value(records)
    return decoded.withColumnRenamed("timestamp", "record_time")


def offsets_per_trigger(per_partition_per_second: int, seconds: float, partitions: int) -> int:
    """A rate per partition and second as the number of records one micro-batch may take."""
    return max(1, int(per_partition_per_second * seconds * partitions))
