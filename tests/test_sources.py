from __future__ import annotations

import pytest

from logtally.session import build_session
from logtally.sources import KafkaSource, read_lines
from logtally.sources.kafka import offsets_per_trigger
from logtally import storage
from logtally.fixtures import event_lines
from logtally.storage import Files, clear_scratch, fresh_dir, shared_root

from tests.conftest import rows


def test_kafka_options():
    source = KafkaSource(
        bootstrap_servers="h1:9092,h2:9092",
        topics="calls, texts,calls",
        group_id="summary",
        max_offsets_per_trigger=offsets_per_trigger(25, 7, 4),
        max_records_per_partition=1_000_000,
        min_partitions=8,
        consumer={"session.timeout.ms": "100000", "max.partition.fetch.bytes": "1000000000"},
    )
    assert source.options() == {
        "kafka.bootstrap.servers": "h1:9092,h2:9092",
        "subscribe": "calls,texts",
        "startingOffsets": "latest",
        "failOnDataLoss": "true",
        "kafka.group.id": "summary",
        "maxOffsetsPerTrigger": "700",
        "maxRecordsPerPartition": "1000000",
        "minPartitions": "8",
        "kafka.session.timeout.ms": "100000",
        "kafka.max.partition.fetch.bytes": "1000000000",
    }


def test_kafka_defaults_and_topics():
    assert "maxOffsetsPerTrigger" not in KafkaSource("h:1", ("a", "b")).options()
    assert KafkaSource("h:1", ("a", "b")).topic_list() == ["a", "b"]
    assert KafkaSource("h:1", "a;b", separator=";").options()["subscribe"] == "a,b"
    with pytest.raises(ValueError):
        KafkaSource("h:1", " ,").options()


def test_kafka_batch_options():
    source = KafkaSource("h:1", "a", max_offsets_per_trigger=10)
    assert source.batch_options()["startingOffsets"] == "earliest"
    assert "maxOffsetsPerTrigger" not in source.batch_options()
    given = '{"a":{"0":5}}'
    options = source.batch_options(given, given)
    assert options["startingOffsets"] == options["endingOffsets"] == given
    with pytest.raises(ValueError):
        source.batch_options("latest")


def test_rates_are_never_zero():
    assert offsets_per_trigger(25, 0.001, 1) == 1


def test_text_is_read_below_the_folder(spark, tmp_path):
    (tmp_path / "x" / "y").mkdir(parents=True)
    (tmp_path / "x" / "a.txt").write_text("1\r\n2\n")
    (tmp_path / "x" / "y" / "b.txt").write_text("\n3")
    assert rows(read_lines(spark, str(tmp_path))) == [("",), ("1",), ("2",), ("3",)]


def test_null_parts_are_empty_fields(spark):
    events = spark.createDataFrame([(4, None, None, None)], "event_id long, ts timestamp_ntz, user_id long, event_type string")
    parts = event_lines(events).first()["value"].split("|")
    assert parts[0] == "4" and parts[4] == "" and parts[9] == "ussd" and parts[15] == "mo" and len(parts) == 60


def test_scratch_is_cleared(spark):
    path = fresh_dir(spark, "scratch")
    spark.range(1).write.parquet(path)
    kept = dict(storage._handed_out)
    storage._handed_out[spark.sparkContext.applicationId] = [path]
    clear_scratch(spark)
    storage._handed_out.update(kept)
    assert not Files(spark, path).exists(path)


def test_work_files_go_where_the_session_says(spark):
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert fresh_dir(spark, "a") != fresh_dir(spark, "a")


def test_build_session_returns_the_running_one(spark):
    same = build_session("tests", shuffle_partitions=4, config={"spark.sql.shuffle.partitions": "4"})
    assert same.sparkContext is spark.sparkContext
