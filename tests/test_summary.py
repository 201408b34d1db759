from __future__ import annotations

import pytest

from logtally import FieldSpec, SummarySpec
from logtally.operators import recount, summarise, summarise_sql
from logtally.functions.counts import as_count

from tests.conftest import rows

SPEC = SummarySpec(
    fields=(FieldSpec("day", 1, (0, 10)), FieldSpec("app", 2), FieldSpec("kind", 3)),
    group_by=("day", "app"),
    where="kind = 'sms'",
    field_count=4,
)
LINES = [
    "2024-01-01 10|a|sms",
    "2024-01-01 11|a|sms|",
    "2024-01-01 11|a|web",
    "2024-01-02|a|sms",
    "2024-01-02|b|sms|x|y",
]
COUNTS = [("2024-01-01", "a", 2), ("2024-01-02", "a", 1), ("2024-01-02", "b", 1)]


def test_summarise(lines_of):
    result = summarise(lines_of(LINES), SPEC)
    assert result.schema.simpleString() == "struct<day:string,app:string,count:bigint>"
    assert rows(result) == COUNTS


def test_summarise_by_one_field_without_a_filter(lines_of):
    spec = SummarySpec(fields=SPEC.fields, group_by=("kind",), field_count=4, count_column="n")
    assert rows(summarise(lines_of(LINES), spec)) == [("sms", 4), ("web", 1)]


def test_sql_gives_the_same(spark, lines_of):
    assert rows(summarise_sql(spark, lines_of(LINES), SPEC, "parsed")) == COUNTS
    assert rows(spark.sql("SELECT DISTINCT app FROM parsed")) == [("a",), ("b",)]


def test_recount_reads_text_and_returns_text(spark):
    table = spark.createDataFrame(
        [("d", "a", "2"), ("d", "a", "3"), ("d", "b", "no number"), ("d", "b", "1"), ("d", "c", None)],
        "day string, app string, count string",
    )
    assert rows(recount(table, SPEC)) == [("d", "a", "5"), ("d", "b", "1"), ("d", "c", None)]


def test_counts_go_beyond_32_bits(spark):
    table = spark.createDataFrame([("d", "a", "2147483647")] * 2, "day string, app string, count string")
    assert rows(recount(table, SPEC)) == [("d", "a", "4294967294")]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_bad_counts_read_as_null_in_either_mode(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = spark.createDataFrame([("x",), ("12",)], "c string").select(as_count("c").alias("c"))
        assert rows(df) == [(12,), (None,)]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_counting_needs_groups(spark, lines_of):
    spec = SummarySpec(fields=SPEC.fields, field_count=4)
    for count in (lambda: summarise(lines_of(LINES), spec), lambda: summarise_sql(spark, lines_of(LINES), spec, "v")):
        with pytest.raises(ValueError, match="group_by"):
            count()
