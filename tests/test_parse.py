"""The parse rules against a plain model of them, for few fields and for many."""

from __future__ import annotations

import random

import pytest
from pyspark.errors import PySparkException

from logtally import FieldSpec, SummarySpec
from logtally.functions import create_parse_function
from logtally.functions.delimited import NARROW_FIELDS, decode_value
from logtally.operators import keep, parse, pick
from logtally.plans import full_records, record_spec, sms_mo_records

from tests.conftest import rows


def model(line: str, count: int, delimiter: str = "|") -> tuple[str, ...]:
    tokens = line.split(delimiter)
    if line:
        while tokens and tokens[-1] == "":
            tokens.pop()
    return tuple((tokens + [" "] * count)[:count])


def positional(count: int, wanted: list[int] | None = None, delimiter: str = "|") -> SummarySpec:
    wanted = wanted or list(range(1, count + 1))
    fields = tuple(FieldSpec(f"f{i}", i) for i in wanted)
    return SummarySpec(fields=fields, group_by=(fields[0].name,), field_count=count, delimiter=delimiter)


def parsed(df, spec):
    return [tuple(row) for row in parse(df, spec).collect()]


EDGE_LINES = {
    "a|b||": ("a", "b", " ", " ", " "),
    "||": (" ",) * 5,
    "|": (" ",) * 5,
    "|||||||": (" ",) * 5,
    "": ("", " ", " ", " ", " "),
    "a||c": ("a", "", "c", " ", " "),
    "|x": ("", "x", " ", " ", " "),
    "||x|": ("", "", "x", " ", " "),
    "a|b|c|d|e|f|g": ("a", "b", "c", "d", "e"),
    "a|b|c|d||f|g": ("a", "b", "c", "d", ""),
    "||||||g": ("",) * 5,
    "a|b|c|d|e": ("a", "b", "c", "d", "e"),
    "a|b|c|d|e|||": ("a", "b", "c", "d", "e"),
    " ": (" ",) * 5,
    " |b": (" ", "b", " ", " ", " "),
    "ü|日本||x": ("ü", "日本", "", "x", " "),
    "a\\|b": ("a\\", "b", " ", " ", " "),
}


@pytest.mark.parametrize("padding", [0, NARROW_FIELDS])
def test_edge_lines(lines_of, padding):
    """With padding there are too many fields for the narrow form."""
    got = parsed(lines_of(EDGE_LINES), positional(5 + padding))
    assert sorted(row[:5] for row in got) == sorted(EDGE_LINES.values())
    assert sorted(got) == sorted(model(line, 5 + padding) for line in EDGE_LINES)


def test_the_model_itself():
    for line, fields in EDGE_LINES.items():
        assert model(line, 5) == fields


@pytest.mark.parametrize("delimiter", ["|", "\t", "$", "\\", "é"])
@pytest.mark.parametrize("count", [3, NARROW_FIELDS, NARROW_FIELDS + 1, 20])
def test_random_lines(lines_of, delimiter, count):
    draw = random.Random(count)
    lines = [
        delimiter.join(draw.choice(["", "", "a", " ", "bc"]) for _ in range(draw.randint(0, 25))) for _ in range(300)
    ]
    got = parsed(lines_of(lines), positional(count, delimiter=delimiter))
    assert sorted(got) == sorted(model(line, count, delimiter) for line in lines)


def test_selected_positions_keep_the_given_order(lines_of):
    assert parsed(lines_of(["a|b|c|d"]), positional(5, [4, 1, 5])) == [("d", "a", " ")]


def test_full_record_of_sixty_fields(lines_of):
    tokens = [str(i) for i in range(1, 55)]
    tokens[8] = ""
    line = "|".join(tokens) + "|" * 7
    (row,) = full_records(lines_of([line])).collect()
    assert len(line.split("|")) == 61
    assert tuple(row) == model(line, 60)
    assert row.source_entity_masked == "" and row.col_54 == "54" and row.col_55 == " "


def test_null_lines_are_left_out_and_bytes_are_decoded(spark):
    df = spark.createDataFrame([("a|ü".encode(),), (None,)], "value binary")
    assert parsed(decode_value(df), positional(2)) == [("a", "ü")]
    nulls = spark.createDataFrame([(None,)], "value string")
    assert parsed(nulls, positional(2)) == []
    assert parsed(nulls, positional(20)) == []


def test_substring_clips_or_fails(lines_of):
    base = positional(2)
    lines = lines_of(["2017-10-13 18:00|x", "2017|y"])
    clipped = parse(lines, base.with_substring("f1", (0, 10)))
    assert sorted(row.f1 for row in clipped.collect()) == ["2017", "2017-10-13"]
    inner = parse(lines_of(["abcdef|x"]), base.with_substring("f1", (2, 4)))
    assert inner.first().f1 == "cd"
    with pytest.raises(PySparkException, match="shorter than 10"):
        parse(lines, base.with_substring("f1", (0, 10), strict=True)).collect()
    assert parse(lines_of(["2017-10-13|x"]), base.with_substring("f1", (0, 10), strict=True)).count() == 1


def test_filter_is_exact_and_may_use_fields_that_are_not_picked(lines_of):
    def line(channel, direction):
        return "|".join(["7", "t", "sp", "", "app", "", "", "", "", channel, "", "", "", "", "", direction])

    lines = lines_of([line("sms", "mo"), line("SMS", "mo"), line("sms ", "mo"), line("sms", "mt"), "short|line"])
    records = sms_mo_records(lines)
    assert records.columns == ["id", "sp_id", "app_id", "time_stamp"]
    assert [tuple(row) for row in records.collect()] == [("7", "sp", "app", "t")]
    spec = record_spec("id", "channel_type")
    padded = keep(parse(lines, spec), "channel_type = ' '")
    assert [row.id for row in padded.collect()] == ["short"]
    assert pick(parse(lines, spec), "id", where="channel_type LIKE 'sms%'").count() == 3
    assert keep(parse(lines, spec), None).count() == 5


# The same rules as a table function in SQL


def test_the_sql_function_keeps_the_rules(spark, lines_of):
    fields = tuple(FieldSpec(name, position) for name, position in (("a", 1), ("b", 2), ("c`", 3), ("d", 5)))
    for delimiter in ("|", ".", "\\", "'", "x"):
        spec = SummarySpec(fields=fields, field_count=5, delimiter=delimiter)
        draw = random.Random(delimiter)
        lines = ["", delimiter, delimiter * 9, f"a{delimiter}", f"{delimiter}a", " "]
        lines += ["".join(draw.choice(["", "a", "é", " ", delimiter, delimiter]) for _ in range(draw.randint(0, 12))) for _ in range(150)]
        given = lines_of(lines)
        create_parse_function(spark, spec, "parse_line")
        given.createOrReplaceTempView("given_lines")
        got = spark.sql("SELECT p.* FROM given_lines AS l, LATERAL parse_line(l.value) AS p")
        assert got.columns == ["a", "b", "c`", "d"]
        assert rows(got) == rows(parse(given, spec)), delimiter


def test_the_sql_function_cuts(spark, lines_of):
    spec = SummarySpec(fields=(FieldSpec("a", 1, (1, 3)), FieldSpec("b", 2, (0, 2), strict=True)), field_count=2)
    create_parse_function(spark, spec, "cut_line")
    assert [tuple(r) for r in spark.sql("SELECT * FROM cut_line('abcd|xyz')").collect()] == [("bc", "xy")]
    assert [tuple(r) for r in spark.sql("SELECT * FROM cut_line(NULL)").collect()] == [(None, None)]
    with pytest.raises(Exception, match="shorter than 2"):
        spark.sql("SELECT * FROM cut_line('abcd|x')").collect()
    plan = spark.sql("SELECT p.b FROM range(3) AS r, LATERAL cut_line(r.id || '|yy') AS p")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
