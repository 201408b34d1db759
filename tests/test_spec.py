from __future__ import annotations

import pytest

from logtally import FieldSpec, SummarySpec
from logtally.plans import DAILY_SUMMARY, TRANSACTION_FIELDS, TRANSACTION_SCHEMA


def spec(**changes):
    given = {"fields": (FieldSpec("a", 1), FieldSpec("b", 2)), "group_by": ("a",), "field_count": 5}
    return SummarySpec(**{**given, **changes})


@pytest.mark.parametrize(
    "changes",
    [
        {"fields": ()},
        {"fields": (FieldSpec("a", 1), FieldSpec("a", 2))},
        {"fields": (FieldSpec("a", 6),)},
        {"group_by": ("c",)},
        {"delimiter": "||"},
        {"delimiter": ""},
        {"count_column": "a"},
    ],
)
def test_bad_specs_are_refused(changes):
    with pytest.raises(ValueError):
        spec(**changes)


@pytest.mark.parametrize("arguments", [("", 1), ("a", 0), ("a", 1, (3, 2)), ("a", 1, (-1, 2))])
def test_bad_fields_are_refused(arguments):
    with pytest.raises(ValueError):
        FieldSpec(*arguments)


def test_schemas_are_nullable_strings_in_order():
    assert spec().record_schema().simpleString() == "struct<a:string,b:string>"
    assert spec().summary_schema().simpleString() == "struct<a:string,count:string>"
    assert all(field.nullable for field in spec().record_schema())


def test_any_number_of_grouping_fields():
    assert spec(group_by=("b", "a")).output_columns == ("b", "a", "count")


def test_with_substring():
    changed = spec().with_substring("b", (0, 3), strict=True)
    assert changed.fields[1] == FieldSpec("b", 2, (0, 3), True)
    with pytest.raises(ValueError):
        spec().with_substring("c", (0, 3))


def test_transaction_fields():
    assert len(TRANSACTION_FIELDS) == len(TRANSACTION_SCHEMA) == 60
    positions = {field.name: field.position for field in DAILY_SUMMARY.fields}
    assert positions == {"time_stamp": 2, "app_id": 5, "channel_type": 10, "travel_direction": 16}
    assert TRANSACTION_FIELDS[29:31] == ("transaction_keyword", "col_31")
    assert TRANSACTION_FIELDS[-1] == "col_60"


def test_from_plain_data():
    config = {
        "fields": [
            {"name": "time_stamp", "position": 2, "substring": [0, 10]},
            {"name": "app_id", "position": 5},
            {"name": "channel_type", "position": 10},
            {"name": "travel_direction", "position": 16, "substring": None},
        ],
        "where": "channel_type = 'sms' AND travel_direction = 'mo'",
        "group_by": ["time_stamp", "app_id"],
    }
    assert SummarySpec.from_dict(config) == DAILY_SUMMARY
    with pytest.raises(TypeError):
        SummarySpec.from_dict({**config, "unknown": 1})
