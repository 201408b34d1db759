"""Declarative description of a delimited-record summary.

A spec is plain data, checked once on the driver. Everything else in the package turns it into DataFrame
expressions, so nothing of it is looked up per row.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import asdict, dataclass, replace
from typing import Any

from pyspark.sql.types import StringType, StructField, StructType


@dataclass(frozen=True)
class FieldSpec:
    """A positional field: 1-based ``position``, optional ``(begin, end)`` cut (0-based, end exclusive).

    A value shorter than the cut is clipped; with ``strict`` it fails the job instead.
    """

    name: str
    position: int
    substring: tuple[int, int] | None = None
    strict: bool = False

    def __post_init__(self) -> None:
        if not self.name:
            raise ValueError("a field needs a name")
        if self.position < 1:
            raise ValueError(f"field {self.name}: positions start at 1, got {self.position}")
        if self.substring is not None:
            begin, end = self.substring
            if not 0 <= begin <= end:
                raise ValueError(f"field {self.name}: bad substring bounds {self.substring}")


@dataclass(frozen=True)
class SummarySpec:
    """Which fields to read, which records to keep, what to count by and where the totals go.

    Parsing alone needs no ``group_by``.
    """

    fields: tuple[FieldSpec, ...]
    group_by: tuple[str, ...] = ()
    where: str | None = None
    field_count: int = 60
    delimiter: str = "|"
    table: str = "daily_summary"
    count_column: str = "count"

    def __post_init__(self) -> None:
        names = self.field_names
        if not names:
            raise ValueError("a spec needs at least one field")
        if len(set(names)) != len(names):
            raise ValueError(f"duplicate field names in {names}")
        if len(self.delimiter) != 1:
            raise ValueError(f"the delimiter is one character, got {self.delimiter!r}")
        for field in self.fields:
            if field.position > self.field_count:
                raise ValueError(f"field {field.name}: position {field.position} is beyond {self.field_count} fields")
        unknown = [name for name in self.group_by if name not in names]
        if unknown:
            raise ValueError(f"group_by names unknown fields {unknown}")
        if self.count_column in self.group_by:
            raise ValueError(f"count column {self.count_column!r} is also a grouping field")

    @property
    def field_names(self) -> tuple[str, ...]:
        return tuple(field.name for field in self.fields)

    @property
    def output_columns(self) -> tuple[str, ...]:
        return (*self.group_by, self.count_column)

    def meaning(self) -> dict[str, Any]:
        """All that decides what a count means, as plain data; the table's name does not."""
        given = asdict(self)
        del given["table"]
        return json.loads(json.dumps(given))

    def record_schema(self) -> StructType:
        return string_schema(self.field_names)

    def summary_schema(self) -> StructType:
        """The stored summary: every column is text, the count too."""
        return string_schema(self.output_columns)

    @classmethod
    def from_dict(cls, config: Mapping[str, Any]) -> SummarySpec:
        """A spec from plain data such as a JSON file: the same names, with each field as a mapping."""
        given = dict(config)
        fields = tuple(
            FieldSpec(**{**field, "substring": tuple(field["substring"])} if field.get("substring") else field)
            for field in given.pop("fields")
        )
        return cls(fields=fields, group_by=tuple(given.pop("group_by", ())), **given)

    def with_substring(self, name: str, bounds: tuple[int, int] | None, strict: bool = False) -> SummarySpec:
        if name not in self.field_names:
            raise ValueError(f"unknown field {name!r}")
        fields = tuple(
            replace(field, substring=bounds, strict=strict) if field.name == name else field for field in self.fields
        )
        return replace(self, fields=fields)


def string_schema(names: tuple[str, ...] | list[str]) -> StructType:
    """Names to a schema of nullable strings."""
    return StructType([StructField(name, StringType(), True) for name in names])
