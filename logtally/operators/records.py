"""Lines to records: parse, filter, project. All of it works the same on a batch and on a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logtally.functions.delimited import parsed_fields
from logtally.spec import SummarySpec


def parse(lines: DataFrame, spec: SummarySpec) -> DataFrame:
    """The spec's fields, in its order, as nullable strings. Lines that are null are left out."""
    return parsed_fields(lines, spec.fields, spec.delimiter)


def keep(records: DataFrame, where: str | None) -> DataFrame:
    """Records matching any Spark SQL predicate over the parsed fields."""
    return records if where is None else records.where(where)


def pick(records: DataFrame, *columns: str, where: str | None = None) -> DataFrame:
    """Filter, then project: the predicate may use fields that are not picked."""
    return keep(records, where).select(*columns)


def count_lines(lines: DataFrame, name: str = "lines") -> DataFrame:
    """Attach a counter of all and of null lines, reported with each batch's progress."""
    return lines.observe(
        name,
        F.count(F.lit(1)).alias("all_lines"),
        F.count_if(F.col("value").isNull()).alias("null_lines"),
    )
