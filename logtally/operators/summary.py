"""Counting per group, and adding counts up again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logtally.functions.counts import as_text, total
from logtally.operators.records import keep, parse
from logtally.spec import SummarySpec


def count_groups(records: DataFrame, spec: SummarySpec) -> DataFrame:
    """Rows per group. The partial count before the shuffle leaves one row per group and task, however hot a group."""
    _require_groups(spec)
    return records.groupBy(*spec.group_by).agg(F.count(F.lit(1)).alias(spec.count_column))


def summarise(lines: DataFrame, spec: SummarySpec) -> DataFrame:
    """Lines to ``(group..., count)``: parse, filter, count, with one shuffle of the pre-counted groups."""
    return count_groups(keep(parse(lines, spec), spec.where), spec)


def summarise_sql(spark: SparkSession, lines: DataFrame, spec: SummarySpec, view: str) -> DataFrame:
    """The same through SQL: registers the parsed records as a view and counts over it."""
    _require_groups(spec)
    parse(lines, spec).createOrReplaceTempView(view)
    keys = ", ".join(_quoted(name) for name in spec.group_by)
    where = "" if spec.where is None else f"WHERE {spec.where}"
    return spark.sql(
        f"SELECT {keys}, count(*) AS {_quoted(spec.count_column)} FROM {_quoted(view)} {where} GROUP BY {keys}"
    )


def add_up(counts: DataFrame, keys: Sequence[str], count_column: str) -> DataFrame:
    """Sum counts per group as BIGINT; counts given as text are read as numbers."""
    return counts.groupBy(*keys).agg(total(count_column).alias(count_column))


def recount(counts: DataFrame, spec: SummarySpec) -> DataFrame:
    """Add up a summary table that holds several rows per group, back to the text form of the table."""
    _require_groups(spec)
    summed = add_up(counts, spec.group_by, spec.count_column)
    return summed.withColumn(spec.count_column, as_text(spec.count_column))


def _require_groups(spec: SummarySpec) -> None:
    if not spec.group_by:
        raise ValueError("the spec has no group_by fields to count by")


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
