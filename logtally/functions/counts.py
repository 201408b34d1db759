"""Counts are BIGINT inside and text at the table surface."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_count(column: Column | str) -> Column:
    """Text to BIGINT; text that is no number becomes null, also under ANSI, and so adds nothing to a sum."""
    return (F.col(column) if isinstance(column, str) else column).try_cast("bigint")


def strict_count(column: Column | str) -> Column:
    """Text to BIGINT; text that is no number fails the job, whatever the session's settings."""
    given = F.col(column) if isinstance(column, str) else column
    bad = F.raise_error(F.concat(F.lit("no number as a count: "), given.cast("string")))
    return F.when(given.isNotNull() & given.try_cast("bigint").isNull(), bad.cast("bigint")).otherwise(given.try_cast("bigint"))


def as_text(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")


def total(column: Column | str) -> Column:
    return F.sum(as_count(column))
