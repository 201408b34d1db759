"""Positional fields of a delimited line as built-in expressions.

The rules, for a line cut at every delimiter:

* trailing empty tokens do not exist; leading and inner ones are empty strings;
* a position past the last token reads as one space, as does every position of a line of delimiters only;
* tokens beyond the field count are ignored;
* the empty line has one token, the empty string.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logtally.spec import FieldSpec

MISSING = " "

# Up to this many fields an empty token is resolved by looking behind it, only where one turns up. Beyond it, the
# line is trimmed once up front instead, so that the cost does not grow with the number of empty fields.
NARROW_FIELDS = 8


def decode_value(df: DataFrame, *others: str) -> DataFrame:
    """The record value as text; Kafka delivers bytes, and null where a record has no value. Other columns if named."""
    return df.select(F.col("value").cast("string").alias("value"), *others)


def cut(column: Column, field: FieldSpec) -> Column:
    if field.substring is None:
        return column
    begin, end = field.substring
    piece = F.substring(column, begin + 1, end - begin)
    if not field.strict:
        return piece
    complaint = F.concat(F.lit(f"field {field.name} is shorter than {end} characters: "), column)
    return F.when(F.length(column) < end, F.raise_error(complaint)).otherwise(piece)


def parsed_fields(df: DataFrame, fields: Sequence[FieldSpec], delimiter: str) -> DataFrame:
    """One column per field, in the given order, from the ``value`` column.

    A line is split once, and only as far as the last field asked for. The split sits under a one-element explode:
    Catalyst would push a later filter below a plain projection and repeat the split in each of its references,
    whereas a generator keeps its place, inside the same generated code.
    """
    tokens, columns = _expressions(tuple(fields), delimiter)
    return df.where(F.col("value").isNotNull()).select("value", tokens).select(*columns)


@lru_cache(maxsize=64)
def _expressions(fields: tuple[FieldSpec, ...], delimiter: str) -> tuple[Column, tuple[Column, ...]]:
    """The token column over ``value``, and the fields over both. They are tied to no DataFrame, and building sixty of
    them takes most of a second of calls into the JVM."""
    last = max(field.position for field in fields)
    narrow = len(fields) <= NARROW_FIELDS
    line = F.col("value") if narrow else _trimmed(F.col("value"), delimiter)
    tokens = F.explode(F.array(F.split(line, re.escape(delimiter), last + 1))).alias("tokens")
    token = _token_narrow if narrow else _token_wide
    return tokens, tuple(cut(token(field.position, delimiter), field).alias(field.name) for field in fields)


def _trimmed(line: Column, delimiter: str) -> Column:
    """Trimming walks the whole line, so it is left out where nothing is to be trimmed."""
    return F.when(line.endswith(delimiter), F.rtrim(line, F.lit(delimiter))).otherwise(line)


def _token_narrow(position: int, delimiter: str) -> Column:
    token = F.get("tokens", position - 1)
    behind = F.get(F.split("value", re.escape(delimiter), position + 1), position)
    exists = F.ltrim(behind, F.lit(delimiter)) != ""
    if position == 1:
        exists = exists | (F.col("value") == "")
    return F.when(token != "", token).when(exists, F.lit("")).otherwise(F.lit(MISSING))


def _token_wide(position: int, delimiter: str) -> Column:
    token = F.coalesce(F.get("tokens", position - 1), F.lit(MISSING))
    if position > 1:
        return token
    # A line of delimiters only is empty once trimmed; unlike the empty line it has no first token.
    blank = (token == "") & (F.col("value") != "") & (F.ltrim(F.col("value"), F.lit(delimiter)) == "")
    return F.when(blank, F.lit(MISSING)).otherwise(token)
