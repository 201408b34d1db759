"""The parse rules for people who write SQL: a table function made from a spec.

    CREATE TEMPORARY FUNCTION parse_transaction ...                      -- create_parse_function(spark, spec, "parse_transaction")
    SELECT day, count(*) FROM lines, LATERAL parse_transaction(lines.value) WHERE channel_type = 'sms' GROUP BY day
"""

from __future__ import annotations

import re

from pyspark.sql import SparkSession

from logtally.functions.delimited import MISSING
from logtally.spec import FieldSpec, SummarySpec


def parse_function_sql(spec: SummarySpec, name: str, temporary: bool = True) -> str:
    """The statement that creates the function: one string parameter, a line; one row with the spec's fields, all text.

    The line is trimmed and split once, and only up to the last field asked for. A null line gives a row of nulls. The
    spec's predicate is not part of it: that is what WHERE is for.
    """
    delimiter = _text(spec.delimiter)
    last = max(field.position for field in spec.fields)
    trimmed = f"CASE WHEN endswith(line, {delimiter}) THEN trim(TRAILING {delimiter} FROM line) ELSE line END"
    tokens = f"split({trimmed}, {_text(re.escape(spec.delimiter))}, {last + 1})"
    columns = ",\n  ".join(f"{_cut(_token(field, delimiter), field)} AS {_name(field.name)}" for field in spec.fields)
    returns = ", ".join(f"{_name(field.name)} STRING" for field in spec.fields)
    kind = "TEMPORARY FUNCTION" if temporary else "FUNCTION"
    return (
        f"CREATE OR REPLACE {kind} {_name(name)}(line STRING)\nRETURNS TABLE ({returns})\n"
        f"RETURN SELECT\n  {columns}\nFROM (SELECT line, {tokens} AS tokens)"
    )


def create_parse_function(spark: SparkSession, spec: SummarySpec, name: str, temporary: bool = True) -> None:
    """Create the function, or replace it, in the session or, if it is not temporary, in the catalog."""
    spark.sql(parse_function_sql(spec, name, temporary))


def _token(field: FieldSpec, delimiter: str) -> str:
    missing = _text(MISSING)
    token = f"coalesce(get(tokens, {field.position - 1}), CASE WHEN line IS NOT NULL THEN {missing} END)"
    if field.position > 1:
        return token
    # A line of delimiters only is empty once trimmed; unlike the empty line it has no first token.
    return f"CASE WHEN line != '' AND trim(LEADING {delimiter} FROM line) = '' THEN {missing} ELSE {token} END"


def _cut(token: str, field: FieldSpec) -> str:
    if field.substring is None:
        return token
    begin, end = field.substring
    piece = f"substring({token}, {begin + 1}, {end - begin})"
    if not field.strict:
        return piece
    complaint = f"raise_error(concat({_text(f'field {field.name} is shorter than {end} characters: ')}, {token}))"
    return f"CASE WHEN length({token}) < {end} THEN {complaint} ELSE {piece} END"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _name(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
