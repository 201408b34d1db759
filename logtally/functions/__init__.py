from logtally.functions.counts import as_count, as_text, total
from logtally.functions.delimited import cut, decode_value, parsed_fields
from logtally.functions.table_function import create_parse_function, parse_function_sql

__all__ = ["as_count", "as_text", "create_parse_function", "cut", "decode_value", "parse_function_sql", "parsed_fields", "total"]
