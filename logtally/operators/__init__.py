from logtally.operators.ledger import CountLedger
from logtally.operators.records import keep, parse, pick
from logtally.operators.running import RunningCounts
from logtally.operators.summary import recount, summarise, summarise_sql
from logtally.operators.tables import SummaryTable, append_all

__all__ = [
    "CountLedger",
    "RunningCounts",
    "SummaryTable",
    "append_all",
    "keep",
    "parse",
    "pick",
    "recount",
    "summarise",
    "summarise_sql",
]
