"""The telecom transaction log: its 60 fields, its daily summary and its filtered projection."""

from __future__ import annotations

from pyspark.sql import DataFrame

from logtally.operators.records import parse, pick
from logtally.spec import FieldSpec, SummarySpec, string_schema

# The field names in file order, position 1 first. Positions 31 to 60 are named by number.
NAMED_FIELDS = [
    "id",
    "time_stamp",
    "sp_id",
    "service_provider",
    "app_id",
    "app_name",
    "state_app",
    "source_entity_address",
    "source_entity_masked",
    "channel_type",
    "source_protocol",
    "dest_address",
    "dest_masked",
    "dest_channel_type",
    "dest_protocol",
    "travel_direction",
    "ncs",
    "billing",
    "part_entity_type",
    "charge_amount",
    "currency",
    "exchange_rates",
    "charging_service_code",
    "msisdn",
    "masked_msisdn",
    "billing_event",
    "response_code",
    "response_desc",
    "transaction_state",
    "transaction_keyword",
]
FIELD_COUNT = 60
TRANSACTION_FIELDS = (*NAMED_FIELDS, *(f"col_{i}" for i in range(len(NAMED_FIELDS) + 1, FIELD_COUNT + 1)))
TRANSACTION_SCHEMA = string_schema(TRANSACTION_FIELDS)

# The records a summary counts, and the length of the day in a time stamp.
SMS_MO = "channel_type = 'sms' AND travel_direction = 'mo'"
DAY = (0, 10)


def record_spec(*names: str, group_by: tuple[str, ...] = (), where: str | None = None) -> SummarySpec:
    """A spec over the named fields of the transaction log."""
    fields = tuple(FieldSpec(name, TRANSACTION_FIELDS.index(name) + 1) for name in names)
    return SummarySpec(fields=fields, group_by=group_by, where=where, field_count=FIELD_COUNT)


# Counts per time stamp as written, to the millisecond, and per day.
MILLISECOND_SUMMARY = record_spec(
    "time_stamp", "app_id", "channel_type", "travel_direction", group_by=("time_stamp", "app_id"), where=SMS_MO
)
DAILY_SUMMARY = MILLISECOND_SUMMARY.with_substring("time_stamp", DAY)


def full_records(lines: DataFrame) -> DataFrame:
    """All 60 fields."""
    return parse(lines, record_spec(*TRANSACTION_FIELDS))


def sms_mo_records(lines: DataFrame) -> DataFrame:
    """Id, provider, application and time of the mobile-originated SMS."""
    spec = record_spec("id", "sp_id", "app_id", "time_stamp", "channel_type", "travel_direction")
    return pick(parse(lines, spec), "id", "sp_id", "app_id", "time_stamp", where=SMS_MO)
