from logtally.plans.transactions import (
    DAILY_SUMMARY,
    MILLISECOND_SUMMARY,
    SMS_MO,
    TRANSACTION_FIELDS,
    TRANSACTION_SCHEMA,
    full_records,
    record_spec,
    sms_mo_records,
)

__all__ = [
    "DAILY_SUMMARY",
    "MILLISECOND_SUMMARY",
    "SMS_MO",
    "TRANSACTION_FIELDS",
    "TRANSACTION_SCHEMA",
    "full_records",
    "record_spec",
    "sms_mo_records",
]
