"""Column expressions. All are native, so they stay inside whole-stage codegen."""

from txnflow.functions.crypto import (
    RotatingKey,
    TokenKey,
    rotating_token,
    tokenize_account_id,
    tokenize_card_number,
)
from txnflow.functions.enrich import (
    HIGH_VALUE_THRESHOLD_CENTS,
    MCC_CATEGORIES,
    enrich_with_mcc_category,
    flag_high_value_transactions,
    normalize_currency,
)
from txnflow.functions.json import metadata_map, metadata_variant, payload_struct
from txnflow.functions.money import average_dollars, cents_to_dollars, percent
from txnflow.functions.times import event_date, event_time, event_time_ntz, plus_millis

__all__ = [
    "HIGH_VALUE_THRESHOLD_CENTS",
    "MCC_CATEGORIES",
    "RotatingKey",
    "TokenKey",
    "average_dollars",
    "cents_to_dollars",
    "enrich_with_mcc_category",
    "event_date",
    "event_time",
    "event_time_ntz",
    "flag_high_value_transactions",
    "metadata_map",
    "metadata_variant",
    "normalize_currency",
    "payload_struct",
    "percent",
    "plus_millis",
    "rotating_token",
    "tokenize_account_id",
    "tokenize_card_number",
]
