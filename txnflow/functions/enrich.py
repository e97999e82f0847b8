"""Merchant category, high-value flag and currency text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Merchant category codes.
MCC_CATEGORIES = {
    "5411": "GROCERY",
    "5812": "RESTAURANT",
    "5541": "GAS_STATION",
    "4111": "TRANSPORTATION",
    "5912": "PHARMACY",
    "5732": "ELECTRONICS",
    "7011": "HOTEL",
    "4511": "AIRLINE",
    "5999": "MISC_RETAIL",
    "6011": "ATM_CASH",
}
OTHER_CATEGORY = "OTHER"

# Fixed value: 1,000.00 in cents.
HIGH_VALUE_THRESHOLD_CENTS = 100_000


def enrich_with_mcc_category(code: Column | str) -> Column:
    """Category of a merchant code; unknown and null codes give OTHER.

    Ten codes fit a literal map that Catalyst folds once per query. For a large
    dimension use `txnflow.plans.models.int_enriched`, which joins a table.
    """
    column = F.col(code) if isinstance(code, str) else code
    lookup = F.create_map(*(F.lit(text) for entry in MCC_CATEGORIES.items() for text in entry))
    return F.coalesce(F.try_element_at(lookup, column), F.lit(OTHER_CATEGORY))


def flag_high_value_transactions(amount_cents: Column | str) -> Column:
    """True from the threshold on (inclusive); null amounts give null."""
    column = F.col(amount_cents) if isinstance(amount_cents, str) else amount_cents
    return column >= F.lit(HIGH_VALUE_THRESHOLD_CENTS).cast("bigint")


def normalize_currency(code: Column | str) -> Column:
    """Upper case without leading and trailing spaces. Tabs are kept."""
    return F.upper(F.trim(code))
