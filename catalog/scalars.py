"""Scalar functions over all events."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from catalog.adapters import KEY, partial_events, props_k, table, transactions
from catalog.registry import category_sql, dollars_sql, query, token_sql
from txnflow.functions import (
    RotatingKey,
    TokenKey,
    cents_to_dollars,
    enrich_with_mcc_category,
    event_time,
    event_time_ntz,
    flag_high_value_transactions,
    metadata_map,
    metadata_variant,
    normalize_currency,
    tokenize_account_id,
    tokenize_card_number,
)
from txnflow.operators.transform import fill_defaults, mask_account
from txnflow.plans.models import rotate_tokens, token_remap

NEXT_KEY = TokenKey(b"the key that comes next, longer than one hash block of sixty-four bytes, so it is hashed")
KEYS = (RotatingKey("2024a", KEY, date(2024, 1, 1)), RotatingKey("2024b", NEXT_KEY, date(2024, 1, 16)))


def _events(spark, sf_dir):
    return transactions(table(spark, sf_dir, "events"))


@query(
    "tokenize_account",
    f"SELECT transaction_id, {token_sql('account_id')} AS account_id_token FROM txn",
)
def tokenize_account(spark, sf_dir):
    return _events(spark, sf_dir).select("transaction_id", tokenize_account_id("account_id", KEY).alias("account_id_token"))


@query(
    "tokenize_card",
    f"""SELECT transaction_id, {token_sql("('4000' || lpad(transaction_id, 12, '0'))")} AS card_token FROM txn""",
)
def tokenize_card(spark, sf_dir):
    number = F.concat(F.lit("4000"), F.lpad("transaction_id", 12, "0"))
    return _events(spark, sf_dir).select("transaction_id", tokenize_card_number(number, KEY).alias("card_token"))


@query(
    "event_time_parse",
    """SELECT transaction_id,
              CASE k WHEN 10 THEN date_trunc('day', ts) WHEN 12 THEN ts - INTERVAL 5 HOUR WHEN 13 THEN NULL
                     ELSE ts END AS event_ts,
              CASE k WHEN 10 THEN date_trunc('day', ts) WHEN 13 THEN NULL ELSE ts END AS event_ts_ntz
       FROM txn""",
)
def event_time_parse(spark, sf_dir):
    rows = transactions(table(spark, sf_dir, "events").withColumn("k", props_k()), "k")
    text = F.col("event_timestamp")
    written = (
        F.when(F.col("k") == 10, F.substring(text, 1, 10))
        .when(F.col("k") == 11, F.concat(text, F.lit("Z")))
        .when(F.col("k") == 12, F.concat(text, F.lit("+05:00")))
        .when(F.col("k") == 13, "bad")
        .otherwise(text)
    )
    return rows.select(
        "transaction_id",
        event_time(written).cast("timestamp_ntz").alias("event_ts"),
        event_time_ntz(written).alias("event_ts_ntz"),
    )


@query("amount_dollars", f"SELECT transaction_id, {dollars_sql('amount_cents')} AS amount_dollars FROM txn")
def amount_dollars(spark, sf_dir):
    return _events(spark, sf_dir).select("transaction_id", cents_to_dollars("amount_cents").alias("amount_dollars"))


@query("mcc_category", f"SELECT transaction_id, {category_sql('merchant_category_code')} AS mcc_category FROM txn")
def mcc_category(spark, sf_dir):
    return _events(spark, sf_dir).select(
        "transaction_id", enrich_with_mcc_category("merchant_category_code").alias("mcc_category")
    )


@query("high_value_flag", "SELECT transaction_id, amount_cents >= 100000 AS is_high_value FROM txn")
def high_value_flag(spark, sf_dir):
    return _events(spark, sf_dir).select(
        "transaction_id", flag_high_value_transactions("amount_cents").alias("is_high_value")
    )


@query("normalize_currency", "SELECT transaction_id, upper(trim(currency)) AS currency FROM txn")
def currency(spark, sf_dir):
    return _events(spark, sf_dir).select("transaction_id", normalize_currency("currency").alias("currency"))


@query(
    "metadata_parse",
    """SELECT CAST(event_id AS VARCHAR) AS transaction_id, json_extract_string(props, '$.k') AS k_text,
              CAST(json_extract(props, '$.k') AS BIGINT) AS k_number FROM events""",
)
def metadata_parse(spark, sf_dir):
    number = F.try_variant_get(metadata_variant("props"), "$.k", "bigint")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("transaction_id"),
        metadata_map("props")["k"].alias("k_text"),
        number.alias("k_number"),
    )


@query(
    "mask_account",
    f"""SELECT transaction_id, '[TOKENIZED]' AS account_id, {token_sql('account_id')} AS account_id_token FROM txn""",
)
def mask(spark, sf_dir):
    rows = _events(spark, sf_dir).select(
        "transaction_id", "account_id", tokenize_account_id("account_id", KEY).alias("account_id_token")
    )
    return mask_account(rows)


@query(
    "fill_defaults",
    """SELECT transaction_id, account_id, amount_cents,
              CASE WHEN k BETWEEN 10 AND 19 THEN 'USD' ELSE currency END AS currency, merchant_id,
              CASE WHEN k BETWEEN 20 AND 29 THEN '5411' ELSE merchant_category_code END AS merchant_category_code,
              CASE WHEN k BETWEEN 30 AND 39 THEN 'AUTHORIZATION' ELSE event_type END AS event_type, event_timestamp,
              CASE WHEN k BETWEEN 40 AND 49 THEN '0000' ELSE card_last_four END AS card_last_four,
              CASE WHEN k BETWEEN 50 AND 59 THEN FALSE ELSE is_international END AS is_international,
              CASE WHEN k BETWEEN 60 AND 69 THEN '{}' ELSE metadata END AS metadata
       FROM txn""",
)
def defaults(spark, sf_dir):
    filled = fill_defaults(partial_events(table(spark, sf_dir, "events")))
    return filled.withColumn("metadata", F.to_json("metadata"))


@query(
    "token_rotation",
    f"""SELECT transaction_id, CASE WHEN ts < DATE '2024-01-16' THEN '2024a' ELSE '2024b' END AS token_key_id,
               CASE WHEN ts < DATE '2024-01-16' THEN {token_sql('account_id')}
                    ELSE {token_sql('account_id', NEXT_KEY)} END AS account_id_token
        FROM txn""",
)
def token_rotation(spark, sf_dir):
    rows = transactions(table(spark, sf_dir, "events"), "ts")
    return rotate_tokens(rows, F.to_date("ts"), KEYS).select("transaction_id", "token_key_id", "account_id_token")


@query(
    "token_remap",
    f"""SELECT DISTINCT {token_sql('account_id')} AS old_token, {token_sql('account_id', NEXT_KEY)} AS new_token
        FROM txn""",
)
def remap(spark, sf_dir):
    return token_remap(_events(spark, sf_dir), *KEYS)
