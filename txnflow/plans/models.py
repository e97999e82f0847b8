"""Staging, intermediate and fact models."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnflow.functions import MCC_CATEGORIES, RotatingKey, rotating_token
from txnflow.operators.dedupe import latest_versions
from txnflow.schema import RETENTION_DAYS


def mcc_dimension(spark: SparkSession) -> DataFrame:
    """The fixed category list as a table, the stand-in for a larger dimension.

    A relation of literals: its size is known when a join is planned, so that
    ten rows are broadcast and no fact is shuffled by its code.
    """
    rows = ", ".join(f"('{code}', '{name}')" for code, name in MCC_CATEGORIES.items())
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(merchant_category_code, category)")


def stg_card_transactions(landing: DataFrame) -> DataFrame:
    """One row per transaction, the one ingested last, under staging names."""
    return latest_versions(landing).select(
        "transaction_id",
        "account_id_token",
        F.col("amount_cents").alias("amount_minor"),
        F.col("amount_dollars").alias("amount_usd"),
        F.col("currency").alias("currency_code"),
        "merchant_id",
        F.col("merchant_category_code").alias("mcc"),
        "mcc_category",
        F.lower("event_type").alias("event_type"),
        F.col("event_ts").alias("event_at"),
        F.col("event_date"),
        F.col("card_last_four").alias("card_last4"),
        "is_international",
        "is_high_value",
        "ingested_at",
    )


def unknown_mcc(rows: DataFrame, dimension: DataFrame, code: str = "merchant_category_code") -> DataFrame:
    """Rows whose code the dimension does not list."""
    return rows.join(dimension.select(F.col("merchant_category_code").alias(code)), code, "left_anti")


def known_mcc(rows: DataFrame, dimension: DataFrame, code: str = "merchant_category_code") -> DataFrame:
    """Rows whose code the dimension lists."""
    return rows.join(dimension.select(F.col("merchant_category_code").alias(code)), code, "left_semi")


def int_enriched(
    staging: DataFrame,
    mcc: DataFrame,
    accounts: DataFrame,
    merchants: DataFrame,
) -> DataFrame:
    """Staging rows with category, account and merchant attributes and signals.

    Dimensions are unique by key: `mcc(merchant_category_code, category)`,
    `accounts(account_id_token, ...)`, `merchants(merchant_id, ...)`. Joins are
    left joins, so no transaction is lost to a missing dimension row. Spark
    picks each join by the sizes it knows; busy accounts and merchants are split
    by its skew join.
    """
    codes = mcc.select(F.col("merchant_category_code").alias("mcc"), F.col("category").alias("_category"))
    joined = staging.join(codes, "mcc", "left").join(accounts, "account_id_token", "left").join(merchants, "merchant_id", "left")
    return joined.withColumns(
        {
            "mcc_category": F.coalesce("_category", F.lit("OTHER")),
            "is_dispute": F.col("event_type") == "chargeback",
            "is_refund": F.col("event_type") == "refund",
            "is_risky": F.coalesce(F.col("is_high_value") & F.col("is_international"), F.lit(False)),
        }
    ).drop("_category")


def fct_transactions(enriched: DataFrame) -> DataFrame:
    """The fact table: one typed row per transaction."""
    return enriched.select(
        "transaction_id",
        "account_id_token",
        "merchant_id",
        "event_date",
        "event_at",
        "event_type",
        "mcc",
        "mcc_category",
        "currency_code",
        F.col("amount_usd").cast("decimal(18,2)").alias("amount_usd"),
        "is_international",
        "is_high_value",
        "is_dispute",
        "is_refund",
        "is_risky",
    )


def token_join(transactions: DataFrame, accounts: DataFrame, attributes: Sequence[str]) -> DataFrame:
    """Totals per account joined to account attributes by token, without raw ids.

    Transactions are added up per token before the join, so the join sees one
    row per account on either side.
    """
    totals = transactions.groupBy("account_id_token").agg(
        F.count(F.lit(1)).alias("transactions"), F.sum("amount_cents").alias("cents")
    )
    return totals.join(accounts.select("account_id_token", *attributes), "account_id_token")


def rotate_tokens(rows: DataFrame, on_date: Column, keys: Sequence[RotatingKey], account: str = "account_id") -> DataFrame:
    """Add `token_key_id` and `account_id_token` under the key in force on a date."""
    stamped = rows.withColumn("_t", rotating_token(account, on_date, keys))
    return stamped.select(
        *rows.columns, F.col("_t.key_id").alias("token_key_id"), F.col("_t.token").alias("account_id_token")
    )


def token_remap(accounts: DataFrame, old: RotatingKey, new: RotatingKey, account: str = "account_id") -> DataFrame:
    """Old and new token of each account, to carry joins over a key change."""
    each = accounts.select(account).where(F.col(account).isNotNull()).distinct()
    tokens = {"old_token": rotating_token(account, F.current_date(), [old]), "new_token": rotating_token(account, F.current_date(), [new])}
    return each.select(*(t["token"].alias(name) for name, t in tokens.items()))


def retention_keep(rows: DataFrame, newest: date, days: int = RETENTION_DAYS, column: str = "event_date") -> DataFrame:
    """Rows of the last `days` days before `newest`.

    The bound is a literal, so on a table partitioned by date only the folders
    of these days are listed and read. `txnflow.sources.files.newest_day` finds
    the date in the folder names of such a table.
    """
    return rows.where(F.col(column) >= F.lit(newest - timedelta(days=days)))
