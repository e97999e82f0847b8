"""Sessions: an account's transactions with no longer pause between them than a gap."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

GAP = "30 minutes"
MINUTE_MICROS = 60_000_000
# Holds the sum of any number of bigints that a table can have.
WIDE = "decimal(38,0)"


def account_sessions(
    df: DataFrame, gap: str = GAP, account: str = "account_id_token", time: str = "event_ts", amount: str = "amount_cents"
) -> DataFrame:
    """(account, session_start, session_end, transactions, cents_total), one row per session.

    A transaction that comes more than `gap` after the account's last one begins
    a session; `session_end` is the last transaction's time plus the gap. Rows
    without a time are in no session.

    Rows are added up per account and minute (or gap, if that is shorter) first,
    on the map side too: two rows of one minute are never in two sessions. So an
    account is at most a row for each minute of its history, however busy it is.
    """
    micros = F.unix_micros(F.col(time).cast("timestamp"))
    pause = F.unix_micros(F.timestamp_micros(F.lit(0)) + F.expr(f"interval {gap}"))
    slots = (
        df.where(F.col(time).isNotNull())
        .select(F.col(account), micros.alias("_t"), F.col(amount).cast("decimal(20,0)").alias("_cents"))
        .groupBy(account, F.floor(F.col("_t") / F.least(pause, F.lit(MINUTE_MICROS))).alias("_slot"))
        .agg(F.min("_t").alias("_first"), F.max("_t").alias("_last"), F.count(F.lit(1)).alias("_n"), F.sum("_cents").cast(WIDE).alias("_cents"))
    )
    order = Window.partitionBy(account).orderBy("_slot")
    begins = F.coalesce(F.col("_first") - F.lag("_last").over(order) > pause, F.lit(True))
    numbered = slots.withColumn("_begins", begins.cast("int")).withColumn("_session", F.sum("_begins").over(order))
    return (
        numbered.groupBy(account, "_session")
        .agg(
            F.timestamp_micros(F.min("_first")).alias("session_start"),
            F.timestamp_micros(F.max("_last") + pause).alias("session_end"),
            F.sum("_n").alias("transactions"),
            F.sum("_cents").try_cast("bigint").alias("cents_total"),
        )
        .drop("_session")
    )
