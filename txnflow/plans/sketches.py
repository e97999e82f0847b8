"""Reports from stored sketches: distinct cardholders and latency quantiles without reading transactions again.

A sketch is a small binary value that merges with others of its kind, so tables
of daily or per-minute sketches give every longer period, and a late batch is
merged into what is stored.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnflow.functions import percent

#: Registers of a distinct-count sketch, as a power of two, and size of a quantile sketch.
LG_REGISTERS, QUANTILE_SIZE = 12, 1000
QUANTILES = (0.5, 0.95, 0.99)


def distinct_error(lg_registers: int = LG_REGISTERS) -> float:
    """The relative error that a distinct count exceeds in three of a thousand cases (three standard errors)."""
    return 3 * 1.04 / math.sqrt(2**lg_registers)


def rank_error(size: int = QUANTILE_SIZE) -> float:
    """The error of a quantile's rank, three times what 99 of 100 sketches of that size keep to."""
    return 3 * 2.296 / size**0.9723


def daily_sketches(transactions: DataFrame, lg_registers: int = LG_REGISTERS) -> DataFrame:
    """One row per day and category: counts, volume, and a sketch of the accounts. Null accounts are not counted.

    Tasks send one sketch for each day and category they have read, of some
    kilobytes at most, however many transactions there are.
    """
    return transactions.groupBy(F.to_date("event_ts").alias("event_date"), "mcc_category").agg(
        F.count(F.lit(1)).alias("transactions"),
        F.count_if(F.upper("event_type") == "CHARGEBACK").alias("disputes"),
        F.sum("amount_dollars").cast("decimal(38,2)").alias("volume_usd"),
        F.hll_sketch_agg("account_id_token", lg_registers).alias("accounts"),
    )


def _added(lg_merge: bool = True) -> list[Column]:
    return [
        *(F.sum(c).alias(c) for c in ("transactions", "disputes")),
        F.sum("volume_usd").cast("decimal(38,2)").alias("volume_usd"),
        F.hll_union_agg("accounts", F.lit(lg_merge)).alias("accounts"),
    ]


def merge_daily(stored: DataFrame, more: DataFrame) -> DataFrame:
    """Stored daily sketches and those of a later batch, as one table of the same form. Transactions must be in one of
    them only; accounts may be in both."""
    return stored.unionByName(more).groupBy("event_date", "mcc_category").agg(*_added())


def roll_up(daily: DataFrame, width: str = "month") -> DataFrame:
    """Counts, volume, dispute rate and estimated cardholders per period and category, with subtotals and the total.

    `grouping_level` is 0 for a period and category, 1 for a period, 3 for the
    total. Only the daily table is read.
    """
    period = F.date_trunc(width, F.col("event_date").cast("timestamp")).cast("date").alias("period")
    merged = daily.select("*", period).rollup("period", "mcc_category").agg(*_added(), F.grouping_id().alias("grouping_level"))
    return merged.select(
        "period",
        "mcc_category",
        F.col("grouping_level").cast("bigint").alias("grouping_level"),
        "transactions",
        F.hll_sketch_estimate("accounts").alias("cardholders"),
        "volume_usd",
        percent(F.col("disputes"), F.col("transactions")).alias("dispute_rate"),
    )


def latency_sketches(rows: DataFrame, size: int = QUANTILE_SIZE) -> DataFrame:
    """One row per minute of landing and topic partition: rows, and a sketch of broker-to-landing milliseconds."""
    micros = F.unix_micros(F.col("ingested_at").cast("timestamp")) - F.unix_micros(F.col("kafka_timestamp").cast("timestamp"))
    timed = rows.select(
        F.date_trunc("minute", "ingested_at").alias("minute"),
        F.col("kafka_partition"),
        F.floor(micros / 1000).cast("bigint").alias("ms"),
    )
    return timed.groupBy("minute", "kafka_partition").agg(
        F.count("ms").alias("rows"), F.kll_sketch_agg_bigint("ms", F.lit(size)).alias("latency")
    )


def latency_quantiles(sketches: DataFrame, width: str = "day", quantiles: Sequence[float] = QUANTILES, size: int = QUANTILE_SIZE) -> DataFrame:
    """(period, quantile, rows, latency_ms) from `latency_sketches`; periods without any latency have no rows.

    A period's sketch is merged from those of its minutes, on the map side too,
    so no task sees the latencies of a busy period, or their histogram.
    """
    merged = sketches.where("rows > 0").groupBy(F.date_trunc(width, "minute").alias("period")).agg(
        F.sum("rows").alias("rows"), F.kll_merge_agg_bigint("latency", F.lit(size)).alias("latency")
    )
    each = [
        F.struct(F.lit(float(q)).alias("quantile"), F.kll_sketch_get_quantile_bigint("latency", F.lit(float(q))).alias("latency_ms"))
        for q in quantiles
    ]
    return merged.select("period", "rows", F.inline(F.array(*each))).select("period", "quantile", "rows", "latency_ms")
