"""Dead letters, throughput and latency."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnflow.functions import percent
from txnflow.operators.dedupe import dedupe_in_batch
from txnflow.operators.parse import Routed, parse_and_validate


def reason_counts(dead_letters: DataFrame) -> DataFrame:
    return dead_letters.groupBy("dlq_reason").agg(F.count(F.lit(1)).alias("messages"))


def split_counts(tagged: DataFrame) -> DataFrame:
    """Messages in, valid and invalid, in one pass."""
    return tagged.agg(
        F.count(F.lit(1)).alias("messages"),
        F.count_if(F.col("dlq_reason").isNull()).alias("valid"),
        F.count_if(F.col("dlq_reason").isNotNull()).alias("invalid"),
    )


def dlq_rate(tagged: DataFrame) -> DataFrame:
    """Invalid share of all messages in percent."""
    return split_counts(tagged).select(
        "messages", "invalid", percent(F.col("invalid"), F.col("messages")).alias("dlq_rate")
    )


def replay(dead_letters: DataFrame, landed_ids: DataFrame, fix: Callable[[Column], Column], strict: bool = False) -> Routed:
    """Parse repaired payloads again and route them like new messages.

    `fix` maps the payload text to its repaired form. Rows that already landed,
    and repeats among the replayed rows, are left out. Dead letters are few and
    landed ids many: the ids are first cut down to those replayed, a join whose
    small side Spark can broadcast, so the landing table is not shuffled for it.
    """
    envelopes = dead_letters.select(
        F.col("kafka_key").cast("binary").alias("key"),
        fix(F.col("payload").cast("string")).cast("binary").alias("value"),
        "topic",
        "partition",
        "offset",
        F.col("kafka_timestamp").alias("timestamp"),
    )
    valid, invalid = parse_and_validate(envelopes, strict)
    unique = dedupe_in_batch(valid)
    replayed = unique.select("transaction_id")
    known = landed_ids.select("transaction_id").join(replayed, "transaction_id", "left_semi").distinct()
    return Routed(unique.join(known, "transaction_id", "left_anti"), invalid)


def throughput_per_minute(rows: DataFrame, time: str = "ingested_at") -> DataFrame:
    return rows.groupBy(F.date_trunc("minute", time).alias("minute")).agg(F.count(F.lit(1)).alias("transactions"))


def latency_quantile(
    rows: DataFrame,
    quantile: float = 0.99,
    width: str = "day",
    approximate: bool = False,
) -> DataFrame:
    """Quantile of broker-to-landing latency in milliseconds per period.

    Equal latencies are counted first, so the exact quantile of a busy period is
    taken from its histogram of whole milliseconds and not from its rows.
    """
    micros = F.unix_micros(F.col("ingested_at").cast("timestamp")) - F.unix_micros(F.col("kafka_timestamp"))
    timed = rows.select(
        F.date_trunc(width, "ingested_at").alias("period"), F.floor(micros / 1000).cast("bigint").alias("ms")
    )
    if approximate:
        return timed.groupBy("period").agg(F.percentile_approx("ms", quantile).alias("latency_ms"))
    histogram = timed.groupBy("period", "ms").agg(F.count(F.lit(1)).alias("n"))
    return histogram.groupBy("period").agg(F.percentile("ms", quantile, F.col("n")).alias("latency_ms"))
