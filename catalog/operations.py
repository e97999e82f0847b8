"""Data tests, alerts, throughput and latency."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.adapters import account_dimension, envelopes, landed, order_transactions, table, transformed
from catalog.registry import query
from txnflow.operators.contract import data_tests
from txnflow.operators.parse import parse_and_validate
from txnflow.plans.models import mcc_dimension
from txnflow.plans.operations import latency_quantile, throughput_per_minute
from txnflow.plans.sketches import daily_sketches, distinct_error, latency_quantiles, latency_sketches, merge_daily, rank_error, roll_up
from txnflow.session import cut_lineage
from txnflow.streaming.views import dead_letter_spikes

_TYPES = ("AUTHORIZATION", "SETTLEMENT", "REFUND", "CHARGEBACK")
_CODES = "('5411','5812','5541','4111','5912','5732','7011','4511','5999','6011')"


@query(
    "data_quality_checks",
    f"""SELECT 'not_null' AS check_name, 'transaction_id' AS column_name,
               count(*) FILTER (transaction_id IS NULL) AS failures FROM landed
        UNION ALL SELECT 'not_null', 'amount_cents', count(*) FILTER (amount_cents IS NULL) FROM landed
        UNION ALL SELECT 'accepted_values', 'event_type', count(*) FILTER (event_type NOT IN {_TYPES}) FROM landed
        UNION ALL SELECT 'unique', 'transaction_id', count(*) FROM
                  (SELECT transaction_id FROM landed GROUP BY 1 HAVING count(*) > 1)
        UNION ALL SELECT 'relationships', 'merchant_category_code',
                  count(*) FILTER (merchant_category_code NOT IN {_CODES}) FROM landed
        UNION ALL SELECT 'relationships', 'account_id_token', count(*) FROM landed
                  WHERE account_id_token NOT IN (SELECT account_id_token FROM account_dim)""",
)
def checks(spark, sf_dir):
    return data_tests(
        landed(spark, sf_dir),
        not_null=["transaction_id", "amount_cents"],
        unique=["transaction_id"],
        accepted={"event_type": _TYPES},
        relationships={
            "merchant_category_code": (mcc_dimension(spark), "merchant_category_code"),
            "account_id_token": (account_dimension(spark, sf_dir), "account_id_token"),
        },
    )


@query(
    "dlq_spike_minutes",
    """SELECT date_trunc('minute', kafka_timestamp) AS window_start,
              date_trunc('minute', kafka_timestamp) + INTERVAL 1 MINUTE AS window_end, count(*) AS messages
       FROM refused GROUP BY 1, 2 HAVING count(*) > 10""",
)
def spikes(spark, sf_dir):
    letters = parse_and_validate(envelopes(table(spark, sf_dir, "events"))).invalid
    found = dead_letter_spikes(letters, more_than=10, delay=None)
    zoneless = {name: F.col(name).cast("timestamp_ntz") for name in ("window_start", "window_end")}
    return found.withColumns(zoneless)


@query(
    "throughput_per_minute",
    """SELECT date_trunc('minute', ingested_at) AS minute, count(*) AS transactions FROM landed GROUP BY 1""",
)
def throughput(spark, sf_dir):
    rows = throughput_per_minute(landed(spark, sf_dir))
    return rows.withColumn("minute", F.col("minute").cast("timestamp_ntz"))


@query(
    "latency_p99",
    """SELECT date_trunc('day', ingested_at) AS period,
              round(quantile_cont(CAST(100 + 19 * k AS DOUBLE), 0.99), 3) AS latency_ms FROM landed GROUP BY 1""",
)
def latency(spark, sf_dir):
    rows = latency_quantile(transformed(spark, sf_dir))
    return rows.select(
        F.col("period").cast("timestamp_ntz").alias("period"), F.round("latency_ms", 3).alias("latency_ms")
    )


@query(
    "sketch_cardholders",
    """SELECT w AS width, CAST(date_trunc(w, event_ts) AS DATE) AS period, mcc_category,
              GROUPING(date_trunc(w, event_ts), mcc_category) AS grouping_level, count(*) AS transactions,
              CAST(sum(amount_dollars) AS DECIMAL(38,2)) AS volume_usd,
              count(DISTINCT account_id_token) AS cardholders, TRUE AS within_bound
       FROM ordered, (SELECT unnest(['month', 'quarter']) AS w)
       GROUP BY GROUPING SETS ((w, date_trunc(w, event_ts), mcc_category), (w, date_trunc(w, event_ts)), (w))""",
)
def cardholders(spark, sf_dir):
    """Months, quarters and subtotals from stored daily sketches, held against exact counts.

    The sketches of even and odd orders are made apart and merged, as those of a later batch are.
    """
    rows = order_transactions(spark, sf_dir)
    late = F.pmod(F.xxhash64("transaction_id"), F.lit(2)) == 1
    daily = cut_lineage(merge_daily(daily_sketches(rows.where(~late)), daily_sketches(rows.where(late))), "daily-sketches")
    found = None
    for width in ("month", "quarter"):
        period = F.date_trunc(width, F.col("event_ts").cast("timestamp")).cast("date").alias("period")
        exact = rows.select(period, "mcc_category", "account_id_token").distinct().rollup("period", "mcc_category")
        exact = exact.agg(F.count_distinct("account_id_token").alias("exact"), F.grouping_id().cast("bigint").alias("grouping_level"))
        keys = [F.col(f"r.{c}").eqNullSafe(F.col(f"e.{c}")) for c in ("period", "mcc_category", "grouping_level")]
        both = roll_up(daily, width).alias("r").join(exact.alias("e"), keys).select(F.lit(width).alias("width"), "r.*", "exact")
        found = both if found is None else found.unionByName(both)
    bound = F.ceil(F.col("exact") * distinct_error())
    within = F.abs(F.col("cardholders") - F.col("exact")) <= bound
    return found.select(
        "width", "period", "mcc_category", "grouping_level", "transactions", "volume_usd", F.col("exact").alias("cardholders"), within.alias("within_bound")
    )


@query(
    "latency_sketch",
    """SELECT date_trunc('day', ingested_at) AS period, quantile, count(*) AS rows, TRUE AS within_bound
       FROM landed, (SELECT unnest([0.5::DOUBLE, 0.95::DOUBLE, 0.99::DOUBLE]) AS quantile) GROUP BY 1, 2""",
)
def latency_from_sketches(spark, sf_dir):
    """Daily quantiles merged from sketches of minutes and partitions, their ranks held against all latencies."""
    rows = transformed(spark, sf_dir).withColumnRenamed("partition", "kafka_partition")
    sketches = cut_lineage(latency_sketches(rows), "latency-sketches")
    estimated = latency_quantiles(sketches)
    micros = F.unix_micros("ingested_at") - F.unix_micros("kafka_timestamp")
    counts = rows.groupBy(F.date_trunc("day", "ingested_at").alias("period"), F.floor(micros / 1000).alias("ms")).agg(F.count(F.lit(1)).alias("n"))
    ranked = counts.join(estimated, "period").groupBy("period", "quantile", "rows").agg(
        (F.sum(F.when(F.col("ms") < F.col("latency_ms"), F.col("n")).otherwise(0)) / F.first("rows")).alias("below"),
        (F.sum(F.when(F.col("ms") <= F.col("latency_ms"), F.col("n")).otherwise(0)) / F.first("rows")).alias("upto"),
    )
    error = rank_error()
    within = (F.col("below") - error <= F.col("quantile")) & (F.col("quantile") <= F.col("upto") + error)
    return ranked.select(F.col("period").cast("timestamp_ntz").alias("period"), "quantile", "rows", within.alias("within_bound"))
