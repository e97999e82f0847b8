"""Duplicates, models, reports and order-dependent signals."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.adapters import (
    account_dimension,
    landed,
    merchant_dimension,
    order_transactions,
    settled,
    transformed,
)
from catalog.registry import mean_sql, percent_sql, query
from txnflow.operators.dedupe import batch_metrics, dedupe_in_batch, duplicate_count, late_merge, running_totals
from txnflow.operators.sequence import account_sequence, distinct_in_span, inter_txn_gap, velocity
from txnflow.plans.baseline import (
    LEVEL_RATES,
    SEASON_RATES,
    SPIKE_DEVIATIONS,
    USED_CHANGES,
    daily_volume,
    volume_baseline,
)
from txnflow.plans.buckets import bucketed_table
from txnflow.plans.models import (
    fct_transactions,
    int_enriched,
    known_mcc,
    mcc_dimension,
    stg_card_transactions,
    token_join,
    unknown_mcc,
)
from txnflow.session import cut_lineage
from txnflow.plans.reports import (
    cfpb_last_months,
    daily_counts,
    rpt_cfpb_monthly,
    rpt_executive_kpis,
    volume_zscore,
)


@query("daily_counts", "SELECT event_date AS event_day, count(*) AS transactions FROM settled GROUP BY 1")
def by_day(spark, sf_dir):
    return daily_counts(settled(spark, sf_dir))


@query(
    "dedupe_in_batch",
    "SELECT transaction_id, account_id_token, amount_cents, kafka_partition, kafka_offset FROM first_delivery",
)
def deduped(spark, sf_dir):
    rows = dedupe_in_batch(transformed(spark, sf_dir))
    return rows.select(
        "transaction_id",
        "account_id_token",
        "amount_cents",
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
    )


@query(
    "duplicate_count",
    """SELECT count(*) AS rows_in, count(DISTINCT transaction_id) AS distinct_ids,
              count(*) - count(DISTINCT transaction_id) AS duplicates FROM valid""",
)
def duplicates(spark, sf_dir):
    return duplicate_count(transformed(spark, sf_dir))


def _batched(spark, sf_dir):
    """Landed deliveries with a batch number: the day of the event."""
    day = F.date_diff("event_date", F.lit("2024-01-01").cast("date")).cast("bigint")
    return landed(spark, sf_dir).withColumn("batch_id", day)


_BATCH_SQL = """SELECT CAST(event_date - DATE '2024-01-01' AS BIGINT) AS batch_id, count(*) AS rows_in,
                       count(*) - count(DISTINCT transaction_id) AS duplicates,
                       count(DISTINCT transaction_id) AS rows_written FROM landed GROUP BY 1"""


@query("batch_counts", _BATCH_SQL)
def batch_counts(spark, sf_dir):
    return batch_metrics(_batched(spark, sf_dir))


@query(
    "batch_running_totals",
    f"""SELECT *, count(*) OVER w AS total_batches, CAST(sum(rows_written) OVER w AS BIGINT) AS total_rows
        FROM ({_BATCH_SQL}) WINDOW w AS (ORDER BY batch_id)""",
)
def batch_totals(spark, sf_dir):
    return running_totals(batch_metrics(_batched(spark, sf_dir)))


@query(
    "stg_card_transactions",
    """SELECT transaction_id, account_id_token, amount_cents AS amount_minor, amount_dollars AS amount_usd,
              currency AS currency_code, merchant_id, merchant_category_code AS mcc, mcc_category,
              lower(event_type) AS event_type, event_ts AS event_at, event_date, card_last_four AS card_last4,
              is_international, is_high_value, ingested_at
       FROM landed QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY ingested_at DESC) = 1""",
)
def staging(spark, sf_dir):
    return stg_card_transactions(landed(spark, sf_dir))


@query(
    "late_merge",
    """SELECT transaction_id, CASE WHEN k BETWEEN 70 AND 79 THEN amount_cents + 100 ELSE amount_cents END
                  AS amount_cents,
              CASE WHEN k BETWEEN 70 AND 79 THEN ts + INTERVAL 1 DAY ELSE ts END AS ingested_at FROM settled""",
)
def merged(spark, sf_dir):
    """Transactions corrected a day later replace the first version."""
    existing = settled(spark, sf_dir)
    corrected = existing.where(F.col("metadata")["k"].cast("int").between(70, 79)).withColumns(
        {
            "amount_cents": F.col("amount_cents") + 100,
            "ingested_at": F.col("ingested_at") + F.expr("INTERVAL 1 DAY"),
        }
    )
    return late_merge(existing, corrected).select("transaction_id", "amount_cents", "ingested_at")


def _enriched(spark, sf_dir):
    landing = settled(spark, sf_dir)
    return int_enriched(
        stg_card_transactions(landing),
        mcc_dimension(spark),
        account_dimension(spark, sf_dir),
        merchant_dimension(spark, sf_dir),
    )


_ENRICHED_SQL = """SELECT s.transaction_id, s.account_id_token, s.merchant_id, a.segment, m.merchant_name,
                          s.mcc_category, s.event_type = 'CHARGEBACK' AS is_dispute,
                          s.event_type = 'REFUND' AS is_refund,
                          s.is_high_value AND s.is_international AS is_risky
                   FROM settled s LEFT JOIN account_dim a USING (account_id_token)
                                  LEFT JOIN merchant_dim m USING (merchant_id)"""


@query("int_enriched", _ENRICHED_SQL)
def enriched(spark, sf_dir):
    return _enriched(spark, sf_dir).select(
        "transaction_id",
        "account_id_token",
        "merchant_id",
        "segment",
        "merchant_name",
        "mcc_category",
        "is_dispute",
        "is_refund",
        "is_risky",
    )


@query(
    "fct_transactions",
    """SELECT transaction_id, account_id_token, merchant_id, event_date, event_ts AS event_at,
              lower(event_type) AS event_type, merchant_category_code AS mcc, mcc_category,
              upper(trim(currency)) AS currency_code, amount_dollars AS amount_usd, is_international, is_high_value,
              event_type = 'CHARGEBACK' AS is_dispute, event_type = 'REFUND' AS is_refund,
              is_high_value AND is_international AS is_risky FROM settled""",
)
def facts(spark, sf_dir):
    return fct_transactions(_enriched(spark, sf_dir))


_CODES = "('5411','5812','5541','4111','5912','5732','7011','4511','5999','6011')"


@query(
    "unknown_mcc",
    f"""SELECT transaction_id, merchant_category_code FROM settled WHERE merchant_category_code NOT IN {_CODES}""",
)
def unknown(spark, sf_dir):
    rows = unknown_mcc(settled(spark, sf_dir), mcc_dimension(spark))
    return rows.select("transaction_id", "merchant_category_code")


@query(
    "known_mcc",
    f"""SELECT transaction_id, merchant_category_code FROM settled WHERE merchant_category_code IN {_CODES}""",
)
def known(spark, sf_dir):
    rows = known_mcc(settled(spark, sf_dir), mcc_dimension(spark))
    return rows.select("transaction_id", "merchant_category_code")


@query("rpt_cfpb_monthly", "SELECT * FROM monthly")
def monthly_report(spark, sf_dir):
    return rpt_cfpb_monthly(order_transactions(spark, sf_dir))


@query("cfpb_last_13", "SELECT * FROM monthly ORDER BY event_month DESC LIMIT 13")
def last_13(spark, sf_dir):
    return cfpb_last_months(rpt_cfpb_monthly(order_transactions(spark, sf_dir)), 13)


@query(
    "rpt_executive_kpis",
    f"""SELECT event_date, mcc_category, CAST(GROUPING(event_date, mcc_category) AS BIGINT) AS grouping_level,
               count(*) AS transactions, CAST(sum(amount_dollars) AS DECIMAL(38,2)) AS volume_usd,
               {mean_sql("sum(amount_cents)", "count(*)")} AS average_ticket,
               {percent_sql("count(*) FILTER (is_high_value)", "count(*)")} AS high_value_share,
               {percent_sql("count(*) FILTER (is_international)", "count(*)")} AS international_share,
               {percent_sql("count(*) FILTER (event_type = 'REFUND')", "count(*)")} AS refund_share
        FROM (SELECT * REPLACE (CASE WHEN event_date <> DATE '1995-01-01' THEN event_date END AS event_date) FROM ordered)
        GROUP BY ROLLUP (event_date, mcc_category)""",
)
def kpis(spark, sf_dir):
    """Orders of one day count as undated, so that rows without a date and subtotals meet."""
    rows = order_transactions(spark, sf_dir)
    undated = F.col("event_date") == F.lit("1995-01-01").cast("date")
    return rpt_executive_kpis(rows.withColumn("event_ts", F.when(~undated, F.col("event_ts"))))


@query(
    "account_sequence",
    """SELECT transaction_id, account_id_token,
              row_number() OVER (PARTITION BY account_id_token ORDER BY event_ts, transaction_id) AS sequence_no
       FROM settled""",
)
def sequence(spark, sf_dir):
    rows = settled(spark, sf_dir).select("transaction_id", "account_id_token", "event_ts")
    return account_sequence(rows).drop("event_ts")


@query(
    "inter_txn_gap",
    """SELECT transaction_id, epoch_us(event_ts) - epoch_us(lag(event_ts) OVER
              (PARTITION BY account_id_token ORDER BY event_ts, transaction_id)) AS gap_micros FROM settled""",
)
def gap(spark, sf_dir):
    rows = settled(spark, sf_dir).select("transaction_id", "account_id_token", "event_ts")
    return inter_txn_gap(rows).select("transaction_id", "gap_micros")


@query(
    "velocity_1h",
    """SELECT transaction_id, count(*) OVER w AS txn_count, CAST(sum(amount_cents) OVER w AS BIGINT) AS cents_total
       FROM settled WINDOW w AS (PARTITION BY account_id_token ORDER BY event_ts
                                 RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW)""",
)
def velocity_1h(spark, sf_dir):
    rows = settled(spark, sf_dir).select("transaction_id", "account_id_token", "event_ts", "amount_cents")
    return velocity(rows).select("transaction_id", "txn_count", "cents_total")


@query(
    "distinct_merchants_1h",
    """SELECT a.transaction_id, count(DISTINCT b.merchant_id) AS distinct_merchants
       FROM settled a JOIN settled b ON b.account_id_token = a.account_id_token
            AND b.event_ts BETWEEN a.event_ts - INTERVAL 1 HOUR AND a.event_ts
       GROUP BY a.transaction_id""",
)
def merchants_1h(spark, sf_dir):
    rows = settled(spark, sf_dir).select("transaction_id", "account_id_token", "event_ts", "merchant_id")
    return distinct_in_span(rows).select("transaction_id", "distinct_merchants")


@query(
    "bucketed_accounts",
    """SELECT transaction_id, segment, row_number() OVER (PARTITION BY s.account_id_token ORDER BY event_ts, transaction_id) AS sequence_no,
              count(*) OVER w AS txn_count, CAST(sum(amount_cents) OVER w AS BIGINT) AS cents_total
       FROM settled s LEFT JOIN account_dim d ON s.account_id_token = d.account_id_token
       WINDOW w AS (PARTITION BY s.account_id_token ORDER BY event_ts RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW)""",
)
def bucketed(spark, sf_dir):
    """Sequence, velocity and the account join on tables that are stored by buckets of accounts."""
    names = ("transaction_id", "account_id_token", "event_ts", "amount_cents")
    with bucketed_table(settled(spark, sf_dir).select(*names)) as rows, bucketed_table(account_dimension(spark, sf_dir)) as accounts:
        found = velocity(account_sequence(rows)).join(accounts, "account_id_token", "left")
        return cut_lineage(found.select("transaction_id", "segment", "sequence_no", "txn_count", "cents_total"))


@query(
    "volume_zscore",
    """SELECT event_day, transactions,
              CASE WHEN k * q - CAST(s AS DOUBLE) * s > 0
                   THEN round((transactions - s / k) / sqrt((k * q - CAST(s AS DOUBLE) * s) / (k * (k - 1))), 6) END
                  AS zscore
       FROM (SELECT event_day, transactions, CAST(count(*) OVER p AS DOUBLE) AS k,
                    CAST(sum(transactions) OVER p AS BIGINT) AS s,
                    CAST(sum(transactions * transactions) OVER p AS BIGINT) AS q
             FROM (SELECT event_date AS event_day, count(*) AS transactions FROM ordered GROUP BY 1)
             WINDOW p AS (ORDER BY event_day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))""",
)
def zscore(spark, sf_dir):
    return volume_zscore(order_transactions(spark, sf_dir))


@query(
    "token_join",
    """SELECT account_id_token, count(*) AS transactions, CAST(sum(amount_cents) AS BIGINT) AS cents, segment
       FROM settled JOIN account_dim USING (account_id_token) GROUP BY account_id_token, segment""",
)
def joined_by_token(spark, sf_dir):
    return token_join(settled(spark, sf_dir), account_dimension(spark, sf_dir), ["segment"])


def _values_sql(values) -> str:
    return "[" + ", ".join(f"CAST({v} AS DOUBLE)" for v in values) + "]"


@query(
    "volume_baseline",
    f"""SELECT * FROM (
        WITH RECURSIVE days AS (
            SELECT CAST(unnest(generate_series(min(event_date), max(event_date), INTERVAL 1 DAY)) AS DATE) AS event_day
            FROM ordered),
        series AS MATERIALIZED (
            SELECT mcc_category, event_day, row_number() OVER (PARTITION BY mcc_category ORDER BY event_day) - 1 AS t,
                   coalesce(n, 0) AS n
            FROM (SELECT DISTINCT mcc_category FROM ordered) CROSS JOIN days
                 LEFT JOIN (SELECT mcc_category, event_date AS event_day, count(*) AS n FROM ordered GROUP BY ALL)
                      USING (mcc_category, event_day)),
        bounds AS (
            SELECT a.mcc_category, CAST({USED_CHANGES} AS DOUBLE) * CAST(1.4826 AS DOUBLE)
                   * greatest(CAST(quantile_disc(abs(b.n - a.n), 0.5) AS DOUBLE), 1) AS bound
            FROM series a JOIN series b ON a.mcc_category = b.mcc_category AND b.t = a.t + 7 GROUP BY 1),
        starts AS (
            SELECT mcc_category, list(CAST(n AS DOUBLE) ORDER BY t) AS x, CAST(sum(n) AS DOUBLE) / 7 AS level
            FROM series WHERE t < 7 GROUP BY 1),
        walk AS (
            SELECT mcc_category, a, g, bound, CAST(6 AS BIGINT) AS t, level, list_transform(x, lambda v: v - level) AS season,
                   CAST(0 AS DOUBLE) AS lost, CAST(NULL AS DOUBLE) AS error
            FROM starts JOIN bounds USING (mcc_category), unnest({_values_sql(LEVEL_RATES)}) AS l(a),
                 unnest({_values_sql(SEASON_RATES)}) AS s(g)
            UNION ALL
            SELECT mcc_category, a, g, bound, t, level + a * used, list_append(season[2:], season[1] + g * used),
                   lost + abs(used), error
            FROM (SELECT *, greatest(least(error, bound), -bound) AS used
                  FROM (SELECT w.mcc_category, a, g, bound, s.t, level, season, lost,
                               CAST(s.n AS DOUBLE) - (level + season[1]) AS error
                        FROM walk w JOIN series s ON s.mcc_category = w.mcc_category AND s.t = w.t + 1))),
        best AS (
            SELECT mcc_category, a, g FROM walk WHERE t = (SELECT max(t) FROM series)
            QUALIFY row_number() OVER (PARTITION BY mcc_category ORDER BY lost, a, g) = 1),
        errors AS (SELECT mcc_category, t, error FROM walk JOIN best USING (mcc_category, a, g) WHERE t > 6),
        middles AS (SELECT mcc_category, quantile_disc(error, 0.5) AS middle FROM errors GROUP BY 1),
        scales AS (
            SELECT mcc_category, middle,
                   greatest(CAST(1.4826 AS DOUBLE) * quantile_disc(abs(error - middle), 0.5), 1) AS scale
            FROM errors JOIN middles USING (mcc_category) GROUP BY ALL)
        SELECT mcc_category, event_day, n AS transactions, round(n - error, 6) AS forecast,
               round((error - middle) / scale, 6) AS score,
               coalesce(abs((error - middle) / scale) > {SPIKE_DEVIATIONS}, FALSE) AS is_spike
        FROM series LEFT JOIN errors USING (mcc_category, t) LEFT JOIN scales USING (mcc_category))""",
)
def baseline(spark, sf_dir):
    return volume_baseline(daily_volume(order_transactions(spark, sf_dir)))
