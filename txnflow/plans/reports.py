"""Monthly regulatory report and daily KPIs.

The sources of these reports give names and samples only. Chosen here: a
dispute is a CHARGEBACK event; KPI contents are as listed in the functions.
Ratios are percentages with three decimals, rounded half up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from txnflow.functions import average_dollars, percent


def _is(event_type: str) -> Column:
    return F.upper("event_type") == event_type


def rpt_cfpb_monthly(transactions: DataFrame, approximate: bool = False) -> DataFrame:
    """Month, transactions, cardholders, volume and dispute rate, newest first.

    Rows are added up per month and account first, on the map side too. That
    one shuffle also makes cardholders countable, and no month, however large,
    is gathered in one task. `approximate` counts cardholders with a sketch
    instead and shuffles one row per task and month.
    """
    month = F.date_trunc("month", "event_ts").cast("date").alias("event_month")
    measures = [
        F.count(F.lit(1)).alias("n"),
        F.sum("amount_dollars").cast("decimal(38,2)").alias("volume"),
        F.count_if(_is("CHARGEBACK")).alias("disputes"),
    ]
    monthly = transactions.groupBy(month)
    if approximate:
        totals = monthly.agg(*measures, F.approx_count_distinct("account_id_token").alias("cardholders"))
    else:
        per_account = transactions.groupBy(month, "account_id_token").agg(*measures)
        totals = per_account.groupBy("event_month").agg(
            F.sum("n").alias("n"),
            F.sum("volume").cast("decimal(38,2)").alias("volume"),
            F.sum("disputes").alias("disputes"),
            F.count("account_id_token").alias("cardholders"),
        )
    return totals.select(
        "event_month",
        F.col("n").alias("transactions"),
        "cardholders",
        F.col("volume").alias("volume_usd"),
        percent(F.col("disputes"), F.col("n")).alias("dispute_rate"),
    ).orderBy(F.col("event_month").desc())


def cfpb_last_months(monthly: DataFrame, months: int = 13) -> DataFrame:
    """The newest months of the monthly report; a top-k over one row per month."""
    return monthly.orderBy(F.col("event_month").desc()).limit(months)


def daily_counts(transactions: DataFrame) -> DataFrame:
    return transactions.groupBy(F.date_trunc("day", "event_ts").cast("date").alias("event_day")).agg(
        F.count(F.lit(1)).alias("transactions")
    )


def rpt_executive_kpis(transactions: DataFrame) -> DataFrame:
    """Daily KPIs by category with subtotals per day and in total.

    Sums are formed per day and category first; the rollup then multiplies only
    those few rows, not the transactions. `grouping_level` tells subtotals from
    rows whose date or category is null: 0 for a day and category, 1 for a day,
    3 for the total.
    """
    base = transactions.groupBy(F.to_date("event_ts").alias("event_date"), "mcc_category").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("amount_dollars").cast("decimal(38,2)").alias("volume"),
        F.count("amount_dollars").alias("priced"),
        F.count_if("is_high_value").alias("high_value"),
        F.count_if("is_international").alias("international"),
        F.count_if(_is("REFUND")).alias("refunds"),
    )
    names = ("n", "priced", "high_value", "international", "refunds")
    totals = base.rollup("event_date", "mcc_category").agg(
        *(F.sum(name).alias(name) for name in names),
        F.sum("volume").cast("decimal(38,2)").alias("volume"),
        F.grouping_id().alias("grouping_level"),
    )
    n = F.col("n")
    return totals.select(
        "event_date",
        "mcc_category",
        F.col("grouping_level").cast("bigint").alias("grouping_level"),
        n.alias("transactions"),
        F.col("volume").alias("volume_usd"),
        average_dollars(F.col("volume"), F.col("priced")).alias("average_ticket"),
        percent(F.col("high_value"), n).alias("high_value_share"),
        percent(F.col("international"), n).alias("international_share"),
        percent(F.col("refunds"), n).alias("refund_share"),
    )


def volume_zscore(transactions: DataFrame, trailing_days: int = 7) -> DataFrame:
    """Daily count against mean and deviation of the days before it.

    The window runs over one row per day. Mean and deviation come from exact
    integer sums; the score is null until two earlier days with spread exist.
    """
    daily = daily_counts(transactions)
    before = Window.orderBy("event_day").rowsBetween(-trailing_days, -1)
    x = F.col("transactions")
    summed = daily.select(
        "event_day",
        "transactions",
        F.count(F.lit(1)).over(before).alias("_k"),
        F.sum(x).over(before).alias("_s"),
        F.sum(x * x).over(before).alias("_q"),
    )
    k, s = F.col("_k").cast("double"), F.col("_s").cast("double")
    spread = (F.col("_k") * F.col("_q") - F.col("_s") * F.col("_s")).cast("double")
    deviation = F.sqrt(F.try_divide(spread, k * (k - 1)))
    score = F.try_divide(x.cast("double") - F.try_divide(s, k), deviation)
    return summed.select("event_day", "transactions", F.when(spread > 0, F.round(score, 6)).alias("zscore"))
