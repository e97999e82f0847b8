"""Reports from sketches against exact counts."""

from decimal import Decimal

from pyspark.sql import functions as F

from txnflow.plans.sketches import daily_sketches, distinct_error, latency_quantiles, latency_sketches, merge_daily, rank_error, roll_up


def transactions(spark, n=60_000):
    return spark.range(n).select(
        (F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(days=(F.col("id") % 150).cast("int"))).alias("event_ts"),
        F.when(F.col("id") % 997 != 0, F.element_at(F.array(F.lit("A"), F.lit("B")), (F.col("id") % 2 + 1).cast("int"))).alias("mcc_category"),
        F.when(F.col("id") % 10 == 0, "chargeback").otherwise("REFUND").alias("event_type"),
        F.lit("1.50").cast("decimal(18,2)").alias("amount_dollars"),
        F.when(F.col("id") % 50 != 0, F.concat(F.lit("acc"), F.pmod(F.xxhash64("id"), F.lit(20_000)))).alias("account_id_token"),
    )


def test_roll_up_is_near_exact_counts(spark):
    rows = transactions(spark)
    daily = daily_sketches(rows)
    assert daily.count() == rows.select(F.to_date("event_ts"), "mcc_category").distinct().count()
    for width in ("month", "quarter", "year"):
        period = F.date_trunc(width, "event_ts").cast("date").alias("period")
        exact = rows.rollup(period, "mcc_category").agg(
            F.grouping_id().alias("grouping_level"), F.count(F.lit(1)).alias("n"), F.count_distinct("account_id_token").alias("accounts")
        )
        want = {tuple(r)[:3]: (r["n"], r["accounts"]) for r in exact.collect()}
        got = roll_up(daily, width).collect()
        assert len(got) == len(want)
        for r in got:
            n, accounts = want[r["period"], r["mcc_category"], r["grouping_level"]]
            assert r["transactions"] == n and r["volume_usd"] == n * Decimal("1.50")
            assert abs(r["cardholders"] - accounts) <= max(1, accounts * distinct_error())
    assert [r["dispute_rate"] for r in roll_up(daily, "year").where("grouping_level = 3").collect()] == [Decimal("10.000")]


def test_a_late_batch_is_merged_into_stored_sketches(spark):
    rows = transactions(spark, 20_000)
    late = F.pmod(F.xxhash64("event_ts", "account_id_token"), F.lit(3)) == 0
    merged = merge_daily(daily_sketches(rows.where(~late)), daily_sketches(rows.where(late)))
    names = ["period", "mcc_category", "grouping_level", "transactions", "volume_usd", "dispute_rate"]
    whole, parts = roll_up(daily_sketches(rows)), roll_up(merged)
    assert merged.count() == daily_sketches(rows).count()
    assert sorted(map(str, whole.select(*names).collect())) == sorted(map(str, parts.select(*names).collect()))
    a, b = ({str(tuple(r)[:3]): r["cardholders"] for r in f.collect()} for f in (whole, parts))
    assert all(abs(a[k] - b[k]) <= max(2, 2 * distinct_error() * a[k]) for k in a)


def test_a_roll_up_reads_the_stored_table_only(spark, tmp_path):
    daily_sketches(transactions(spark, 5_000)).write.parquet(str(tmp_path / "daily"))
    stored = spark.read.parquet(str(tmp_path / "daily"))
    plan = roll_up(stored)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "account_id_token" not in plan


def test_quantiles_keep_their_rank(spark):
    rows = spark.range(200_000).select(
        F.timestamp_micros(F.lit(1_700_000_000_000_000) + F.col("id") * 700_000).alias("kafka_timestamp"), (F.col("id") % 8).cast("int").alias("kafka_partition"), "id"
    )
    ms = F.pmod(F.xxhash64("id"), F.lit(50_000))
    rows = rows.withColumn("ingested_at", F.timestamp_micros(F.unix_micros("kafka_timestamp") + ms * 1000))
    sketches = latency_sketches(rows)
    for width in ("hour", "day"):
        for r in latency_quantiles(sketches, width, (0.01, 0.5, 0.99)).collect():
            own = rows.where(F.date_trunc(width, "ingested_at") == F.lit(r["period"])).agg(F.count_if(ms <= r["latency_ms"]), F.count(F.lit(1))).first() if width == "day" else None
            if own:
                assert own[1] == r["rows"] and abs(own[0] / own[1] - r["quantile"]) <= rank_error() + 1e-3
    whole = latency_quantiles(sketches, "year", (0.5,)).agg(F.sum("rows")).first()[0]
    assert whole == 200_000
    assert latency_quantiles(latency_sketches(rows.limit(0))).count() == 0
