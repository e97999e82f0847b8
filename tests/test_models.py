from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import functions as F

from tests.conftest import plan_of
from txnflow.operators.contract import data_tests, landing_constraint_violations
from txnflow.operators.dedupe import (
    batch_metrics,
    dedupe_in_batch,
    duplicate_count,
    late_merge,
    latest_versions,
    running_totals,
)
from txnflow.operators.sequence import account_order
from txnflow.plans import evolution, models, operations, reports
from txnflow.schema import LANDING_NAMES, LANDING_SCHEMA, PAYLOAD_SCHEMA

NOW = datetime(2024, 1, 2)


def landing(spark, *rows):
    """Landing rows with the given fields; others get harmless values."""
    base = {
        "transaction_id": "t",
        "account_id_token": "tok",
        "account_id": "[TOKENIZED]",
        "amount_cents": 100,
        "amount_dollars": Decimal("1.00"),
        "currency": "USD",
        "merchant_id": "M",
        "merchant_category_code": "5411",
        "mcc_category": "GROCERY",
        "event_type": "AUTHORIZATION",
        "event_ts": NOW,
        "card_last_four": "0000",
        "is_international": False,
        "is_high_value": False,
        "metadata": {},
        "kafka_partition": 0,
        "kafka_offset": 0,
        "ingested_at": NOW,
    }
    data = [tuple((base | r)[n] for n in LANDING_NAMES) for r in rows]
    return spark.createDataFrame(data, LANDING_SCHEMA).withColumn("event_date", F.to_date("event_ts"))


def test_dedupe_orders_by_offset_then_partition(spark):
    rows = spark.createDataFrame(
        [("a", 1, 5, "later"), ("a", 1, 4, "first"), ("a", 2, 4, "other partition"), ("b", 0, 9, "only")],
        "transaction_id string, partition int, offset bigint, v string",
    )
    got = dedupe_in_batch(rows)
    assert {r.transaction_id: r.v for r in got.collect()} == {"a": "first", "b": "only"}
    assert sorted(dedupe_in_batch(got).collect()) == sorted(got.collect())


def test_copies_are_reduced_before_the_shuffle(spark):
    rows = spark.range(100).select((F.col("id") % 3).cast("string").alias("transaction_id"), "id")
    plan = plan_of(dedupe_in_batch(rows.select("transaction_id", F.lit(0).alias("partition"), F.col("id").alias("offset"))))
    assert plan.index("Exchange") < plan.index("Partial"), "the partial limit runs below the exchange"
    assert "WindowGroupLimit" in plan


def test_duplicate_count(spark):
    rows = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "transaction_id string")
    assert duplicate_count(rows).first().asDict() == {"rows_in": 5, "distinct_ids": 3, "duplicates": 2}
    assert duplicate_count(rows.limit(0)).first().asDict() == {"rows_in": 0, "distinct_ids": 0, "duplicates": 0}


def test_running_totals_cross_blocks(spark):
    rows = spark.range(95).select((F.col("id") % 10).alias("batch_id"), F.col("id").cast("string").alias("transaction_id"))
    totals = running_totals(batch_metrics(rows), block=3).orderBy("batch_id").collect()
    assert [r.total_batches for r in totals] == list(range(1, 11))
    seen = 0
    for r in totals:
        seen += r.rows_written
        assert r.total_rows == seen
    assert seen == 95


def test_latest_version_wins_and_ties_are_stable(spark):
    versions = landing(
        spark,
        {"transaction_id": "a", "amount_cents": 1},
        {"transaction_id": "a", "amount_cents": 2, "ingested_at": datetime(2024, 1, 3)},
        {"transaction_id": "b", "amount_cents": 3, "kafka_offset": None, "kafka_partition": None},
        {"transaction_id": "b", "amount_cents": 4, "kafka_offset": None, "kafka_partition": None},
    )
    got = {r.transaction_id: r.amount_cents for r in latest_versions(versions).collect()}
    again = {r.transaction_id: r.amount_cents for r in latest_versions(versions.repartition(3)).collect()}
    assert got["a"] == 2 and got == again


def test_late_unique_row_reaches_staging(spark):
    existing = landing(spark, {"transaction_id": "a"})
    late = landing(spark, {"transaction_id": "late", "event_ts": datetime(2023, 1, 1), "ingested_at": NOW})
    staged = models.stg_card_transactions(late_merge(existing, late))
    assert {r.transaction_id for r in staged.collect()} == {"a", "late"}


def test_monthly_report(spark):
    rows = landing(
        spark,
        {"transaction_id": "1", "account_id_token": "x"},
        {"transaction_id": "2", "account_id_token": "x", "event_type": "CHARGEBACK"},
        {"transaction_id": "3", "account_id_token": "y", "amount_dollars": None},
        {"transaction_id": "4", "event_ts": datetime(2023, 12, 31)},
    )
    want = [
        (date(2024, 1, 1), 3, 2, Decimal("2.00"), Decimal("33.333")),
        (date(2023, 12, 1), 1, 1, Decimal("1.00"), Decimal("0.000")),
    ]
    assert [tuple(r) for r in reports.rpt_cfpb_monthly(rows).collect()] == want
    sketch = reports.rpt_cfpb_monthly(rows, approximate=True)
    assert [tuple(r)[:2] + tuple(r)[3:] for r in sketch.select(*reports.rpt_cfpb_monthly(rows).columns).collect()] == [
        w[:2] + w[3:] for w in want
    ]
    assert reports.cfpb_last_months(reports.rpt_cfpb_monthly(rows), 1).first().event_month == date(2024, 1, 1)


def test_cardholders_ignore_a_null_token(spark):
    rows = landing(spark, {"transaction_id": "1", "account_id_token": None}, {"transaction_id": "2"})
    row = reports.rpt_cfpb_monthly(rows).first()
    assert (row.transactions, row.cardholders) == (2, 1)


def test_kpis_have_subtotals(spark):
    rows = landing(
        spark,
        {"transaction_id": "1", "is_high_value": True},
        {"transaction_id": "2", "mcc_category": "HOTEL", "amount_dollars": Decimal("2.01"), "event_type": "REFUND"},
    )
    got = {(r.event_date, r.mcc_category): r for r in reports.rpt_executive_kpis(rows).collect()}
    assert set(got) == {(NOW.date(), "GROCERY"), (NOW.date(), "HOTEL"), (NOW.date(), None), (None, None)}
    total = got[None, None]
    assert (total.transactions, total.volume_usd, total.average_ticket) == (2, Decimal("3.01"), Decimal("1.51"))
    assert total.high_value_share == total.refund_share == Decimal("50.000")


def test_zscore_needs_spread(spark):
    days = [(i, d) for d, n in enumerate([2, 2, 3, 9], 1) for i in range(n)]
    rows = landing(spark, *({"transaction_id": f"{d}-{i}", "event_ts": datetime(2024, 1, d)} for i, d in days))
    scores = [r.zscore for r in reports.volume_zscore(rows).orderBy("event_day").collect()]
    assert scores[:3] == [None, None, None]
    assert abs(scores[3] - (9 - 7 / 3) / (1 / 3) ** 0.5) < 1e-6


def test_enrichment_joins(spark):
    staged = models.stg_card_transactions(
        landing(spark, {"transaction_id": "1"}, {"transaction_id": "2", "merchant_category_code": "9999", "merchant_id": "?"})
    )
    accounts = spark.createDataFrame([("tok", "gold")], "account_id_token string, segment string")
    merchants = spark.createDataFrame([("M", "Shop")], "merchant_id string, merchant_name string")
    dimension = models.mcc_dimension(spark)
    facts = models.int_enriched(staged, dimension, accounts, merchants)
    got = {r.transaction_id: (r.mcc_category, r.segment, r.merchant_name) for r in facts.collect()}
    assert got == {"1": ("GROCERY", "gold", "Shop"), "2": ("OTHER", "gold", None)}
    assert [r.transaction_id for r in models.unknown_mcc(staged, dimension, "mcc").collect()] == ["2"]
    assert [r.transaction_id for r in models.known_mcc(staged, dimension, "mcc").collect()] == ["1"]
    assert models.fct_transactions(facts).schema["amount_usd"].dataType.simpleString() == "decimal(18,2)"


def test_constraints(spark):
    rows = landing(
        spark,
        {"transaction_id": "ok"},
        {"transaction_id": "x" * 37, "currency": "EURO"},
        {"transaction_id": "n", "event_ts": None, "amount_dollars": None},
    )
    got = {r.transaction_id: r.violations for r in landing_constraint_violations(rows).collect()}
    assert got == {
        "x" * 37: ["transaction_id:length", "currency:length"],
        "n": ["amount_dollars:not_null", "event_ts:not_null"],
    }


def test_data_tests_report_zero_too(spark):
    rows = landing(spark, {"transaction_id": "1"}, {"transaction_id": "1", "event_type": "ODD", "merchant_id": "?"})
    parents = spark.createDataFrame([("M",)], "id string")
    result = data_tests(
        rows, ["transaction_id"], ["transaction_id"], {"event_type": ["AUTHORIZATION"]}, {"merchant_id": (parents, "id")}
    )
    assert {(r.check_name, r.column_name): r.failures for r in result.collect()} == {
        ("not_null", "transaction_id"): 0,
        ("accepted_values", "event_type"): 1,
        ("unique", "transaction_id"): 1,
        ("relationships", "merchant_id"): 1,
    }


def test_latency_quantile(spark):
    rows = spark.range(101).select(
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("kafka_timestamp"),
        F.timestamp_micros(F.unix_micros(F.lit("2024-01-01").cast("timestamp")) + F.col("id") * 1000).alias("ingested_at"),
    )
    assert operations.latency_quantile(rows).first().latency_ms == 99.0
    assert operations.latency_quantile(rows, approximate=True).first().latency_ms == 99


def test_account_order(spark):
    rows = landing(spark, *({"transaction_id": str(i), "account_id_token": str(i % 3), "event_ts": datetime(2024, 1, 28 - i)} for i in range(20)))
    ordered = account_order(rows, 3).withColumn("p", F.spark_partition_id()).collect()
    assert [(r.p, r.account_id_token, r.event_ts) for r in ordered] == sorted((r.p, r.account_id_token, r.event_ts) for r in ordered)
    assert [(r.account_id_token, r.event_ts) for r in ordered] == sorted((r.account_id_token, r.event_ts) for r in ordered)


def test_schema_changes():
    from pyspark.sql import types as T

    optional = T.StructType([*PAYLOAD_SCHEMA.fields, T.StructField("channel", T.StringType())])
    assert evolution.incompatible_changes(PAYLOAD_SCHEMA, optional) == []
    assert evolution.merged_schema(PAYLOAD_SCHEMA, optional).names[-1] == "channel"
    broken = T.StructType(
        [
            *(f for f in PAYLOAD_SCHEMA.fields if f.name not in ("currency", "amount_cents")),
            T.StructField("amount_cents", T.StringType(), False),
            T.StructField("needed", T.StringType(), False),
        ]
    )
    assert evolution.incompatible_changes(PAYLOAD_SCHEMA, broken) == [
        "removed:currency", "required:needed", "retyped:amount_cents",
    ]


def test_retention_counts_back_from_the_newest_day(spark):
    rows = landing(
        spark,
        {"transaction_id": "new", "event_ts": datetime(2024, 4, 1)},
        {"transaction_id": "edge", "event_ts": datetime(2024, 1, 2)},
        {"transaction_id": "old", "event_ts": datetime(2024, 1, 1)},
    )
    assert {r.transaction_id for r in models.retention_keep(rows, date(2024, 4, 1)).collect()} == {"new", "edge"}


def test_categories_are_broadcast_without_a_shuffle_of_the_facts(spark):
    rows = landing(spark, {"merchant_category_code": "5411"}, {"merchant_category_code": "0000"})
    for join in (models.unknown_mcc, models.known_mcc):
        plan = join(rows, models.mcc_dimension(spark))._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_rows_without_an_id_are_not_versions_of_each_other(spark):
    rows = landing(spark, {"transaction_id": None, "amount_cents": 1}, {"transaction_id": None, "amount_cents": 2}, {"transaction_id": "a"})
    assert models.stg_card_transactions(rows.unionByName(rows)).count() == 3
