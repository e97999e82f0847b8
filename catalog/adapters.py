"""Test tables as card transactions.

`events` gives the messages of a topic. Each row becomes one or two deliveries;
the number `k` inside `props` (0 to 99) says what the producer does with it:

    k = 0        first delivery cut short, a good second delivery follows
    k = 1        cut short
    k = 2, 3     no transaction id
    k = 4, 5     amount sent as text
    k = 6        currency code too long
    k = 7        a second object after the payload
    90 <= k <= 94  delivered twice

Faulty messages reach the topic in one flush at the end of their day.
`orders` gives transactions over several years for the reports.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnflow.functions import MCC_CATEGORIES, TokenKey, plus_millis, tokenize_account_id
from txnflow.operators.dedupe import dedupe_in_batch
from txnflow.operators.parse import tag, valid_rows
from txnflow.operators.transform import landing_projection, transform
from txnflow.schema import PAYLOAD_NAMES

KEY = TokenKey(b"test-key-not-a-secret")

MCC_CODES = (*MCC_CATEGORIES, "0000")
CURRENCIES = ("USD", " usd ", "Eur", "gbp ")
EVENT_TYPE_OF = {"purchase": "AUTHORIZATION", "view": "SETTLEMENT", "click": "REFUND", "error": "CHARGEBACK"}
ORDER_TYPE_OF = {"F": "SETTLEMENT", "O": "AUTHORIZATION"}

_K = "_k"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame) -> DataFrame:
    """The same rows, dealt to all tasks alike: a file of few row groups is read by as few tasks, and what follows would be
    computed by these alone."""
    return rows.repartition(4 * rows.sparkSession.sparkContext.defaultParallelism)


def _pick(values: tuple[str, ...], index: Column) -> Column:
    return F.element_at(F.array(*(F.lit(v) for v in values)), (index % len(values) + 1).cast("int"))


def _map_type(column: Column, names: dict[str, str], other: str) -> Column:
    chain = None
    for name, mapped in names.items():
        chain = F.when(column == name, mapped) if chain is None else chain.when(column == name, mapped)
    return chain.otherwise(other)


def _iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def props_k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def transactions(events: DataFrame, *extra: str) -> DataFrame:
    """Payload rows of the `events` table, one per event."""
    event = F.col("event_id")
    k = F.col(_K) if _K in events.columns else props_k()
    return events.select(
        event.cast("string").alias("transaction_id"),
        F.concat(F.lit("ACC-"), F.col("user_id")).alias("account_id"),
        F.round(F.col("value") * 1000).cast("bigint").alias("amount_cents"),
        F.when(k == 6, "euros").otherwise(_pick(CURRENCIES, event)).alias("currency"),
        F.concat(F.lit("MERCH-"), event % 50).alias("merchant_id"),
        _pick(MCC_CODES, event).alias("merchant_category_code"),
        _map_type(F.col("event_type"), EVENT_TYPE_OF, "FEE").alias("event_type"),
        _iso(F.col("ts")).alias("event_timestamp"),
        F.lpad(F.col("user_id").cast("string"), 4, "0").alias("card_last_four"),
        (event % 7 == 0).alias("is_international"),
        F.create_map(F.lit("k"), k.cast("string")).alias("metadata"),
        *extra,
    )


def partial_events(events: DataFrame) -> DataFrame:
    """Payload rows in which a group of `k` values lacks one optional field each."""
    k = F.col("metadata")["k"].cast("int")
    gaps = {
        "currency": (10, 19),
        "merchant_category_code": (20, 29),
        "event_type": (30, 39),
        "card_last_four": (40, 49),
        "is_international": (50, 59),
        "metadata": (60, 69),
    }
    rows = transactions(events)
    return rows.withColumns({name: F.when(~k.between(*span), F.col(name)) for name, span in gaps.items()})


def envelopes(events: DataFrame) -> DataFrame:
    """Messages as a topic delivers them, faulty and repeated ones included."""
    # `props` is read once for each event.
    events, k = events.withColumn(_K, props_k()), F.col(_K)
    copies = F.when((k == 0) | k.between(90, 94), 2).otherwise(1)
    delivered = events.withColumn("delivery", F.explode(F.sequence(F.lit(1), copies)))
    extras = ("event_id", "user_id", "ts", "delivery", _K)
    rows = transactions(delivered, *extras)
    text = F.to_json(
        F.struct(
            F.when(~F.col(_K).isin(2, 3), F.col("transaction_id")).alias("transaction_id"),
            *PAYLOAD_NAMES[1:],
        )
    )
    cut_short = (F.col(_K) == 1) | ((F.col(_K) == 0) & (F.col("delivery") == 1))
    value = (
        F.when(cut_short, F.regexp_replace(text, r"\}$", ""))
        .when(F.col(_K) == 7, F.concat(text, F.lit(' {"more":1}')))
        .when(F.col(_K).isin(4, 5), F.regexp_replace(text, r'"amount_cents":(\d+)', '"amount_cents":"$1"'))
        .otherwise(text)
    )
    sent = F.when(
        cut_short | F.col(_K).isin(2, 3), F.date_trunc("day", "ts").cast("timestamp") + F.expr("INTERVAL 1 DAY")
    ).otherwise(F.col("ts").cast("timestamp") + F.make_dt_interval(secs=F.col("delivery") * 60 - 55))
    return rows.select(
        F.col("account_id").cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.lit("transactions").alias("topic"),
        (F.col("user_id") % 8).cast("int").alias("partition"),
        (F.col("event_id") * 2 + F.col("delivery") - 1).alias("offset"),
        sent.alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def latency_millis() -> Column:
    """Time to landing in the test data: 100 ms plus 19 ms per `k`."""
    return F.lit(100) + F.col("metadata")["k"].cast("int") * 19


def transformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid deliveries after the business projection, with a fixed ingest time."""
    rows = valid_rows(tag(envelopes(table(spark, sf_dir, "events"))))
    return transform(rows, KEY, ingested_at=plus_millis(F.col("kafka_timestamp"), latency_millis()))


def landed(spark: SparkSession, sf_dir: str, copies: bool = True) -> DataFrame:
    """Landing rows of all deliveries, or of one delivery per transaction."""
    rows = transformed(spark, sf_dir)
    return landing_projection(rows if copies else dedupe_in_batch(rows))


def without_position(rows: DataFrame) -> DataFrame:
    """Add the stream position columns, empty, to rows that come from no stream."""
    return rows.withColumns(
        {
            "kafka_timestamp": F.lit(None).cast("timestamp"),
            "partition": F.lit(None).cast("int"),
            "offset": F.lit(None).cast("bigint"),
        }
    )


def settled(spark: SparkSession, sf_dir: str, spread_rows: bool = False) -> DataFrame:
    """Landing rows with one clean row per event, for the models."""
    events = table(spark, sf_dir, "events")
    rows = without_position(transactions(spread(events) if spread_rows else events))
    return landing_projection(transform(rows, KEY, ingested_at=F.col("event_timestamp").cast("timestamp")))


def order_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing rows of the `orders` table."""
    order = F.col("o_orderkey")
    payload = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("ORD-"), order).alias("transaction_id"),
        F.concat(F.lit("ACC-"), F.col("o_custkey")).alias("account_id"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("amount_cents"),
        F.lit("USD").alias("currency"),
        F.concat(F.lit("MERCH-"), order % 100).alias("merchant_id"),
        _pick(MCC_CODES, order).alias("merchant_category_code"),
        F.when((F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "1-URGENT"), "CHARGEBACK")
        .when(F.col("o_orderpriority") == "5-LOW", "REFUND")
        .otherwise(_map_type(F.col("o_orderstatus"), ORDER_TYPE_OF, "FEE"))
        .alias("event_type"),
        _iso(F.col("o_orderdate")).alias("event_timestamp"),
        F.lpad(F.col("o_custkey").cast("string"), 4, "0").alias("card_last_four"),
        (order % 7 == 0).alias("is_international"),
        F.lit(None).cast("map<string,string>").alias("metadata"),
    )
    ingested = F.col("event_timestamp").cast("timestamp")
    return landing_projection(transform(without_position(payload), KEY, ingested_at=ingested))


def account_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounts by token from `customer`, one row per account."""
    raw = F.concat(F.lit("ACC-"), F.col("c_custkey"))
    return table(spark, sf_dir, "customer").select(
        tokenize_account_id(raw, KEY).alias("account_id_token"), F.col("c_mktsegment").alias("segment")
    )


def merchant_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merchants from `supplier`, one row per merchant."""
    return table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("MERCH-"), F.col("s_suppkey")).alias("merchant_id"), F.col("s_name").alias("merchant_name")
    )
