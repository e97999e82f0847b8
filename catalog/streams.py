"""Streams over the whole events table, run until all input is read, and their results."""

from __future__ import annotations

from dataclasses import replace
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog.adapters import KEY, envelopes, settled, spread, table, transactions
from catalog.ingest import STAGED_NAMES, STAGED_SQL, staged_files
from catalog.registry import query, token_sql
from txnflow.functions import RotatingKey, TokenKey
from txnflow.operators.parse import tag, valid_rows
from txnflow.operators.sessions import account_sessions
from txnflow.operators.transform import transform
from txnflow.schema import LANDING_SCHEMA, PAYLOAD_SCHEMA
from txnflow.session import scratch_path
from txnflow.sinks.committed import CommittedSink, read_committed
from txnflow.sinks.landing import FileSink
from txnflow.sources.files import stream_envelopes, stream_staged_json
from txnflow.streaming.accounts import account_signals, state_store, stream_sessions
from txnflow.streaming.live import LiveMetrics, read_live
from txnflow.streaming.pipeline import MicroBatchWriter, PipelineConfig, start_file_ingest, start_pipeline
from txnflow.streaming.views import dedupe_within_watermark

ONCE = {"availableNow": True}


def stream_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a stream of envelopes."""
    schema = table(spark, sf_dir, "events").schema
    return envelopes(spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir))


def _config(spark: SparkSession, **settings) -> tuple[PipelineConfig, str]:
    root = scratch_path(spark, "stream")
    config = PipelineConfig(
        landing=FileSink(f"{root}/landing"),
        dead_letters=FileSink(f"{root}/dead-letters", partition_by=()),
        metrics=FileSink(f"{root}/metrics", partition_by=()),
        checkpoint=f"{root}/checkpoint",
        trigger=ONCE,
        **settings,
    )
    return config, root


def run_pipeline(spark: SparkSession, sf_dir: str, key=KEY, **settings) -> str:
    config, root = _config(spark, **settings)
    start_pipeline(stream_messages(spark, sf_dir), config, key).awaitTermination()
    return root


def split_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages of a week in some micro-batches of their own; second deliveries come a week later."""
    week = F.floor((F.dayofmonth("timestamp") - 1) / 8) + F.col("offset") % 2
    path, files = _in_slices(envelopes(spread(table(spark, sf_dir, "events"))), week)
    return stream_envelopes(spark, path, max_files_per_trigger=files)


def _in_slices(rows: DataFrame, number: Column, slices: int = 5) -> tuple[str, int]:
    """A folder with the rows of one slice after the other, and how many files make a fifth. A stream takes files in the
    order of their times. Rows are computed once, into folders by slice, which are then copied in order."""
    spark, path = rows.sparkSession, scratch_path(rows.sparkSession, "slices")
    apart, kept = scratch_path(spark, "apart"), number.isin(*range(slices))
    rows.withColumn("_slice", number.cast("int")).where(kept).write.partitionBy("_slice").parquet(apart)
    parts = spark.read.schema(T.StructType([*rows.schema.fields, T.StructField("_slice", T.IntegerType())])).parquet(apart)
    for k in range(slices):
        parts.where(F.col("_slice") == k).drop("_slice").write.mode("append").parquet(path)
    return path, -(-len(spark.read.parquet(path).inputFiles()) // slices)


_LANDED_SQL = """SELECT transaction_id, account_id_token, account_id, amount_cents, amount_dollars, currency,
                        mcc_category, event_type, event_ts, is_international, is_high_value, metadata,
                        kafka_partition, kafka_offset, event_date FROM first_delivery"""


def _landed_view(rows: DataFrame) -> DataFrame:
    names = ("transaction_id", "account_id_token", "account_id", "amount_cents", "amount_dollars", "currency")
    more = ("mcc_category", "event_type", "event_ts", "is_international", "is_high_value")
    return rows.select(
        *names, *more, F.to_json("metadata").alias("metadata"), "kafka_partition", "kafka_offset", "event_date"
    )


@query("stream_landing", _LANDED_SQL)
def landing(spark, sf_dir):
    return _landed_view(spark.read.parquet(f"{run_pipeline(spark, sf_dir)}/landing"))


@query(
    "stream_dlq",
    """SELECT account_id AS kafka_key, kafka_timestamp, 'PARSE_FAILURE' AS dlq_reason, kafka_partition, kafka_offset
       FROM refused""",
)
def dead_letters(spark, sf_dir):
    return spark.read.parquet(f"{run_pipeline(spark, sf_dir)}/dead-letters").select(
        "kafka_key",
        F.col("kafka_timestamp").cast("timestamp_ntz").alias("kafka_timestamp"),
        "dlq_reason",
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
    )


@query("landing_append", _LANDED_SQL)
def append(spark, sf_dir):
    """One batch written twice under the same batch id, as after a failure."""
    config, root = _config(spark, run_id="append")
    writer = MicroBatchWriter(config, KEY)
    for _ in range(2):
        writer.write(envelopes(table(spark, sf_dir, "events")), 0)
    return _landed_view(spark.read.parquet(f"{root}/landing"))


@query("landing_committed", _LANDED_SQL)
def committed(spark, sf_dir):
    """One batch written twice, as after a failure, into a table of committed batches, read over all its days."""
    config, root = _config(spark, run_id="committed")
    config = replace(config, landing=CommittedSink(f"{root}/landing"))
    writer = MicroBatchWriter(config, KEY)
    for _ in range(2):
        writer.write(envelopes(spread(table(spark, sf_dir, "events"))), 0)
    schema = T.StructType([*LANDING_SCHEMA.fields, T.StructField("event_date", T.DateType())])
    return _landed_view(read_committed(spark, f"{root}/landing", schema))


@query(
    "live_metrics",
    """SELECT (SELECT count(*) FROM valid) AS rows_in, (SELECT count(*) FROM refused) AS rows_invalid,
              (SELECT count(*) FROM valid) AS written_and_copies, TRUE AS in_batches""",
)
def live(spark, sf_dir):
    """What the writes of several batches counted in passing, summed up."""
    root = scratch_path(spark, "stream")
    meter = LiveMetrics(f"{root}/live")
    spark.streams.addListener(meter)
    try:
        config = replace(_config(spark)[0], metrics=None, live=meter)
        start_pipeline(split_messages(spark, sf_dir), config, KEY).awaitTermination()
        if not meter.wait(120):
            raise TimeoutError("a batch was not reported")
    finally:
        spark.streams.removeListener(meter)
    return read_live(spark, f"{root}/live").agg(
        F.sum("rows_in").alias("rows_in"),
        F.sum("rows_invalid").alias("rows_invalid"),
        F.sum(F.col("rows_written") + F.col("duplicates")).alias("written_and_copies"),
        (F.count(F.lit(1)) > 1).alias("in_batches"),
    )


ROTATED = (
    RotatingKey("k1", KEY, date(2024, 1, 1)),
    RotatingKey("k2", TokenKey(b"second-test-key"), date(2024, 1, 16)),
)


@query(
    "stream_rotation",
    f"""SELECT transaction_id, CASE WHEN event_date >= DATE '2024-01-16' THEN 'k2' ELSE 'k1' END AS token_key_id,
               CASE WHEN event_date >= DATE '2024-01-16' THEN {token_sql('acc', ROTATED[1].key)}
                    ELSE {token_sql('acc', ROTATED[0].key)} END AS account_id_token
        FROM (SELECT transaction_id, event_date, 'ACC-' || e.user_id AS acc
              FROM first_delivery JOIN events e ON transaction_id = CAST(e.event_id AS VARCHAR))""",
)
def rotation(spark, sf_dir):
    """Landing with the key in force on the day of the event, named beside the token."""
    root = run_pipeline(spark, sf_dir, ROTATED)
    return spark.read.parquet(f"{root}/landing").select("transaction_id", "token_key_id", "account_id_token")


@query(
    "stream_evolution",
    """SELECT transaction_id, CASE WHEN ts >= TIMESTAMP '2024-01-16' THEN ['web', 'pos', 'app'][user_id % 3 + 1] END
              AS channel FROM txn""",
)
def evolving(spark, sf_dir):
    """Messages of which the later half has a field that was added to the contract: it lands as a column."""
    channel = F.element_at(F.array(F.lit("web"), F.lit("pos"), F.lit("app")), (F.col("user_id") % 3 + 1).cast("int"))
    events = table(spark, sf_dir, "events")
    newer = F.when(F.col("ts") >= F.lit("2024-01-16").cast("timestamp_ntz"), channel)
    rows = transactions(events, newer.alias("channel"), "event_id", "ts")
    names = [n for n in rows.columns if n not in ("event_id", "ts")]
    path = scratch_path(spark, "messages")
    rows.select(
        F.col("account_id").cast("binary").alias("key"),
        F.to_json(F.struct(*names)).cast("binary").alias("value"),
        F.lit("transactions").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    ).write.parquet(path)
    schema = T.StructType([*PAYLOAD_SCHEMA.fields, T.StructField("channel", T.StringType())])
    config, root = _config(spark, schema=schema)
    start_pipeline(stream_envelopes(spark, path), config, KEY).awaitTermination()
    return spark.read.parquet(f"{root}/landing").select("transaction_id", "channel")


@query(
    "file_dead_letters",
    """SELECT CAST(event_id AS VARCHAR) AS transaction_id, CASE k WHEN 1 THEN 'cut' WHEN 2 THEN 'nameless' ELSE 'landed' END
              AS route FROM txn""",
)
def refused_files(spark, sf_dir):
    """Staged files with records cut short (k = 1) and without an id (k = 2): each record takes one route."""
    path = scratch_path(spark, "staged")
    rows = transactions(table(spark, sf_dir, "events")).withColumn("account_id_token", F.lit("token"))
    k = F.col("metadata")["k"].cast("int")
    names = [c for c in rows.columns if c not in ("transaction_id", "account_id", "merchant_id")]
    known = F.when(k != 2, F.col("transaction_id"))
    note = F.concat(F.lit("id "), "transaction_id")
    text = F.to_json(F.struct(note.alias("merchant_id"), known.alias("transaction_id"), *names))
    lines = rows.select(text.alias("text"), k.alias("k"))
    cut = F.when(F.col("k") == 1, F.substring("text", F.lit(1), F.length("text") - 2)).otherwise(F.col("text"))
    lines.select(cut.alias("value")).repartition(4).write.text(path)
    config, root = _config(spark)
    start_file_ingest(stream_staged_json(spark, path, max_files_per_trigger=2), config).awaitTermination()
    landed = spark.read.parquet(f"{root}/landing").select("transaction_id", F.lit("landed").alias("route"))
    letters = spark.read.parquet(f"{root}/dead-letters").select(F.col("payload").cast("string").alias("text"))
    named = F.regexp_extract("text", '"merchant_id":"id ([0-9]+)"', 1).alias("transaction_id")
    route = F.when(F.json_array_length(F.concat(F.lit("["), "text", F.lit("]"))).isNull(), "cut").otherwise("nameless")
    return landed.unionByName(letters.select(named, route.alias("route")))


@query("continuous_file_ingest", STAGED_SQL)
def file_ingest(spark, sf_dir):
    config, root = _config(spark)
    staged = stream_staged_json(spark, staged_files(spark, sf_dir, files=4), max_files_per_trigger=2)
    start_file_ingest(staged, config).awaitTermination()
    return spark.read.parquet(f"{root}/landing").select(*STAGED_NAMES, F.to_json("metadata").alias("metadata"))


@query(
    "stream_dedupe_watermark",
    "SELECT transaction_id, account_id_token, amount_cents, event_ts FROM first_delivery",
)
def dedupe(spark, sf_dir):
    root = scratch_path(spark, "dedupe")
    rows = transform(valid_rows(tag(split_messages(spark, sf_dir))), KEY)
    # Copies come up to a week apart, so a delay of a month loses none.
    unique = dedupe_within_watermark(rows, "31 days").select(
        "transaction_id", "account_id_token", "amount_cents", F.col("event_ts").cast("timestamp_ntz").alias("event_ts")
    )
    unique.writeStream.option("checkpointLocation", f"{root}/checkpoint").trigger(**ONCE).start(
        f"{root}/rows", format="parquet", outputMode="append"
    ).awaitTermination()
    return spark.read.parquet(f"{root}/rows")


def disordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Settled transactions as a stream by weeks; one in ten comes a week late, and a heartbeat long after the last."""
    names = ("transaction_id", "account_id_token", "event_ts", "amount_cents")
    rows = settled(spark, sf_dir, spread_rows=True).select(*names)
    week = F.floor((F.dayofmonth("event_ts") - 1) / 8) + (F.pmod(F.xxhash64("transaction_id"), F.lit(10)) == 0).cast("int")
    path, files = _in_slices(rows, week)
    after = spark.read.schema(rows.schema).parquet(path).agg((F.max("event_ts") + F.expr("INTERVAL 60 DAYS")).alias("event_ts"))
    empty = [F.lit(None).cast(rows.schema[n].dataType).alias(n) for n in names if n != "event_ts"]
    after.select("event_ts", *empty).select(*names).write.mode("append").parquet(path)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(path)


def _run(rows: DataFrame) -> DataFrame:
    """What a stream gives until all its input is read."""
    spark = rows.sparkSession
    root = scratch_path(spark, "stream")
    with state_store(spark):
        rows.writeStream.option("checkpointLocation", f"{root}/checkpoint").trigger(**ONCE).start(
            f"{root}/rows", format="parquet", outputMode="append"
        ).awaitTermination()
    return spark.read.parquet(f"{root}/rows")


@query(
    "stream_velocity",
    """SELECT transaction_id, event_ts, row_number() OVER o AS sequence_no,
              epoch_us(event_ts) - epoch_us(lag(event_ts) OVER o) AS gap_micros,
              count(*) OVER w AS txn_count, CAST(sum(amount_cents) OVER w AS BIGINT) AS cents_total
       FROM settled WINDOW o AS (PARTITION BY account_id_token ORDER BY event_ts, transaction_id),
                           w AS (PARTITION BY account_id_token ORDER BY event_ts
                                 RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW)""",
)
def velocity(spark, sf_dir):
    """Keyed state over several micro-batches with late rows, row by row as the batch forms."""
    found = _run(account_signals(disordered(spark, sf_dir), "17 days"))
    return found.select(
        "transaction_id", F.col("event_ts").cast("timestamp_ntz").alias("event_ts"), "sequence_no", "gap_micros", "txn_count", "cents_total"
    )


SESSIONS_SQL = """
    SELECT account_id_token, min(event_ts) AS session_start, max(event_ts) + INTERVAL 30 MINUTE AS session_end,
           count(*) AS transactions, CAST(sum(amount_cents) AS BIGINT) AS cents_total
    FROM (SELECT *, sum(fresh) OVER (PARTITION BY account_id_token ORDER BY event_ts) AS number
          FROM (SELECT *, CASE WHEN event_ts - lag(event_ts) OVER (PARTITION BY account_id_token ORDER BY event_ts)
                                    <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh FROM settled))
    GROUP BY account_id_token, number"""


def _zoneless(sessions: DataFrame) -> DataFrame:
    return sessions.withColumns({n: F.col(n).cast("timestamp_ntz") for n in ("session_start", "session_end")})


@query("account_sessions", SESSIONS_SQL)
def sessions(spark, sf_dir):
    return _zoneless(account_sessions(settled(spark, sf_dir)))


@query("stream_sessions", SESSIONS_SQL)
def sessions_of_a_stream(spark, sf_dir):
    """Sessions that grow and merge across micro-batches."""
    return _zoneless(_run(stream_sessions(disordered(spark, sf_dir), "17 days")))
