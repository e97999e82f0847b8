"""Envelopes, parsing, contracts, landing and files."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog.adapters import (
    KEY,
    envelopes,
    landed,
    order_transactions,
    settled,
    table,
    transactions,
    transformed,
)
from catalog.registry import dollars_sql, query, token_sql
from txnflow.functions import tokenize_account_id
from txnflow.operators.contract import contract_gate, contract_violations, landing_constraint_violations
from txnflow.operators.parse import (
    envelope_projection,
    parse_and_validate,
    parse_envelopes,
    tag,
    valid_rows,
)
from txnflow.operators.transform import event_envelope, landing_projection, staged_projection, transform
from txnflow.plans.evolution import merged_schema, union_versions
from txnflow.plans.models import retention_keep
from txnflow.plans.operations import dlq_rate, reason_counts, replay, split_counts
from txnflow.schema import DEAD_LETTER_SCHEMA, PAYLOAD_NAMES, PAYLOAD_SCHEMA
from txnflow.session import cut_lineage, scratch_path
from txnflow.sinks.landing import FileSink, compact, merge_into, write_days
from txnflow.sinks.skipping import write_sorted_days
from txnflow.sinks.topic import to_topic_records
from txnflow.sources.arrays import read_staged_arrays
from txnflow.sources.files import newest_day, read_landed_days, read_landing, read_staged_json

NTZ = "timestamp_ntz"


def _messages(spark, sf_dir):
    return envelopes(table(spark, sf_dir, "events"))


_ID_TEXT = """'"transaction_id":"' || event_id || '",'"""
_TEXT = """CASE WHEN k IN (2, 3) THEN '' ELSE '"transaction_id":"' || event_id || '",' END"""


def _payload_sql(head: str) -> str:
    return (
        f"""'{{' || {head} || '"account_id":"' || account_id || '","amount_cents":' || amount_text"""
        f""" || ',"currency":"' || currency || '","merchant_id":"' || merchant_id"""
        f""" || '","merchant_category_code":"' || merchant_category_code || '","event_type":"' || event_type"""
        f""" || '","event_timestamp":"' || event_timestamp || '","card_last_four":"' || card_last_four"""
        f""" || '","is_international":' || CASE WHEN is_international THEN 'true' ELSE 'false' END"""
        f""" || ',"metadata":' || metadata || '}}'"""
    )


@query(
    "event_envelope",
    f"""SELECT account_id AS key, {_payload_sql(_ID_TEXT)} AS value
        FROM (SELECT *, CAST(amount_cents AS VARCHAR) AS amount_text FROM txn)""",
)
def envelope(spark, sf_dir):
    sent = event_envelope(transactions(table(spark, sf_dir, "events")))
    return sent.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))


@query(
    "envelope_projection",
    f"""SELECT account_id AS kafka_key, kafka_timestamp, kafka_partition, kafka_offset,
               CASE WHEN cut THEN left(value, length(value) - 1) WHEN k = 7 THEN value || ' {{"more":1}}'
                    ELSE value END AS payload_text
        FROM (SELECT *, {_payload_sql(_TEXT)} AS value
              FROM (SELECT *, CASE WHEN k IN (4, 5) THEN '"' || amount_cents || '"'
                                   ELSE CAST(amount_cents AS VARCHAR) END AS amount_text FROM delivered))""",
)
def projected(spark, sf_dir):
    return envelope_projection(_messages(spark, sf_dir)).select(
        "kafka_key",
        F.col("kafka_timestamp").cast(NTZ).alias("kafka_timestamp"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        "payload_text",
    )


def _position():
    return F.col("partition").alias("kafka_partition"), F.col("offset").alias("kafka_offset")


_FIELDS = """account_id, amount_cents, currency, merchant_id, merchant_category_code, event_type,
             event_timestamp, card_last_four, is_international, metadata"""


@query(
    "parse_json_payload",
    """SELECT kafka_partition, kafka_offset, CASE WHEN NOT cut THEN transaction_id END AS transaction_id,
              CASE WHEN NOT cut THEN account_id END AS account_id,
              CASE WHEN NOT cut AND k NOT IN (4, 5) THEN amount_cents END AS amount_cents,
              CASE WHEN NOT cut THEN currency END AS currency,
              CASE WHEN NOT cut THEN is_international END AS is_international,
              CASE WHEN NOT cut THEN event_timestamp END AS event_timestamp
       FROM delivered""",
)
def parsed(spark, sf_dir):
    names = ("transaction_id", "account_id", "amount_cents", "currency", "is_international", "event_timestamp")
    rows = parse_envelopes(_messages(spark, sf_dir))
    return rows.select(*_position(), *names)


@query("valid_rows", f"SELECT kafka_partition, kafka_offset, kafka_timestamp, transaction_id, {_FIELDS} FROM valid")
def valid(spark, sf_dir):
    rows = parse_and_validate(_messages(spark, sf_dir)).valid
    return rows.select(
        *_position(),
        F.col("kafka_timestamp").cast(NTZ).alias("kafka_timestamp"),
        *PAYLOAD_NAMES[:-1],
        F.to_json("metadata").alias("metadata"),
    )


_INVALID_SQL = """SELECT account_id AS kafka_key, kafka_timestamp, 'PARSE_FAILURE' AS dlq_reason,
                         'transactions' AS topic, kafka_partition, kafka_offset FROM refused"""


@query("invalid_rows", _INVALID_SQL)
def invalid(spark, sf_dir):
    rows = parse_and_validate(_messages(spark, sf_dir)).invalid
    return rows.select(
        "kafka_key", F.col("kafka_timestamp").cast(NTZ).alias("kafka_timestamp"), "dlq_reason", "topic", *_position()
    )


@query(
    "dlq_rows",
    f"""SELECT account_id AS key, kafka_offset,
               CASE WHEN cut THEN left(value, length(value) - 1) ELSE value END AS payload_text
        FROM (SELECT *, {_payload_sql(_TEXT)} AS value
              FROM (SELECT *, CAST(amount_cents AS VARCHAR) AS amount_text FROM refused))""",
)
def dead_letters(spark, sf_dir):
    """Dead letters as topic records, read back as a replay job would."""
    records = to_topic_records(parse_and_validate(_messages(spark, sf_dir)).invalid, "kafka_key")
    letter = F.from_json("value", DEAD_LETTER_SCHEMA)
    return records.select(F.col("key").cast("string").alias("key"), letter.alias("letter")).select(
        "key",
        F.col("letter.offset").alias("kafka_offset"),
        F.col("letter.payload").cast("string").alias("payload_text"),
    )


@query(
    "dlq_reason_counts",
    """SELECT CASE WHEN cut OR transaction_id IS NULL THEN 'PARSE_FAILURE'
                   WHEN k = 6 THEN 'CONSTRAINT_currency' WHEN k = 7 THEN 'CONTRACT_payload'
                   ELSE 'CONTRACT_amount_cents' END
                  AS dlq_reason, count(*) AS messages
       FROM delivered WHERE cut OR transaction_id IS NULL OR k IN (4, 5, 6, 7) GROUP BY 1""",
)
def reasons(spark, sf_dir):
    return reason_counts(parse_and_validate(_messages(spark, sf_dir), strict=True).invalid)


_SPLIT_SQL = """SELECT count(*) AS messages, count(*) FILTER (NOT cut AND transaction_id IS NOT NULL) AS valid,
                       count(*) FILTER (cut OR transaction_id IS NULL) AS invalid FROM delivered"""


@query("split_counts", _SPLIT_SQL)
def split(spark, sf_dir):
    return split_counts(tag(_messages(spark, sf_dir)))


@query(
    "dlq_rate",
    f"""SELECT messages, invalid, CAST(CAST((200000 * invalid + messages) // (2 * messages) AS DECIMAL(12,3)) * 0.001
               AS DECIMAL(9,3)) AS dlq_rate FROM ({_SPLIT_SQL})""",
)
def rate(spark, sf_dir):
    return dlq_rate(tag(_messages(spark, sf_dir)))


@query(
    "contract_violations",
    """SELECT kafka_partition, kafka_offset,
              CASE WHEN cut OR k = 7 THEN 'payload' WHEN transaction_id IS NULL THEN 'transaction_id'
                   WHEN k = 6 THEN 'currency' ELSE 'amount_cents' END AS violations
       FROM delivered WHERE cut OR transaction_id IS NULL OR k IN (4, 5, 6, 7)""",
)
def violations(spark, sf_dir):
    rows = contract_violations(_messages(spark, sf_dir))
    return rows.select(*_position(), F.array_join("violations", ",").alias("violations"))


@query(
    "contract_gate",
    """SELECT CAST(kafka_timestamp AS DATE) AS batch, count(*) AS messages,
              count(*) FILTER (cut OR transaction_id IS NULL OR k IN (4, 5, 6, 7)) AS violations,
              count(*) FILTER (cut OR transaction_id IS NULL OR k IN (4, 5, 6, 7)) = 0 AS passed
       FROM delivered GROUP BY 1""",
)
def gate(spark, sf_dir):
    return contract_gate(_messages(spark, sf_dir), F.to_date("kafka_timestamp"))


@query(
    "landing_constraint_violations",
    """SELECT transaction_id, kafka_offset,
              CASE WHEN k IN (4, 5) THEN 'amount_cents:not_null,amount_dollars:not_null'
                   ELSE 'currency:length' END AS violations
       FROM landed WHERE k IN (4, 5, 6)""",
)
def landing_violations(spark, sf_dir):
    rows = landing_constraint_violations(landed(spark, sf_dir))
    return rows.select("transaction_id", "kafka_offset", F.array_join("violations", ",").alias("violations"))


@query(
    "transform_full",
    """SELECT transaction_id, account_id, amount_cents, currency, merchant_id, merchant_category_code, event_type,
              card_last_four, is_international, metadata, kafka_timestamp, kafka_partition AS "partition",
              kafka_offset AS "offset", account_id_token, event_ts, amount_dollars, mcc_category,
              amount_cents >= 100000 AS is_high_value, ingested_at FROM landed""",
)
def full(spark, sf_dir):
    rows = transformed(spark, sf_dir)
    zoneless = {name: F.col(name).cast(NTZ) for name in ("kafka_timestamp", "event_ts", "ingested_at")}
    return rows.withColumns({"metadata": F.to_json("metadata"), **zoneless})


_LANDING_FIELDS = """transaction_id, account_id_token, account_id, amount_cents, amount_dollars, currency, merchant_id,
                     merchant_category_code, mcc_category, event_type, event_ts, card_last_four, is_international,
                     is_high_value, metadata, kafka_partition, kafka_offset"""


@query("landing_projection", f"SELECT {_LANDING_FIELDS}, ingested_at, event_date FROM landed")
def landing(spark, sf_dir):
    return landed(spark, sf_dir).withColumn("metadata", F.to_json("metadata"))


@query(
    "event_date_prune",
    """SELECT transaction_id, amount_cents, event_date FROM settled
       WHERE event_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-16'""",
)
def prune(spark, sf_dir):
    """A week out of a table written by day; the scan opens the folders of that week only."""
    path = scratch_path(spark, "by-day")
    write_days(settled(spark, sf_dir), path)
    week = F.col("event_date").between(F.lit("2024-01-10").cast("date"), F.lit("2024-01-16").cast("date"))
    return read_landing(spark, path).where(week).select("transaction_id", "amount_cents", "event_date")


@query(
    "retention_keep",
    """SELECT transaction_id, event_date FROM ordered
       WHERE event_date >= (SELECT max(event_date) FROM ordered) - INTERVAL 90 DAY""",
)
def keep(spark, sf_dir):
    """The last days of a table written by day; older folders are not read."""
    path = scratch_path(spark, "by-day")
    write_days(order_transactions(spark, sf_dir), path)
    return retention_keep(read_landing(spark, path), newest_day(spark, path)).select("transaction_id", "event_date")


_LATE = 15  # events of this `k` and above land after their day is closed


@query(
    "landed_days_late",
    """SELECT transaction_id, amount_cents, CASE WHEN k <> 9 THEN event_date END AS event_date FROM settled""",
)
def late_days(spark, sf_dir):
    """Early batches are compacted, late ones of the same days and undated rows land afterwards, and one batch is
    written a second time: every row is read once."""
    k = F.col("metadata")["k"].cast("int")
    rows = settled(spark, sf_dir).withColumn("event_date", F.when(k != 9, F.col("event_date")))
    landing, table_path = FileSink(scratch_path(spark, "landing")), scratch_path(spark, "by-day")
    landing.write_batch(rows.where(k < _LATE), "r", 0)
    landing.write_batch(rows.where(k.between(_LATE, 39)), "r", 1)
    compact(spark, landing.path, table_path, "2024-01-01", "2024-01-20", scratch_path(spark, "staging"))
    landing.write_batch(rows.where(k.between(40, 69)), "r", 2)
    compact(spark, landing.path, table_path, "2024-01-01", "2024-01-20", scratch_path(spark, "staging"))
    landing.write_batch(rows.where(k >= 70), "r", 3)
    landing.write_batch(rows.where(k.between(_LATE, 39)), "r", 1)
    return read_landed_days(spark, table_path, landing.path).select("transaction_id", "amount_cents", "event_date")


MERGED_SQL = """SELECT transaction_id, CASE WHEN k < 40 THEN amount_cents + 1 ELSE amount_cents END AS amount_cents,
              CASE WHEN k < 10 THEN event_date + 1 WHEN k >= 90 THEN NULL WHEN k BETWEEN 20 AND 29 THEN NULL
                   ELSE event_date END AS event_date
       FROM (SELECT *, CAST(ts AS DATE) AS event_date FROM (SELECT * EXCLUDE (event_date) FROM settled))"""


@query("merge_days", MERGED_SQL)
def merged_days(spark, sf_dir):
    return _merged(spark, sf_dir, write_days)


@query("merge_indexed_days", MERGED_SQL)
def merged_indexed_days(spark, sf_dir):
    """As `merge_days`, on a table whose files are sorted and indexed, so that only some are searched."""
    return _merged(spark, sf_dir, write_sorted_days)


def _merged(spark, sf_dir, write):
    """Corrections that move rows to the next day (k < 10), give them a date (10 to 19), take it away (20 to 29),
    change them in place (30 to 39); rows from 90 on never have a date."""
    k = F.col("metadata")["k"].cast("int")
    # Written once: the merges read the corrections again and again.
    rows = cut_lineage(settled(spark, sf_dir, spread_rows=True), "settled")
    day = F.col("event_date")
    old = rows.withColumn("event_date", F.when(~(k.between(10, 19) | (k >= 90)), day))
    new_day = F.when(k < 10, F.date_add(day, 1)).when(~k.between(20, 29), day)
    new = rows.where(k < 40).withColumns(
        {
            "event_date": new_day,
            "amount_cents": F.col("amount_cents") + 1,
            "ingested_at": F.col("ingested_at") + F.expr("INTERVAL 9 DAY"),
        }
    )
    path = scratch_path(spark, "by-day")
    write(old, path)
    for _ in range(2):  # a second run changes nothing
        merge_into(spark, path, new, scratch_path(spark, "staging"))
    return read_landing(spark, path).select("transaction_id", "amount_cents", F.col("event_date").cast("date").alias("event_date"))


def staged_files(spark, sf_dir, files=None):
    """Write all events as staged JSON, arrays of at most 500 objects per line; some times have an offset."""
    path = scratch_path(spark, "staged")
    rows = transactions(table(spark, sf_dir, "events"), "event_id")
    zone = F.when(F.col("event_id") % 9 == 0, "+05:00").otherwise("")
    rows = rows.withColumn("event_timestamp", F.concat("event_timestamp", zone))
    objects = rows.select(
        F.floor(F.col("event_id") / 500).alias("chunk"),
        F.to_json(
            F.struct(
                *(c for c in PAYLOAD_NAMES if c != "account_id"),
                tokenize_account_id("account_id", KEY).alias("account_id_token"),
            )
        ).alias("object"),
    )
    lines = objects.groupBy("chunk").agg(F.concat_ws(",", F.collect_list("object")).alias("objects"))
    text = lines.select(F.concat(F.lit("["), "objects", F.lit("]")).alias("value"))
    (text.repartition(files) if files else text).write.text(path)
    return path


STAGED_SQL = f"""
    SELECT transaction_id, {token_sql('account_id')} AS account_id_token, '[TOKENIZED]' AS account_id, amount_cents,
           {dollars_sql('amount_cents')} AS amount_dollars, upper(trim(currency)) AS currency, merchant_id,
           merchant_category_code, event_type, ts AS event_ts, card_last_four, is_international, metadata
    FROM txn"""
STAGED_NAMES = (
    *("transaction_id", "account_id_token", "account_id", "amount_cents", "amount_dollars", "currency"),
    *("merchant_id", "merchant_category_code", "event_type", "event_ts", "card_last_four", "is_international"),
)


@query("bulk_json_load", STAGED_SQL)
def bulk_load(spark, sf_dir):
    staged = read_staged_json(spark, staged_files(spark, sf_dir))
    rows = landing_projection(transform(staged_projection(staged), key=None))
    return rows.select(*STAGED_NAMES, F.to_json("metadata").alias("metadata"))


def array_files(spark, sf_dir):
    """Write all events as arrays over many lines, one object in each, a file for each of 16 groups.

    Rows are written one by one: only the ends of a group, known by their places in the table, are looked up before.
    """
    path = scratch_path(spark, "arrays")
    group = (F.col("event_id") % 16).alias("group")
    at = (F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("place"))
    events = table(spark, sf_dir, "events").select("*", group, F.struct(*at).alias("at"))
    ends = events.groupBy("group").agg(F.min("at").alias("first"), F.max("at").alias("last"))
    ends = F.broadcast(ends.withColumnRenamed("group", "of"))
    token = tokenize_account_id("account_id", KEY).alias("account_id_token")
    rows = transactions(events, "group", "at")
    lines = rows.select("group", "at", F.to_json(F.struct(*(c for c in PAYLOAD_NAMES if c != "account_id"), token)).alias("object"))
    lines = lines.repartition("group").join(ends, F.col("group").eqNullSafe(F.col("of")))
    opened = F.when(F.col("at") == F.col("first"), "[\n  ").otherwise("  ")
    closed = F.when(F.col("at") == F.col("last"), "\n]").otherwise(",")
    lines = lines.select("group", "at", F.concat(opened, "object", closed).alias("value"))
    lines.sortWithinPartitions("group", "at").select("group", "value").write.partitionBy("group").text(path)
    return path


@query("bulk_array_load", STAGED_SQL)
def bulk_arrays(spark, sf_dir):
    """All events as arrays over many lines, a file for each of 16 groups, each file read by several tasks."""
    path = array_files(spark, sf_dir)
    rows = landing_projection(transform(staged_projection(read_staged_arrays(spark, path)), key=None))
    return rows.select(*STAGED_NAMES, F.to_json("metadata").alias("metadata"))


@query(
    "dlq_replay",
    """SELECT transaction_id, amount_cents, kafka_partition, kafka_offset FROM
       (SELECT event_id AS id, CAST(event_id AS VARCHAR) AS transaction_id, amount_cents, kafka_partition, kafka_offset
        FROM refused WHERE cut AND CAST(event_id AS VARCHAR) NOT IN (SELECT transaction_id FROM valid))""",
)
def replayed(spark, sf_dir):
    """Replay after a fix that closes payloads cut short; landed ids are left out."""
    routed = parse_and_validate(_messages(spark, sf_dir))
    closed = replay(routed.invalid, routed.valid, lambda text: F.regexp_replace(text, r"([^}])\}$", "$1}}"))
    return closed.valid.select("transaction_id", "amount_cents", *_position())


@query(
    "schema_evolution_union",
    """SELECT transaction_id, amount_cents,
              CASE WHEN ts >= TIMESTAMP '2024-01-16' THEN ['web', 'pos', 'app'][user_id % 3 + 1] END AS channel
       FROM txn""",
)
def evolution(spark, sf_dir):
    """Payloads before and after an optional field was added, read as one table."""
    events = table(spark, sf_dir, "events")
    switch = F.lit("2024-01-16").cast("timestamp_ntz")
    newer_schema = T.StructType([*PAYLOAD_SCHEMA.fields, T.StructField("channel", T.StringType())])
    channel = F.element_at(F.array(F.lit("web"), F.lit("pos"), F.lit("app")), (F.col("user_id") % 3 + 1).cast("int"))

    def sent(rows, fields):
        return event_envelope(rows, fields).select(
            "*",
            F.lit("transactions").alias("topic"),
            F.lit(0).alias("partition"),
            F.lit(0).cast("bigint").alias("offset"),
            F.lit(None).cast("timestamp").alias("timestamp"),
        )

    older = sent(transactions(events.where(F.col("ts") < switch)), PAYLOAD_NAMES)
    newer = sent(transactions(events.where(F.col("ts") >= switch), channel.alias("channel")), newer_schema.names)
    merged = merged_schema(PAYLOAD_SCHEMA, newer_schema)
    both = union_versions(
        valid_rows(tag(older)), valid_rows(tag(newer, schema=merged), tuple(merged.names))
    )
    return both.select("transaction_id", "amount_cents", "channel")
