"""Business projection, landing projection, defaults and the staged-file form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnflow.functions import (
    RotatingKey,
    TokenKey,
    cents_to_dollars,
    enrich_with_mcc_category,
    event_date,
    event_time,
    flag_high_value_transactions,
    normalize_currency,
    rotating_token,
    tokenize_account_id,
)
from txnflow.functions.json import metadata_map
from txnflow.functions.times import event_time_ntz
from txnflow.operators.parse import CONSTRAINT_PREFIX, PARSE_FAILURE, unlandable
from txnflow.schema import (
    CORRUPT_RECORD,
    LANDING_COLUMNS,
    MASKED_ACCOUNT,
    PAYLOAD_NAMES,
    ROW_NUMBER,
    STAGED_SCHEMA,
)

# Defaults of a new event.
EVENT_DEFAULTS = {
    "merchant_category_code": "5411",
    "event_type": "AUTHORIZATION",
    "currency": "USD",
    "card_last_four": "0000",
    "is_international": False,
}


def mask_account(df: DataFrame) -> DataFrame:
    """Replace the raw account by a constant. Derive the token first."""
    return df.withColumn("account_id", F.lit(MASKED_ACCOUNT))


def transform(
    df: DataFrame,
    key: TokenKey | Sequence[RotatingKey] | None,
    ingested_at: Column | None = None,
    extra: Sequence[str] = (),
) -> DataFrame:
    """Tokenize, type, enrich and flag payload rows in one projection.

    With `key=None` the rows must already carry `account_id_token`, as staged
    files do. With several rotating keys the one in force on the day of the
    event is taken, and `token_key_id` names it. `extra` payload fields, added
    to the contract later, are carried along. `ingested_at` defaults to the
    start time of the query or batch.
    """
    more = [F.col(name) for name in extra]
    if key is None:
        token = F.col("account_id_token")
    elif isinstance(key, TokenKey):
        token = tokenize_account_id("account_id", key)
    else:
        stamped = rotating_token("account_id", event_date(event_time("event_timestamp")), key)
        token = stamped["token"]
        more.append(stamped["key_id"].alias("token_key_id"))
    return df.select(
        "transaction_id",
        F.lit(MASKED_ACCOUNT).alias("account_id"),
        "amount_cents",
        normalize_currency("currency").alias("currency"),
        "merchant_id",
        "merchant_category_code",
        "event_type",
        "card_last_four",
        "is_international",
        "metadata",
        "kafka_timestamp",
        "partition",
        "offset",
        token.alias("account_id_token"),
        event_time("event_timestamp").alias("event_ts"),
        cents_to_dollars("amount_cents").alias("amount_dollars"),
        enrich_with_mcc_category("merchant_category_code").alias("mcc_category"),
        flag_high_value_transactions("amount_cents").alias("is_high_value"),
        (F.current_timestamp() if ingested_at is None else ingested_at).alias("ingested_at"),
        *more,
    )


def landing_projection(df: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Landing names, order, types and column defaults, `extra` columns, and the `event_date` partition."""
    renamed = {"kafka_partition": "partition", "kafka_offset": "offset"}

    def typed(column):
        value = F.col(renamed.get(column.name, column.name)).cast(column.dtype)
        if column.default is not None:
            value = F.coalesce(value, F.lit(column.default))
        return value.alias(column.name)

    return df.select(*(typed(c) for c in LANDING_COLUMNS), *extra, event_date("event_ts").alias("event_date"))


def fill_defaults(
    df: DataFrame,
    transaction_id: Column | None = None,
    event_timestamp: Column | None = None,
) -> DataFrame:
    """Complete partial events: a new id, the current UTC time, fixed defaults.

    Null and empty metadata both become an empty map. Pass `transaction_id`
    (say, derived from a source position) where a retried task must give the
    same id again; the default is a random one.
    """
    new_id = F.uuid() if transaction_id is None else transaction_id
    now = F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    filled = {
        "transaction_id": F.coalesce("transaction_id", new_id),
        "event_timestamp": F.coalesce("event_timestamp", now if event_timestamp is None else event_timestamp),
        "metadata": F.coalesce("metadata", F.create_map().cast("map<string,string>")),
    }
    filled |= {name: F.coalesce(name, F.lit(value)) for name, value in EVENT_DEFAULTS.items()}
    return df.select(*(filled.get(n, F.col(n)).alias(n) for n in PAYLOAD_NAMES))


def event_envelope(events: DataFrame, fields: Sequence[str] = PAYLOAD_NAMES) -> DataFrame:
    """Keyed messages for a topic: account bytes as key, JSON as value.

    Messages of one account share a key, so they keep their order in a topic.
    """
    return events.select(
        F.col("account_id").cast("binary").alias("key"),
        F.to_json(F.struct(*fields)).cast("binary").alias("value"),
    )


def tag_staged(staged: DataFrame, strict: bool = False) -> DataFrame:
    """Staged rows with `dlq_reason`: unreadable, without an id, or, if strict, not fit for the landing table."""
    unreadable = F.col(CORRUPT_RECORD).isNotNull() | F.col("transaction_id").isNull()
    reason = F.when(unreadable, F.lit(PARSE_FAILURE))
    if strict:
        broken = unlandable(F.col("amount_cents").try_cast("bigint"))
        reason = reason.when(F.size(broken) > 0, F.concat(F.lit(CONSTRAINT_PREFIX), F.get(broken, F.lit(0))))
    return staged.withColumn("dlq_reason", reason)


def staged_dead_letters(tagged: DataFrame) -> DataFrame:
    """Refused staged rows in the shape of dead letters: the file stands for the topic, the record is the payload."""
    record = F.coalesce(CORRUPT_RECORD, F.to_json(F.struct(*STAGED_SCHEMA.names)))
    return tagged.where(F.col("dlq_reason").isNotNull()).select(
        F.lit(None).cast("string").alias("kafka_key"),
        F.lit(None).cast("timestamp").alias("kafka_timestamp"),
        "dlq_reason",
        F.col("source_file").alias("topic"),
        F.lit(None).cast("int").alias("partition"),
        F.lit(None).cast("bigint").alias("offset"),
        record.cast("binary").alias("payload"),
    )


def staged_projection(staged: DataFrame) -> DataFrame:
    """Cast staged text fields to payload types. A failed cast gives null.

    Event times keep the wall clock as written, an offset is ignored. Staged
    rows have no stream position, so those columns are null.
    """
    return staged.select(
        "transaction_id",
        "account_id_token",
        F.col("amount_cents").try_cast("bigint").alias("amount_cents"),
        "currency",
        "merchant_id",
        "merchant_category_code",
        "event_type",
        event_time_ntz("event_timestamp").cast("string").alias("event_timestamp"),
        "card_last_four",
        F.col("is_international").try_cast("boolean").alias("is_international"),
        metadata_map("metadata").alias("metadata"),
        F.lit(None).cast("timestamp").alias("kafka_timestamp"),
        F.lit(None).cast("int").alias("partition"),
        F.lit(None).cast("bigint").alias("offset"),
    )


def with_row_number(landing: DataFrame) -> DataFrame:
    """Add a unique, increasing `_file_row_number`; the numbers have gaps."""
    return landing.withColumn(ROW_NUMBER, F.monotonically_increasing_id())
