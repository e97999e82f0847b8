"""The one declared data contract.

The parse schema, the strict contract, the landing projection and the landing
constraints are all derived from the two tables in this module, so a field is
added or changed in a single place.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class PayloadField:
    name: str
    dtype: T.DataType
    required: bool = True


# The event payload.
PAYLOAD_FIELDS = (
    PayloadField("transaction_id", T.StringType()),
    PayloadField("account_id", T.StringType()),
    PayloadField("amount_cents", T.LongType()),
    PayloadField("currency", T.StringType()),
    PayloadField("merchant_id", T.StringType()),
    PayloadField("merchant_category_code", T.StringType()),
    PayloadField("event_type", T.StringType()),
    PayloadField("event_timestamp", T.StringType()),
    PayloadField("card_last_four", T.StringType()),
    PayloadField("is_international", T.BooleanType()),
    PayloadField("metadata", T.MapType(T.StringType(), T.StringType()), required=False),
)

PAYLOAD_SCHEMA = T.StructType([T.StructField(f.name, f.dtype, not f.required) for f in PAYLOAD_FIELDS])
PAYLOAD_NAMES = tuple(f.name for f in PAYLOAD_FIELDS)
REQUIRED_FIELDS = tuple(f.name for f in PAYLOAD_FIELDS if f.required)

# Shape of a message as the stream source delivers it.
ENVELOPE_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("timestampType", T.IntegerType()),
    ]
)

# Staged files are read as text fields and cast afterwards, so "5" and 5 both
# become a number. They may carry a token in place of the raw account.
STAGED_SCHEMA = T.StructType(
    [T.StructField(n, T.StringType()) for n in (*PAYLOAD_NAMES, "account_id_token")]
)

# A record that is cut short or no object keeps its text here.
CORRUPT_RECORD = "_corrupt_record"
STAGED_READ_SCHEMA = T.StructType([*STAGED_SCHEMA.fields, T.StructField(CORRUPT_RECORD, T.StringType())])

DEAD_LETTER_SCHEMA = T.StructType(
    [
        T.StructField("kafka_key", T.StringType()),
        T.StructField("kafka_timestamp", T.TimestampType()),
        T.StructField("dlq_reason", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("payload", T.BinaryType()),
    ]
)


@dataclass(frozen=True)
class LandingColumn:
    name: str
    dtype: T.DataType
    not_null: bool = False
    max_length: int | None = None
    default: object = None


# The landing table, in column order.
LANDING_COLUMNS = (
    LandingColumn("transaction_id", T.StringType(), True, 36),
    LandingColumn("account_id_token", T.StringType(), True, 64),
    LandingColumn("account_id", T.StringType(), True, 20),
    LandingColumn("amount_cents", T.LongType(), True),
    LandingColumn("amount_dollars", T.DecimalType(18, 2), True),
    LandingColumn("currency", T.StringType(), True, 3),
    LandingColumn("merchant_id", T.StringType(), True, 50),
    LandingColumn("merchant_category_code", T.StringType(), True, 4),
    LandingColumn("mcc_category", T.StringType(), False, 30),
    LandingColumn("event_type", T.StringType(), True, 30),
    LandingColumn("event_ts", T.TimestampNTZType(), True),
    LandingColumn("card_last_four", T.StringType(), False, 4),
    LandingColumn("is_international", T.BooleanType(), True, default=False),
    LandingColumn("is_high_value", T.BooleanType(), True, default=False),
    LandingColumn("metadata", T.MapType(T.StringType(), T.StringType())),
    LandingColumn("kafka_partition", T.IntegerType()),
    LandingColumn("kafka_offset", T.LongType()),
    LandingColumn("ingested_at", T.TimestampNTZType(), True),
)

LANDING_NAMES = tuple(c.name for c in LANDING_COLUMNS)
# Landing rows as stored: nullable, since the lenient route may land nulls.
LANDING_SCHEMA = T.StructType([T.StructField(c.name, c.dtype) for c in LANDING_COLUMNS])

# Number of a row within the batch that landed it; with the batch it is unique, and it has gaps.
ROW_NUMBER = "_file_row_number"

# Fixed values.
MASKED_ACCOUNT = "[TOKENIZED]"
RETENTION_DAYS = 90
EVENT_TYPES = ("AUTHORIZATION", "SETTLEMENT", "REFUND", "CHARGEBACK", "FEE")
