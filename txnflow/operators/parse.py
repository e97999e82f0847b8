"""Envelope to payload rows, and routing into valid and dead-letter rows.

Two routings exist and stay apart:

* lenient - a row is valid when it parses and has a transaction id. Fields of
  the wrong type become null and the row stays valid. A payload that is cut
  short is refused, wherever the cut lies.
* strict  - the payload must be one object and nothing else, every required
  field must be present with its declared type, and the row must fit the landing
  table, else it goes to the dead letters with the first offending field.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnflow.functions import cents_to_dollars, event_time, normalize_currency
from txnflow.functions.json import CORRUPT, payload_struct
from txnflow.schema import (
    DEAD_LETTER_SCHEMA,
    LANDING_COLUMNS,
    MASKED_ACCOUNT,
    PAYLOAD_NAMES,
    PAYLOAD_SCHEMA,
    REQUIRED_FIELDS,
)

PARSE_FAILURE = "PARSE_FAILURE"
CONTRACT_PREFIX = "CONTRACT_"
CONSTRAINT_PREFIX = "CONSTRAINT_"

_ID_SCHEMA = T.StructType([PAYLOAD_SCHEMA["transaction_id"]])
_POSITION = ("kafka_timestamp", "partition", "offset")


class Routed(NamedTuple):
    valid: DataFrame
    invalid: DataFrame


def envelope_projection(raw: DataFrame) -> DataFrame:
    """Key and payload as text, broker time under its own name, raw bytes kept."""
    return raw.select(
        F.col("key").cast("string").alias("kafka_key"),
        F.col("value").cast("string").alias("payload_text"),
        F.col("timestamp").alias("kafka_timestamp"),
        "topic",
        "partition",
        "offset",
        F.col("value").alias("payload"),
    )


def parse_envelopes(raw: DataFrame, schema: T.StructType = PAYLOAD_SCHEMA, keep_corrupt: bool = False) -> DataFrame:
    """One row per message with the payload fields as columns.

    The struct is expanded by a generator. Catalyst does not move filters below
    it, so a filter on a payload field does not parse the text a second time.
    """
    return envelope_projection(raw).select(
        "kafka_key",
        "kafka_timestamp",
        "topic",
        "partition",
        "offset",
        "payload",
        F.inline(F.array(payload_struct(F.col("payload_text"), schema, keep_corrupt))),
    )


def violations() -> Column:
    """Names of the contract fields a strictly parsed row breaks.

    A text that is no payload at all gives just `payload`; so does a text whose
    only fault lies outside the required fields.
    """
    broken = [
        F.when(F.col(name).isNull() | (F.col(name) == "") if name == "transaction_id" else F.col(name).isNull(), name)
        for name in REQUIRED_FIELDS
    ]
    empty = F.coalesce(*(F.col(n).cast("string") for n in REQUIRED_FIELDS)).isNull()
    fields = F.array_compact(F.array(*broken))
    return (
        F.when(empty, F.array(F.lit("payload")))
        .when((F.size(fields) == 0) & F.col(CORRUPT).isNotNull(), F.array(F.lit("payload")))
        .otherwise(fields)
    )


def unlandable(cents: Column | str = "amount_cents") -> Column:
    """Names of the payload fields whose landing column would break NOT NULL or its length."""
    landed = {
        "account_id": F.lit(MASKED_ACCOUNT),
        "currency": normalize_currency("currency"),
        "event_timestamp": event_time("event_timestamp").cast("string"),
        "amount_cents": cents_to_dollars(cents).cast("string"),
    }
    # Fixed value: the landing column that a payload field fills, where its name differs.
    target = {"event_timestamp": "event_ts", "amount_cents": "amount_dollars"}
    columns = {c.name: c for c in LANDING_COLUMNS}
    broken = []
    for name in REQUIRED_FIELDS:
        column = columns[target.get(name, name)]
        value = landed.get(name, F.col(name).cast("string"))
        if column.not_null and column.default is None:
            broken.append(F.when(value.isNull(), name))
        if column.max_length is not None:
            broken.append(F.when(F.length(value) > column.max_length, name))
    return F.array_compact(F.array(*broken))


def one_object(text: Column) -> Column:
    """Whether a text that parsed, whole, as a payload is one JSON object with nothing after it.

    A payload has one closing brace, or two with its metadata. Where a text that
    ends with a brace has no more than that, nothing can follow the object;
    only other texts are read once more.
    """
    braces = F.length(text) - F.length(F.replace(text, F.lit("}"), F.lit("")))
    few = F.when(F.col("metadata").isNotNull(), 2).otherwise(1)
    plain = F.rtrim(text).endswith("}") & (braces <= few)
    again = F.coalesce(F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))) == 1, F.lit(False))
    return F.when(plain, F.lit(True)).otherwise(again)


def _strict_steps() -> list[tuple[Column, str, Column]]:
    """What the strict route asks of a parsed row, in order: when a row fails, the reason's prefix, and the fields.

    This is the one definition of a violation: routes, report and gate use it.
    """
    broken, too_much = violations(), unlandable()
    return [
        (F.size(broken) > 0, CONTRACT_PREFIX, broken),
        (~one_object(F.col("payload").cast("string")), CONTRACT_PREFIX, F.array(F.lit("payload"))),
        (F.size(too_much) > 0, CONSTRAINT_PREFIX, too_much),
    ]


def refused_fields() -> Column:
    """The fields for which the strict route refuses a row; `payload` where none can be named."""
    steps = _strict_steps()
    names = F.when(steps[0][0], steps[0][2])
    for failed, _, fields in steps[1:]:
        names = names.when(failed, fields)
    return names.otherwise(F.array(F.lit("payload")))


def _nested(schema: T.StructType) -> bool:
    return any(isinstance(f.dataType, (T.MapType, T.StructType, T.ArrayType)) for f in schema.fields)


def dead_letter_reason(strict: bool = False, schema: T.StructType = PAYLOAD_SCHEMA) -> Column:
    """Null for a valid row, else the reason it is refused.

    A full parse keeps what stands before a cut inside a nested field; a parse
    of just the id refuses such a text. So rows that were not read cleanly, by
    a cut or by a field of the wrong type, are asked for the id again, and both
    routes agree. A well-formed message is parsed once.
    """
    failed = F.col("transaction_id").isNull()
    if _nested(schema):
        again = F.from_json(F.col("payload").cast("string"), _ID_SCHEMA)["transaction_id"].isNull()
        failed = failed | F.when(F.col(CORRUPT).isNotNull(), again).otherwise(F.lit(False))
    reason = F.when(failed, F.lit(PARSE_FAILURE))
    for broken, prefix, fields in _strict_steps() if strict else ():
        reason = reason.when(broken, F.concat(F.lit(prefix), F.get(fields, F.lit(0))))
    return reason


def tag(raw: DataFrame, strict: bool = False, schema: T.StructType = PAYLOAD_SCHEMA) -> DataFrame:
    """Parsed rows with `dlq_reason`; both routes are filters on that column."""
    parsed = parse_envelopes(raw, schema, keep_corrupt=strict or _nested(schema))
    return parsed.withColumn("dlq_reason", dead_letter_reason(strict, schema))


def valid_rows(tagged: DataFrame, names: tuple[str, ...] = PAYLOAD_NAMES) -> DataFrame:
    return tagged.where(F.col("dlq_reason").isNull()).select(*names, *_POSITION)


def invalid_rows(tagged: DataFrame) -> DataFrame:
    """Dead letters with their raw bytes and position, enough to replay them."""
    return tagged.where(F.col("dlq_reason").isNotNull()).select(*DEAD_LETTER_SCHEMA.names)


def parse_and_validate(raw: DataFrame, strict: bool = False) -> Routed:
    """Split messages into valid payload rows and dead letters.

    Each side is a plan of its own, and each message is on exactly one. The
    lenient dead letters parse just the id, which takes less than half the time
    of a full parse. Where both sides are
    consumed together, persist `tag(raw)` and route from it, as the streaming
    pipeline does per micro-batch.
    """
    tagged = tag(raw, strict)
    refused = tagged if strict else tag(raw, schema=_ID_SCHEMA)
    return Routed(valid_rows(tagged), invalid_rows(refused))
