"""Publishing events to a topic, as one distributed write."""

from __future__ import annotations

from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from txnflow.operators.transform import event_envelope
from txnflow.schema import REQUIRED_FIELDS


def to_topic_records(df: DataFrame, key: str) -> DataFrame:
    """`key`, `value` columns for a topic writer; the value is the whole row as JSON."""
    return df.select(F.col(key).cast("binary").alias("key"), F.to_json(F.struct(*df.columns)).alias("value"))


def _complete() -> Column:
    present = F.lit(True)
    for name in REQUIRED_FIELDS:
        present = present & F.col(name).isNotNull()
    return present


class Published(NamedTuple):
    """Numbers of events written and refused."""

    produced: int
    errors: int


def publish(events: DataFrame, options: dict[str, str], refused_path: str, fmt: str = "kafka") -> Published:
    """Write complete events as keyed messages, and the others, whole, to `refused_path`.

    An event without one of the required fields is refused. Both numbers are
    gathered by the writes themselves; each write computes its own rows once.
    """
    complete, refused = Observation(), Observation()
    good = events.where(_complete()).observe(complete, F.count(F.lit(1)).alias("n"))
    event_envelope(good).write.format(fmt).options(**options).mode("append").save()
    bad = events.where(~_complete()).observe(refused, F.count(F.lit(1)).alias("n"))
    bad.write.mode("append").parquet(refused_path)
    return Published(complete.get["n"], refused.get["n"])


@dataclass(frozen=True)
class TopicSink:
    """Dead letters to a topic, from the query that lands the batch.

    A batch that is tried again is sent again; consumers tell repeats by topic,
    partition and offset in the message.
    """

    options: dict[str, str]
    key: str = "kafka_key"
    fmt: str = "kafka"

    def write_batch(self, df: DataFrame, run_id: str, batch_id: int) -> None:
        to_topic_records(df, self.key).write.format(self.fmt).options(**self.options).mode("append").save()
