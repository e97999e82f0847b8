"""Message topics.

The connector jar is not part of Spark's core distribution, so the reader is a
thin layer over options; anything with the envelope schema can take its place.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class TopicConfig:
    bootstrap_servers: str
    topic: str
    # "latest" for a live start, "earliest" to replay all that is retained.
    starting_offsets: str = "latest"
    max_offsets_per_trigger: int = 50_000
    # Leave unset unless the broker demands one: queries that share a group id
    # can each see only part of the data.
    group_id: str | None = None
    fail_on_data_loss: bool = False
    # Split large topic partitions, so that one busy partition is read by many tasks.
    min_partitions: int | None = None
    extra: dict[str, str] = field(default_factory=dict)

    def options(self) -> dict[str, str]:
        chosen = {
            "kafka.bootstrap.servers": self.bootstrap_servers,
            "subscribe": self.topic,
            "startingOffsets": self.starting_offsets,
            "maxOffsetsPerTrigger": str(self.max_offsets_per_trigger),
            "failOnDataLoss": str(self.fail_on_data_loss).lower(),
        }
        if self.group_id:
            chosen["kafka.group.id"] = self.group_id
        if self.min_partitions:
            chosen["minPartitions"] = str(self.min_partitions)
        return chosen | self.extra


def read_from_kafka(spark: SparkSession, config: TopicConfig) -> DataFrame:
    """Unbounded envelopes of one topic, at most `max_offsets_per_trigger` per batch."""
    return spark.readStream.format("kafka").options(**config.options()).load()


def read_topic_range(spark: SparkSession, config: TopicConfig, ending_offsets: str = "latest") -> DataFrame:
    """The retained messages of one topic as a batch, for backfills.

    A backfill fails where messages it was to read are gone.
    """
    stream_only = ("maxOffsetsPerTrigger", "startingOffsets", "kafka.group.id")
    options = {k: v for k, v in config.options().items() if k not in stream_only}
    return (
        spark.read.format("kafka")
        .options(**{**options, "failOnDataLoss": "true"}, startingOffsets="earliest", endingOffsets=ending_offsets)
        .load()
    )
