"""Low-latency views beside the landing path.

They use watermarks, so rows that come later than the delay are left out. The
landing table and the models on top of it hold every row and are the truth.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def dedupe_within_watermark(
    rows: DataFrame, delay: str = "10 minutes", time: str = "event_ts", lanes: int = 16
) -> DataFrame:
    """One row per transaction across micro-batches, state bounded by `delay`.

    All copies of an id meet in one task. A first step drops copies in `lanes`
    tasks per id, by stream position, so the second step sees at most one copy
    per lane; 0 leaves it out.
    """
    timed = rows.withWatermark(time, delay)
    if lanes:
        lane = F.pmod(F.xxhash64("partition", "offset"), F.lit(lanes))
        timed = timed.withColumn("_lane", lane).dropDuplicatesWithinWatermark(["transaction_id", "_lane"]).drop("_lane")
    return timed.dropDuplicatesWithinWatermark(["transaction_id"])


def dead_letter_spikes(
    dead_letters: DataFrame,
    more_than: int = 10,
    width: str = "1 minute",
    delay: str | None = "5 minutes",
) -> DataFrame:
    """Windows with more than `more_than` dead letters; `delay=None` for a batch."""
    if delay is not None:
        dead_letters = dead_letters.withWatermark("kafka_timestamp", delay)
    return (
        dead_letters.groupBy(F.window("kafka_timestamp", width).alias("w"))
        .agg(F.count(F.lit(1)).alias("messages"))
        .where(F.col("messages") > more_than)
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "messages")
    )
