"""Duplicates: within a batch, across batches, and their counts.

`row_number() = 1` is planned as a group limit that runs before the shuffle as
well as after it, so of any number of copies each task sends on only one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

_RANK = "_rank"


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first in `order`."""
    ranked = df.withColumn(_RANK, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col(_RANK) == 1).drop(_RANK)


def dedupe_in_batch(df: DataFrame, offset: str = "offset", partition: str = "partition") -> DataFrame:
    """One row per transaction: the lowest offset, then the lowest partition.

    Offsets are unique only within a partition, so both are needed for a result
    that does not change when a batch is run again.
    """
    return keep_first(df, ["transaction_id"], [F.col(offset), F.col(partition)])


def latest_versions(df: DataFrame) -> DataFrame:
    """One row per transaction: the one ingested last.

    Rows with equal times are ordered by stream position, then by a hash of the
    content for rows from files, which have no position. Rows without an id are
    versions of nothing: only equal ones are merged.
    """
    content = F.xxhash64(*(F.to_json("metadata") if name == "metadata" else F.col(name) for name in sorted(df.columns)))
    order = [
        F.col("ingested_at").desc(),
        F.col("kafka_offset").desc_nulls_last(),
        F.col("kafka_partition").desc_nulls_last(),
        F.when(F.col("kafka_offset").isNull(), content).desc(),
    ]
    nameless = "_nameless"
    marked = df.withColumn(nameless, F.when(F.col("transaction_id").isNull(), content))
    return keep_first(marked, ["transaction_id", nameless], order).drop(nameless)


def late_merge(existing: DataFrame, updates: DataFrame) -> DataFrame:
    """Upsert: the union with only the latest version of each transaction."""
    return latest_versions(existing.unionByName(updates, allowMissingColumns=True))


def duplicate_count(df: DataFrame, key: str = "transaction_id") -> DataFrame:
    """Rows, distinct ids and surplus copies; a null id counts as one id.

    Copies are counted per id first, so the count is one shuffle of ids.
    """
    per_id = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return per_id.agg(
        F.coalesce(F.sum("n"), F.lit(0).cast("bigint")).alias("rows_in"),
        F.count(F.lit(1)).alias("distinct_ids"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0).cast("bigint")).alias("duplicates"),
    )


def batch_metrics(df: DataFrame, batch: str = "batch_id", key: str = "transaction_id") -> DataFrame:
    """Rows in, duplicates and rows written for each batch."""
    per_id = df.groupBy(batch, key).agg(F.count(F.lit(1)).alias("n"))
    return per_id.groupBy(batch).agg(
        F.sum("n").alias("rows_in"),
        F.sum(F.col("n") - 1).alias("duplicates"),
        F.count(F.lit(1)).alias("rows_written"),
    )


def running_totals(metrics: DataFrame, batch: str = "batch_id", block: int = 10_000) -> DataFrame:
    """Batches and rows written so far, after each batch.

    Input is one row per batch. Totals run within blocks of batches, and the
    totals of earlier blocks, one row per `block` batches, are added.
    """
    blocked = metrics.withColumn("_block", F.floor(F.col(batch) / block))
    blocks = blocked.groupBy("_block").agg(F.count(F.lit(1)).alias("_n"), F.sum("rows_written").alias("_rows"))
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    carried = blocks.select(
        "_block",
        F.coalesce(F.sum("_n").over(before), zero).alias("_n_before"),
        F.coalesce(F.sum("_rows").over(before), zero).alias("_rows_before"),
    )
    so_far = Window.partitionBy("_block").orderBy(batch).rowsBetween(Window.unboundedPreceding, 0)
    return blocked.join(carried, "_block").select(
        *metrics.columns,
        (F.count(F.lit(1)).over(so_far) + F.col("_n_before")).alias("total_batches"),
        (F.sum("rows_written").over(so_far) + F.col("_rows_before")).alias("total_rows"),
    )
