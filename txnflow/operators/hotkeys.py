"""Keys that hold too many rows for one task.

A window or a shuffle join sends all rows of one key to one task. Here such
keys are found first by a count that is combined on the map side. Other keys
take the plain path. Rows of hot keys are sorted by range instead of by hash,
so one key spreads over many tasks ("slices"), and per-slice totals carry over.

Hot keys are a written table with at most one key for each `ROWS_PER_TASK` rows
of the input. All of them are handled, however many there are; Spark broadcasts
the table where its size allows, and joins it otherwise. No row is dropped on
either path. Joins need none of this: Spark splits their busy keys itself.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from txnflow.session import cut_lineage

ROWS_PER_TASK = 5_000_000

SLICE = "_slice"


@dataclass(frozen=True)
class HotKeys:
    """Hot values of `key` with the number of their rows."""

    key: str
    keys: DataFrame
    rows: int

    def cold(self, df: DataFrame) -> DataFrame:
        return self._restrict(df, "left_anti")

    def hot(self, df: DataFrame) -> DataFrame:
        return self._restrict(df, "left_semi")

    def write(self, path: str) -> None:
        self.keys.write.mode("overwrite").parquet(path)

    def _restrict(self, df: DataFrame, how: str) -> DataFrame:
        wanted = self.keys.select(F.col(self.key).alias("_hot"))
        return df.join(wanted, df[self.key].eqNullSafe(F.col("_hot")), how)


def count_hot_keys(df: DataFrame, key: str, rows_per_task: int = ROWS_PER_TASK) -> HotKeys:
    """The values of `key` with more than `rows_per_task` rows; there may be none.

    They are counted in one job and written; only their total reaches the driver.
    One count serves all signals over the same rows, and one that was stored
    serves the next run: results are the same whichever keys are taken as hot. A
    key that grew hot since then goes through one task, until they are counted again.
    """
    counted = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return _hot_keys(key, cut_lineage(counted.where(F.col("n") > rows_per_task), "hot-keys"))


def read_hot_keys(spark: SparkSession, path: str, key: str) -> HotKeys:
    """Hot keys that `HotKeys.write` has stored."""
    return _hot_keys(key, spark.read.parquet(path))


def _hot_keys(key: str, keys: DataFrame) -> HotKeys:
    return HotKeys(key, keys, keys.agg(F.sum("n")).first()[0] or 0)


def find_hot_keys(
    df: DataFrame, key: str, rows_per_task: int = ROWS_PER_TASK, known: HotKeys | None = None
) -> HotKeys | None:
    """`known`, or the hot keys as counted now; None if no key is hot."""
    if known is not None and known.key != key:
        raise ValueError(f"hot keys of {known.key} do not tell those of {key}")
    hot = known or count_hot_keys(df, key, rows_per_task)
    return hot if hot.rows else None


def slice_by_range(hot_rows: DataFrame, key: str, order: Sequence[str], slices: int) -> DataFrame:
    """Cut rows into contiguous slices in (key, order).

    `order` must end in a unique column, so rows that agree on everything else
    still spread. Slice numbers come from the range partitioning, hence the
    rows are written out before anything is computed from the numbers.
    """
    ranged = hot_rows.repartitionByRange(max(2, slices), key, *order)
    return cut_lineage(ranged.withColumn(SLICE, F.spark_partition_id()))


def carry(sliced: DataFrame, key: str, totals: dict[str, Column], fold) -> DataFrame:
    """For each (key, slice), `fold(total)` over the earlier slices of the key.

    One row per key and slice it touches, so at most hot keys + slices rows.
    """
    per_slice = sliced.groupBy(key, SLICE).agg(*(agg.alias(name) for name, agg in totals.items()))
    before = Window.partitionBy(key).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    return per_slice.select(key, SLICE, *(fold(F.col(name)).over(before).alias(name) for name in totals))


def attach_carry(sliced: DataFrame, carried: DataFrame, key: str) -> DataFrame:
    """Join carried totals to the rows of their slice."""
    totals = [c for c in carried.columns if c not in (key, SLICE)]
    small = carried.select(F.col(key).alias("_k"), F.col(SLICE).alias("_s"), *totals)
    same = sliced[key].eqNullSafe(F.col("_k")) & (sliced[SLICE] == F.col("_s"))
    return sliced.join(small, same, "left").drop("_k", "_s")


def in_slice(key: str, order: Sequence[str]) -> Window:
    return Window.partitionBy(key, SLICE).orderBy(*order)


def slices_for(rows: int, rows_per_task: int) -> int:
    return math.ceil(rows / rows_per_task)
