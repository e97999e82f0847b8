"""Landing table, dead letters and batch metrics.

A micro-batch owns the partitions (run_id, batch_id) below each event date.
Writing a batch again replaces exactly those partitions, so a retried batch
leaves the table as it was. `run_id` changes with the checkpoint, because a new
checkpoint counts its batches from zero again.

Streams leave many small partitions. `compact` moves the batches of closed days
into a table of even files by day and retires their partitions, so the landing
folder lists only what is still open. `read_landed_days` in
`txnflow.sources.files` reads both as one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnflow.operators.dedupe import late_merge
from txnflow.schema import LANDING_COLUMNS, ROW_NUMBER
from txnflow.session import cut_lineage
from txnflow.sinks.skipping import files_that_may_hold, index_path, write_sorted_days

BATCH_PARTITIONS = ("run_id", "batch_id")
#: Folders deleted at a time, and partitions that one statement drops.
DELETES_AT_ONCE, PARTITIONS_A_DROP = 16, 500


@dataclass(frozen=True)
class FileSink:
    """A partitioned file table.

    Rows are rebalanced by the partition columns before the write: tasks that
    would each write a sliver of every day are joined, and a day that is much
    larger than the others is split into files of the advisory size.
    """

    path: str
    fmt: str = "parquet"
    partition_by: tuple[str, ...] = ("event_date",)
    options: dict[str, str] = field(default_factory=dict)
    # A declared table over `path`, to which each batch adds its partitions.
    table: str | None = None

    def write_batch(self, df: DataFrame, run_id: str, batch_id: int) -> None:
        stamped = df.withColumns({"run_id": F.lit(run_id), "batch_id": F.lit(batch_id).cast("bigint")})
        even = stamped.hint("rebalance", *self.partition_by)
        (
            even.write.format(self.fmt)
            .options(**self.options)
            .option("partitionOverwriteMode", "dynamic")
            .mode("overwrite")
            .partitionBy(*self.partition_by, *BATCH_PARTITIONS)
            .save(self.path)
        )
        if self.table:
            add_batch(df.sparkSession, self.table, _days_of(df.sparkSession, self.path, run_id, batch_id), run_id, batch_id)


@dataclass(frozen=True)
class ConnectorSink:
    """Any Spark data source that takes appends, such as a warehouse connector.

    Batches that were written are noted in the folder `ledger`, and a batch that
    is noted is not written again. Only a job that dies between the append and
    the note repeats a batch; its rows carry (run_id, batch_id), by which the
    target can discard them. `txnflow.sinks.committed` has a target without that gap.
    """

    fmt: str
    ledger: str
    options: dict[str, str] = field(default_factory=dict)

    def write_batch(self, df: DataFrame, run_id: str, batch_id: int) -> bool:
        """False if the batch was noted before; `df` is not computed then."""
        note = _Folder(df.sparkSession, f"{self.ledger}/run_id={run_id}/batch_id={batch_id}")
        if note.exists():
            return False
        stamped = df.withColumns({"run_id": F.lit(run_id), "batch_id": F.lit(batch_id).cast("bigint")})
        stamped.write.format(self.fmt).options(**self.options).mode("append").save()
        note.create()
        return True


class _Folder:
    """A folder of any file system that Spark reaches."""

    def __init__(self, spark: SparkSession, path: str):
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        self._fs = self._path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def exists(self) -> bool:
        return self._fs.exists(self._path)

    def create(self) -> None:
        self._fs.mkdirs(self._path)

    def delete(self) -> None:
        self._fs.delete(self._path, True)

    def delete_if_empty(self) -> None:
        if not self.children():
            self._fs.delete(self._path, True)

    def children(self) -> list[str]:
        return [s.getPath().getName() for s in self._fs.listStatus(self._path)] if self.exists() else []


# The folder name Spark gives to a null partition value.
NULL_DAY = "__HIVE_DEFAULT_PARTITION__"


def days_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the days of a table by day, from its folders; one listing, no file is opened."""
    prefix = "event_date="
    return sorted(n[len(prefix) :] for n in _Folder(spark, path).children() if n.startswith(prefix))


def _days_of(spark: SparkSession, path: str, run_id: str, batch_id: int) -> list[str]:
    folder = f"run_id={run_id}/batch_id={batch_id}"
    return [d for d in days_in(spark, path) if _Folder(spark, f"{path}/event_date={d}/{folder}").exists()]


def create_landing_table(spark: SparkSession, name: str, path: str) -> None:
    """Declare the landing table over `path`, partitioned as `FileSink` writes it."""
    columns = ", ".join(f"{c.name} {c.dtype.simpleString()}" for c in LANDING_COLUMNS) + f", {ROW_NUMBER} bigint"
    partitions = "event_date, run_id, batch_id"
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}, event_date date, run_id string, batch_id bigint) "
        f"USING parquet PARTITIONED BY ({partitions}) LOCATION '{path}' "
        "COMMENT 'Landed card transactions, append-only, no duplicates removed across batches'"
    )


def add_batch(spark: SparkSession, name: str, days: list[str], run_id: str, batch_id: int) -> None:
    """Make the partitions of one batch visible in the table; other partitions are not listed."""
    parts = " ".join(
        f"PARTITION (event_date={'null' if d == NULL_DAY else f"DATE'{d}'"}, run_id='{run_id}', batch_id={batch_id})" for d in days
    )
    if parts:
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {parts}")


def compact(
    spark: SparkSession, landing_path: str, table_path: str, first_day: str, last_day: str, staging_path: str, table: str | None = None
) -> None:
    """Move the batches of closed days from the landing folder into evenly sized files by day.

    A day that already has rows in the table keeps them, so a batch that lands
    late is added. The table keeps `run_id` and `batch_id`: a batch that is
    still in the landing folder counts from there, which makes every step safe
    to repeat. At last the moved partitions are deleted, and dropped from the
    declared `table` if one is given.
    """
    closed = [d for d in days_in(spark, landing_path) if d != NULL_DAY and first_day <= d <= last_day]
    if not closed:
        return
    moved = {d: _batches(spark, f"{landing_path}/event_date={d}") for d in closed}
    folders = [f"{landing_path}/event_date={d}/run_id={r}/batch_id={b}" for d, own in moved.items() for r, b in own]
    if not folders:
        return
    fresh = spark.read.option("basePath", landing_path).parquet(*folders)
    # Read again by the table's types: folder names alone may look like numbers.
    fresh = fresh.withColumns({"run_id": F.col("run_id").cast("string"), "batch_id": F.col("batch_id").cast("bigint")})
    if _Folder(spark, table_path).exists():
        within = F.col("event_date").between(F.lit(first_day).cast("date"), F.lit(last_day).cast("date"))
        kept = read_days(spark, table_path).where(within & F.col("event_date").isin([date.fromisoformat(d) for d in closed]))
        listed = spark.createDataFrame([(d, r, b) for d, own in moved.items() for r, b in own], "d string, run_id string, batch_id bigint")
        listed = listed.select(F.col("d").cast("date").alias("event_date"), "run_id", "batch_id")
        fresh = fresh.unionByName(without_batches(kept, listed), allowMissingColumns=True)
    fresh.write.mode("overwrite").parquet(staging_path)
    write_days(spark.read.schema(fresh.schema).parquet(staging_path), table_path)
    _at_once(lambda folder: _Folder(spark, folder).delete(), folders)
    runs = {f"{landing_path}/event_date={d}/run_id={r}" for d, own in moved.items() for r, _ in own}
    _at_once(lambda folder: _Folder(spark, folder).delete_if_empty(), runs)
    _at_once(lambda d: _Folder(spark, f"{landing_path}/event_date={d}").delete_if_empty(), moved)
    if table:
        drop_batches(spark, table, [(d, r, b) for d, own in moved.items() for r, b in own])


def _at_once(call: Callable[[str], None], names: Iterable[str]) -> None:
    """File system calls, which mostly wait, some at a time; the first that fails raises its error."""
    with ThreadPoolExecutor(DELETES_AT_ONCE) as pool:
        for _ in pool.map(call, names):
            pass


def drop_batches(spark: SparkSession, table: str, batches: list[tuple[str, str, int]]) -> None:
    """Drop the partitions (day, run_id, batch_id) from a declared table, many with each statement."""
    parts = [f"PARTITION (event_date=DATE'{d}', run_id='{r}', batch_id={b})" for d, r, b in batches]
    for start in range(0, len(parts), PARTITIONS_A_DROP):
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(parts[start : start + PARTITIONS_A_DROP])}")


def read_days(spark: SparkSession, table_path: str) -> DataFrame:
    """A table by day, with `run_id` and `batch_id` even where some of its days were written without."""
    schema = spark.read.parquet(table_path).schema
    for name, kind in (("run_id", "string"), ("batch_id", "long")):
        schema = schema if name in schema.names else schema.add(name, kind)
    return spark.read.schema(schema).parquet(table_path)


def has_batches(spark: SparkSession, landing_path: str) -> bool:
    """Whether any batch is in the landing folder."""
    return any(_batches(spark, f"{landing_path}/event_date={d}") for d in days_in(spark, landing_path))


def _batches(spark: SparkSession, day_path: str) -> list[tuple[str, int]]:
    """(run_id, batch_id) of the batches in one day's folder."""
    runs = [n.split("=", 1)[1] for n in _Folder(spark, day_path).children() if n.startswith("run_id=")]
    found = [(r, n) for r in runs for n in _Folder(spark, f"{day_path}/run_id={r}").children() if n.startswith("batch_id=")]
    return [(r, int(n.split("=", 1)[1])) for r, n in found]


def without_batches(rows: DataFrame, batches: DataFrame) -> DataFrame:
    """Rows of no batch in `batches`; rows that never had one stay. Days compare null-safe."""
    listed = batches.select(*(F.col(c).alias(f"_{c}") for c in ("event_date", *BATCH_PARTITIONS)))
    same = F.col("event_date").eqNullSafe(F.col("_event_date"))
    for name in BATCH_PARTITIONS:
        same = same & (F.col(name) == F.col(f"_{name}"))
    return rows.join(listed, same, "left_anti")


def write_days(df: DataFrame, table_path: str) -> None:
    """Replace the days that occur in `df`; other days stay untouched."""
    (
        df.hint("rebalance", "event_date")
        .write.option("partitionOverwriteMode", "dynamic")
        .mode("overwrite")
        .partitionBy("event_date")
        .parquet(table_path)
    )


def merge_into(
    spark: SparkSession, table_path: str, updates: DataFrame, staging_path: str, earliest_day: date | None = None
) -> None:
    """Upsert late rows, rewriting only the days they touch.

    A day is touched when an update falls on it or replaces a row there; rows
    without a date are a day of their own. The merged days are written to
    `staging_path` first, so a failed job leaves the table whole and the step
    can be run again. Where `write_sorted_days` wrote the table, only files that
    may hold an updated id are searched, and touched days are written so again.
    `earliest_day` bounds the days that are searched for
    replaced rows, for tables in which late rows never go back further.
    """
    table = spark.read.parquet(table_path)
    ids = cut_lineage(updates.select("transaction_id").distinct(), "ids")
    searched = searched_files(spark, table_path, ids)
    replaced = table.limit(0).select("transaction_id", "event_date")
    if searched is not None:
        recent = F.lit(True) if earliest_day is None else (F.col("event_date") >= F.lit(earliest_day)) | F.col("event_date").isNull()
        replaced = searched.where(recent).select("transaction_id", "event_date").join(ids, "transaction_id", "left_semi")
    days = cut_lineage(replaced.select("event_date").union(updates.select("event_date")).distinct(), "days")
    # At most one row per calendar day, whatever the size of the table.
    touched = _of_days(table, days, "left_semi")
    merged = late_merge(touched, updates)
    merged.write.mode("overwrite").parquet(staging_path)
    staged = spark.read.schema(merged.schema).parquet(staging_path)
    # A touched day is left empty when its last row moved to another day. Looked
    # up before the table changes; at most one row per calendar day.
    emptied = _of_days(days, staged.select("event_date").distinct(), "left_anti").collect()
    if _Folder(spark, index_path(table_path)).exists():
        write_sorted_days(staged, table_path)
    else:
        write_days(staged, table_path)
    for row in emptied:
        _Folder(spark, f"{table_path}/event_date={row['event_date'] or NULL_DAY}").delete()


def searched_files(spark: SparkSession, table_path: str, ids: DataFrame) -> DataFrame | None:
    """The files of a table by day in which a merge looks for `ids`: those that may hold one, if the table has an index,
    else all; None if there is no such file."""
    schema = spark.read.parquet(table_path).schema
    files = files_that_may_hold(spark, table_path, ids)
    return spark.read.schema(schema).option("basePath", table_path).parquet(*files) if files else None


def _of_days(rows: DataFrame, days: DataFrame, how: str) -> DataFrame:
    """Rows whose day is (not) among `days`, null being a day like others."""
    wanted = days.select(F.col("event_date").alias("_day"))
    return rows.join(F.broadcast(wanted), F.col("event_date").eqNullSafe(F.col("_day")), how)
