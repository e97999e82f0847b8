"""Files: envelopes as Parquet, staged events as JSON, landed tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnflow.schema import CORRUPT_RECORD, DEAD_LETTER_SCHEMA, ENVELOPE_SCHEMA, STAGED_READ_SCHEMA, STAGED_SCHEMA
from txnflow.sinks.landing import BATCH_PARTITIONS, NULL_DAY, days_in, has_batches, read_days, without_batches


def read_envelopes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ENVELOPE_SCHEMA).parquet(path)


def stream_envelopes(spark: SparkSession, path: str, max_files_per_trigger: int | None = 1000) -> DataFrame:
    """File twin of the topic reader. The bound on files of one batch stands for
    that on offsets: a backlog becomes several batches, none is left out."""
    reader = spark.readStream.schema(ENVELOPE_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def read_staged_json(spark: SparkSession, path: str, whole_file_arrays: bool = False) -> DataFrame:
    """Staged events; outer arrays become rows.

    By default each line is an object or an array of objects, and large files
    are split over tasks. `whole_file_arrays` reads files whose one array spans
    lines; Spark parses such a file in one task, so keep these files small.
    """
    return _staged(spark.read.schema(STAGED_READ_SCHEMA).option("multiLine", whole_file_arrays).json(path))


def _staged(rows: DataFrame) -> DataFrame:
    """Staged fields, the raw text of unreadable records, and the file they came from."""
    return rows.select(*STAGED_SCHEMA.names, F.col(CORRUPT_RECORD), F.col("_metadata.file_path").alias("source_file"))


def stream_staged_json(
    spark: SparkSession,
    path: str,
    whole_file_arrays: bool = False,
    max_files_per_trigger: int | None = 1000,
) -> DataFrame:
    """Continuous form: the checkpoint records loaded files, so each loads once."""
    reader = spark.readStream.schema(STAGED_READ_SCHEMA).option("multiLine", whole_file_arrays)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return _staged(reader.json(path))


def read_dead_letters(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(DEAD_LETTER_SCHEMA).parquet(path)


def read_landing(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    """A landed table. With `merge_schema`, fields added later are null in older files."""
    return spark.read.option("mergeSchema", merge_schema).parquet(path)


def read_landed_days(spark: SparkSession, table_path: str, landing_path: str) -> DataFrame:
    """All landed rows: the compacted table and what is still in the landing folder.

    `compact` retires the batches it moved, so the landing folder has those that
    came since, late rows of closed days among them. A batch that is in both,
    because a compaction broke off or the batch was written again, counts from
    the landing folder.
    """
    closed = read_days(spark, table_path)
    if not has_batches(spark, landing_path):
        return closed.drop(*BATCH_PARTITIONS)
    recent = spark.read.parquet(landing_path)
    recent = recent.withColumns({"run_id": F.col("run_id").cast("string"), "batch_id": F.col("batch_id").cast("bigint")})
    batches = recent.select("event_date", "run_id", "batch_id").distinct()
    return without_batches(closed, batches).unionByName(recent, allowMissingColumns=True).drop(*BATCH_PARTITIONS)


def newest_day(spark: SparkSession, table_path: str) -> date | None:
    """The last day of a table by day, from the names of its folders."""
    dated = [d for d in days_in(spark, table_path) if d != NULL_DAY]
    return date.fromisoformat(dated[-1]) if dated else None
