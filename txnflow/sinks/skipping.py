"""Which files of a table by day may hold an id: sorted files, Bloom filters, and an index of each file's ids.

A day's rows are dealt to files by ranges of ids, so that a file's first and
last id say much about what is in it. The index beside the table has these for
each file. It may lag behind: a file that it does not know is one that may hold
any id, and what it knows of files that are gone is ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnflow.operators.hotkeys import attach_carry, carry, in_slice, slice_by_range

ID = "transaction_id"


def index_path(table_path: str) -> str:
    """The folder of the index, beside the table's own."""
    return f"{table_path.rstrip('/')}-files"


def write_sorted_days(df: DataFrame, table_path: str) -> None:
    """Replace the days that occur in `df`, each in files by ranges of ids, sorted, with a Bloom filter on the id; then
    write these files to the index."""
    spark, order = df.sparkSession, ("event_date", ID)
    (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .write.option("partitionOverwriteMode", "dynamic")
        .option(f"parquet.bloom.filter.enabled#{ID}", "true")
        .mode("overwrite")
        .partitionBy("event_date")
        .parquet(table_path)
    )
    days = df.select("event_date").distinct()
    index_files(spark, table_path, days)


def index_files(spark: SparkSession, table_path: str, days: DataFrame | None = None) -> None:
    """Write first id, last id and rows of each file of some days (default: of all) to the index.

    Only ids of those days are read. At most one row per calendar day comes from `days`.
    """
    table = spark.read.parquet(table_path)
    if days is not None:
        wanted = days.select(F.col("event_date").cast("date").alias("_day"))
        table = table.join(F.broadcast(wanted), F.col("event_date").cast("date").eqNullSafe(F.col("_day")), "left_semi")
    rows = ends_of_files(table)
    rows.coalesce(1).write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy("event_date").parquet(index_path(table_path))


def ends_of_files(table: DataFrame) -> DataFrame:
    """`event_date`, `file`, `first_id`, `last_id` and `rows` of each file that `table` is read from."""
    path = F.col("_metadata.file_path").alias("file")
    files = table.select(F.col("event_date").cast("date").alias("event_date"), path, ID).groupBy("event_date", "file")
    ends = files.agg(F.min(ID).alias("first_id"), F.max(ID).alias("last_id"), F.count(F.lit(1)).alias("rows"))
    # Names are cut out of the paths of files, not of each row: that would take longer than all else here.
    return ends.withColumn("file", F.substring_index("file", "/", -2))


def files_that_may_hold(spark: SparkSession, table_path: str, ids: DataFrame) -> list[str]:
    """Paths of the table's files that may hold one of `ids` (a column `transaction_id`, distinct).

    Ids and the ends of files are sorted together by range, and a running count
    of ids at both ends of a file tells whether any lies between. No id reaches
    the driver, and no file is opened; paths do, as in any read of the table.
    """
    current = {"/".join(path.rsplit("/", 2)[-2:]): path for path in spark.read.parquet(table_path).inputFiles()}
    try:
        index = spark.read.schema("file string, first_id string, last_id string, rows bigint").parquet(index_path(table_path))
        known = index.where("first_id IS NOT NULL")
        indexed = {r["file"] for r in index.select("file").collect()}
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return list(current.values())
    mark = lambda pos, kind: F.struct(F.col(pos).alias("pos"), F.lit(kind).alias("kind"))
    ends = known.select("file", F.inline(F.array(mark("first_id", 0), mark("last_id", 2))))
    marks = ends.unionByName(ids.where(F.col(ID).isNotNull()).select(F.lit("").alias("file"), F.col(ID).alias("pos"), F.lit(1).alias("kind")))
    marks = marks.withColumn("_all", F.lit(0))
    order = ["pos", "kind", "file"]
    sliced = slice_by_range(marks, "_all", order, int(spark.conf.get("spark.sql.shuffle.partitions")))
    one = F.when(F.col("kind") == 1, 1).otherwise(0)
    earlier = carry(sliced, "_all", {"_before": F.sum(one)}, F.sum)
    running = F.sum(one).over(in_slice("_all", order).rowsBetween(-(1 << 63), 0)) + F.coalesce("_before", F.lit(0))
    counted = attach_carry(sliced, earlier, "_all").select("file", "kind", running.alias("ids"))
    inside = F.max(F.when(F.col("kind") == 2, F.col("ids"))) - F.max(F.when(F.col("kind") == 0, F.col("ids")))
    hit = counted.where("kind <> 1").groupBy("file").agg(inside.alias("ids")).where("ids > 0")
    may = {r["file"] for r in hit.select("file").collect()}
    return [path for name, path in current.items() if name in may or name not in indexed]
