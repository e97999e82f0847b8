"""Files that are one JSON array over many lines, or in one line, read by many tasks.

A file is read as the pieces between closing braces, by as many tasks as its size
asks for. Whether a piece begins inside a string, how deep it is nested and how
many records end before it are running totals over the pieces of a file: each is
summed per slice of the file and carried over the borders of slices. A brace that
closes a nesting of one level, outside of strings, ends a record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnflow.operators.hotkeys import SLICE, attach_carry, carry, in_slice, slice_by_range
from txnflow.schema import CORRUPT_RECORD, STAGED_READ_SCHEMA, STAGED_SCHEMA
from txnflow.session import cut_lineage

#: Pieces of one record, at most. What a file has beyond it without an end of a record is given piece by piece.
MOST_PIECES = 10_000
_FIRST, _PREVIOUS, _HERE = -(1 << 63), -1, 0


def _count(text: Column, char: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(char), F.lit("")))


def _total(sliced: DataFrame, value: Column, name: str, last: int) -> DataFrame:
    """Add `name`, the sum of `value` over the rows of the file up to this one, or up to the one before."""
    valued = sliced.withColumn("_value", value)
    earlier = carry(valued, "file", {"_earlier": F.sum("_value")}, F.sum)
    inside = F.sum("_value").over(in_slice("file", ["at"]).rowsBetween(_FIRST, last))
    total = F.coalesce(inside, F.lit(0)) + F.coalesce("_earlier", F.lit(0))
    return attach_carry(valued, earlier, "file").withColumn(name, total).drop("_value", "_earlier")


def split_arrays(spark: SparkSession, path: str, slices: int | None = None) -> DataFrame:
    """(source_file, place, record): the text of each object of the arrays, and `place`, which rises in a file.

    Braces, commas and escapes inside strings do not matter. Text that belongs
    to no whole object, as where a file is cut, is a record as well, so that
    nothing of a file is lost; blanks and brackets between objects are not.
    """
    read = spark.read.option("lineSep", "}").text(path)
    at = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"))
    pieces = read.select(F.col("_metadata.file_path").alias("file"), at.alias("at"), F.col("value").alias("piece"))
    sliced = slice_by_range(pieces, "file", ["at"], slices or int(spark.conf.get("spark.sql.shuffle.partitions")))
    bare = F.regexp_replace("piece", r"(?s)\\.", "")  # an escape never spans a brace that ends a piece
    quoted = _total(sliced, _count(bare, '"'), "quotes", _PREVIOUS)
    inside = F.col("quotes") % 2 == 1
    outside = F.regexp_replace(F.concat(F.when(inside, '"').otherwise(""), bare), '"[^"]*("|$)', "")
    closes = (F.col("quotes") + _count(bare, '"')) % 2 == 0
    nested = _count(outside, "{") + _count(outside, "[") - _count(outside, "]") - closes.cast("int")
    deep = _total(quoted.withColumn("closes", closes), nested, "depth", _HERE)
    ends = (F.col("closes") & (F.col("depth") == 1)).alias("ends")
    numbered = _total(deep.select("file", SLICE, "at", "piece", ends), F.col("ends").cast("int"), "record", _PREVIOUS)
    numbered = cut_lineage(numbered.select("file", "record", "at", "piece", "ends"), "pieces")
    large = numbered.groupBy("file", "record").count().where(F.col("count") > MOST_PIECES)
    large = large.select(F.col("file").alias("_f"), F.col("record").alias("_r"))
    alone = (F.col("file") == F.col("_f")) & (F.col("record") == F.col("_r"))
    parts = numbered.join(large, alone, "left").withColumn("part", F.when(F.col("_f").isNotNull(), F.col("at")))
    whole = parts.groupBy("file", "record", "part").agg(
        F.array_sort(F.collect_list(F.struct("at", "piece"))).alias("pieces"), F.max("ends").alias("ends"), F.min("at").alias("place")
    )
    text = F.concat(F.array_join("pieces.piece", "}"), F.when(F.col("ends"), "}").otherwise(""))
    record = F.regexp_replace(text, r"^[\s,\[]+", "")
    records = whole.select(F.col("file").alias("source_file"), "place", record.alias("record"), "ends")
    return records.where(F.col("ends") | ~F.col("record").rlike(r"^[\s,\]]*$")).drop("ends")


def read_staged_arrays(spark: SparkSession, path: str, slices: int | None = None) -> DataFrame:
    """Staged events from files of one array each, as `read_staged_json` gives them; records that are no object keep
    their text."""
    records = split_arrays(spark, path, slices)
    parsed = F.from_json("record", STAGED_READ_SCHEMA, {"columnNameOfCorruptRecord": CORRUPT_RECORD})
    rows = records.select("source_file", "record", F.inline(F.array(parsed)))
    ended = F.rtrim("record").endswith("}")
    corrupt = F.when(ended, F.col(CORRUPT_RECORD)).otherwise(F.col("record")).alias(CORRUPT_RECORD)
    return rows.select(*STAGED_SCHEMA.names, corrupt, "source_file")
