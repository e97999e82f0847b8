"""Batches of a committed table appear whole, once, or not at all."""

import glob
from datetime import date, datetime, timedelta
from decimal import Decimal

import pyarrow as pa
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from txnflow.sinks.committed import FORMAT, CommittedFiles, CommittedSink, _Files, commits, read_committed, remove_unnamed

SCHEMA = "id long, event_date date, amount decimal(18,2), metadata map<string,string>, at timestamp_ntz, name string"


def rows(spark, n, first=0):
    day = F.expr("date'2024-01-01' + cast(id % 10 as int)")
    return spark.range(first, first + n).select(
        "id",
        day.alias("event_date"),
        (F.col("id") / 100).cast("decimal(18,2)").alias("amount"),
        F.create_map(F.lit("k"), F.col("id").cast("string")).alias("metadata"),
        F.lit("2024-01-01 10:00:00").cast("timestamp_ntz").alias("at"),
        F.when(F.col("id") % 3 > 0, F.concat(F.lit("é"), "id")).alias("name"),
    )


def read(spark, root, **days):
    return read_committed(spark, str(root), SCHEMA, **days)


def files(root):
    return glob.glob(f"{root}/files/*")


def test_rows_come_back_as_written(spark, tmp_path):
    CommittedSink(str(tmp_path)).write_batch(rows(spark, 500), "run", 0)
    assert sorted(map(repr, read(spark, tmp_path).collect())) == sorted(map(repr, rows(spark, 500).collect()))


def test_a_batch_written_again_stays_once(spark, tmp_path):
    sink = CommittedSink(f"file:{tmp_path}")
    for run, batch in [("a", 0), ("a", 0), ("a", 1), ("b", 0), ("a", 1)]:
        sink.write_batch(rows(spark, 50), run, batch)
    assert read(spark, tmp_path).count() == 150
    assert len(files(tmp_path)) == commits(spark, str(tmp_path)).count()
    assert {(r.run_id, r.batch_id) for r in commits(spark, str(tmp_path)).collect()} == {("a", 0), ("a", 1), ("b", 0)}


def _tasks_only(root, n):
    """The tasks of a write that never comes to its commit."""
    writer = _Files({"path": str(root), "run_id": "run"}, None)
    ids = pa.array(range(n), pa.int64())
    return writer, writer.write(iter([pa.RecordBatch.from_arrays([ids], ["id"])]))


def test_a_job_that_dies_before_its_commit_leaves_no_row(spark, tmp_path):
    _tasks_only(tmp_path, 9)
    assert len(files(tmp_path)) == 1
    CommittedSink(str(tmp_path)).write_batch(rows(spark, 20), "run", 1)
    assert read(spark, tmp_path).count() == 20
    CommittedSink(str(tmp_path)).write_batch(rows(spark, 9), "run", 0)  # the retry
    assert read(spark, tmp_path).count() == 29
    now = datetime.now()
    assert remove_unnamed(spark, str(tmp_path), now - timedelta(hours=1)) == 0
    assert remove_unnamed(spark, str(tmp_path), now + timedelta(hours=1)) == 1
    assert len(files(tmp_path)) == commits(spark, str(tmp_path)).count()
    assert read(spark, tmp_path).count() == 29


def test_a_commit_that_stops_halfway_is_not_read(spark, tmp_path):
    writer, message = _tasks_only(tmp_path, 9)
    folder = tmp_path / "commits" / "run_id=run"
    folder.mkdir(parents=True)
    (folder / "_draft").write_text('{"file": "half')
    assert read(spark, tmp_path).count() == 0
    writer.publish([message, None], 0)
    assert commits(spark, str(tmp_path)).first().rows == 9


def test_an_aborted_job_deletes_what_its_tasks_wrote(spark, tmp_path):
    spark.dataSource.register(CommittedFiles)
    one_fails = F.when(F.col("id") == 399, F.raise_error(F.lit("lost")).cast("long")).otherwise(F.col("id"))
    failing = rows(spark, 400).repartition(1).withColumn("id", one_fails)
    good = rows(spark, 100, first=400).repartition(1)
    both = good.union(failing)  # the first task ends, the second fails
    with pytest.raises(PySparkException):
        both.write.format(FORMAT).options(path=str(tmp_path), run_id="run", batch_id="0").mode("append").save()
    assert not glob.glob(f"{tmp_path}/commits/*/*")
    CommittedSink(str(tmp_path)).write_batch(rows(spark, 7), "run", 0)
    assert read(spark, tmp_path).count() == 7


def test_days_pick_files(spark, tmp_path):
    sink = CommittedSink(str(tmp_path))
    for day in range(4):
        sink.write_batch(rows(spark, 40).where(F.col("event_date") == date(2024, 1, 1 + day)), "run", day)
    undated = rows(spark, 2).withColumn("event_date", F.when(F.col("id") == 1, F.col("event_date")))
    sink.write_batch(undated, "run", 9)
    found = read(spark, tmp_path, first_day=date(2024, 1, 2), last_day=date(2024, 1, 3))
    # Both days, and the file with a row without a day.
    assert len(found.inputFiles()) == 3
    assert found.where("event_date between '2024-01-02' and '2024-01-03'").count() == 9
    assert read(spark, tmp_path).count() == 18


def test_large_batches_become_several_files(spark, tmp_path):
    writer = _Files({"path": str(tmp_path), "run_id": "run", "file_bytes": "1"}, None)
    wide = pa.RecordBatch.from_arrays([pa.array(["x" * 3_000_000] * 4)], ["text"])
    done = writer.write(iter([wide] * 6))
    assert [f["rows"] for f in done.files] == [8, 8, 8]
    assert writer.write(iter([wide.slice(0, 0)])).files == []


def test_empty_batch_and_missing_table(spark, tmp_path):
    CommittedSink(str(tmp_path)).write_batch(rows(spark, 0), "run", 0)
    assert read(spark, tmp_path).count() == 0
    assert glob.glob(f"{tmp_path}/commits/run_id=run/batch_id=0.json")


def test_options_are_checked(spark, tmp_path):
    with pytest.raises(ValueError, match="run_id"):
        _Files({"path": str(tmp_path)}, None)
    spark.dataSource.register(CommittedFiles)
    options = {"path": str(tmp_path), "run_id": "run", "batch_id": "0", "day": "absent"}
    with pytest.raises(PySparkException, match="no column absent"):
        rows(spark, 5).write.format(FORMAT).options(**options).mode("append").save()
    assert not files(tmp_path)


def test_a_stream_commits_its_batches_once(spark, tmp_path):
    spark.dataSource.register(CommittedFiles)
    schema = rows(spark, 1).schema

    def run(checkpoint):
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
        options = {"path": f"{tmp_path}/out", "run_id": "run", "checkpointLocation": f"{tmp_path}/{checkpoint}"}
        stream.writeStream.format(FORMAT).options(**options).trigger(availableNow=True).start().awaitTermination()

    for k in range(3):
        rows(spark, 10, first=10 * k).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    run("checkpoint")
    assert read(spark, tmp_path / "out").count() == 30
    run("lost")  # the same run again from its first batch, as when its checkpoint was lost
    assert read(spark, tmp_path / "out").count() == 30
    assert sorted(r.batch_id for r in commits(spark, f"{tmp_path}/out").collect()) == [0, 1, 2]
    assert len(files(tmp_path / "out")) == 3
