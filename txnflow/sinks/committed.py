"""An append-only file table whose batches appear whole, once, or not at all.

Tasks write Parquet files below `files`; nothing reads that folder by listing it.
When all tasks are done, one small file below `commits` names the files of the
batch, under (run_id, batch_id), and with it the batch appears. A job that dies
before leaves files that no commit names, which `remove_unnamed` deletes later.
A batch that has its commit is not published again: the retry's files go.

Commits also tell rows, bytes and the days of each file, so readers of some days
open only files that may hold them.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import date, datetime

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

FORMAT = "committed_files"
#: A task begins a new file when one has this many bytes, and a row group when so many wait.
FILE_BYTES, GROUP_BYTES = 128 << 20, 16 << 20
COMMIT_SCHEMA = "file string, rows long, bytes long, first_day date, last_day date, run_id string, batch_id long"


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path and the path in it; any that Arrow knows: local, HDFS, S3, GCS, Azure."""
    if path.startswith("file:"):
        path = "/" + path[len("file:") :].lstrip("/")
    system, inner = fs.FileSystem.from_uri(path)
    return system, inner.rstrip("/")


def put_whole(system: fs.FileSystem, folder: str, name: str, text: str) -> None:
    """Write a small file that gets its name only when it is whole; it replaces one of that name."""
    system.create_dir(folder, recursive=True)
    # Names that begin with "_" are not read by Spark.
    draft = f"{folder}/_{uuid.uuid4().hex}"
    with system.open_output_stream(draft) as out:
        out.write(text.encode())
    system.move(draft, f"{folder}/{name}")


def _row_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
        if sum(b.nbytes for b in held) >= GROUP_BYTES:
            yield pa.Table.from_batches(held)
            held = []
    if held:
        yield pa.Table.from_batches(held)


@dataclass
class _Written(WriterCommitMessage):
    """What one task wrote: name, rows, bytes, first and last day of each file."""

    files: list[dict]


class _Files:
    """The two ends of a write: `write` in the tasks, `publish` and `discard` on the driver."""

    def __init__(self, options: dict, schema: StructType):
        if "path" not in options or "run_id" not in options:
            raise ValueError(f"{FORMAT} needs the options path and run_id")
        self._path, self._run_id = options["path"], options["run_id"]
        self._day = options.get("day")
        if self._day and self._day not in schema.names:
            raise ValueError(f"no column {self._day}")
        self._limit = int(options.get("file_bytes", FILE_BYTES))

    def write(self, batches: Iterator[pa.RecordBatch]) -> _Written:
        """Batches go to disk as they come; a task holds one row group. A task without rows writes no file."""
        system, root = opened(self._path)
        system.create_dir(f"{root}/files", recursive=True)
        done: list[dict] = []
        writer = sink = None
        for group in _row_groups(batches):
            if writer is None:
                name = f"{uuid.uuid4().hex}.parquet"
                sink = system.open_output_stream(f"{root}/files/{name}")
                writer = pq.ParquetWriter(sink, group.schema)
                done.append({"file": name, "rows": 0, "bytes": 0, "first_day": None, "last_day": None})
            writer.write_table(group)
            self._note(done[-1], group)
            if sink.tell() >= self._limit:
                self._close(writer, sink, done[-1])
                writer = None
        if writer is not None:
            self._close(writer, sink, done[-1])
        return _Written(done)

    def _note(self, file: dict, rows: pa.Table) -> None:
        file["rows"] += rows.num_rows
        if not self._day:
            return
        found = pc.min_max(rows.column(self._day))
        days = [d.isoformat() for d in (found["min"].as_py(), found["max"].as_py()) if d is not None]
        if rows.column(self._day).null_count:
            file["undated"] = True
        if days:
            file["first_day"] = min(days[0], file["first_day"] or days[0])
            file["last_day"] = max(days[1], file["last_day"] or days[1])

    @staticmethod
    def _close(writer: pq.ParquetWriter, sink: pa.NativeFile, file: dict) -> None:
        writer.close()
        file["bytes"] = sink.tell()
        sink.close()

    def publish(self, messages: list[_Written | None], batch_id: int) -> None:
        """Name the batch's files in its commit."""
        system, root = opened(self._path)
        folder = f"{root}/commits/run_id={self._run_id}"
        commit = f"{folder}/batch_id={batch_id}.json"
        if system.get_file_info(commit).type != fs.FileType.NotFound:
            self.discard(messages)
            return
        owner = {"run_id": self._run_id, "batch_id": batch_id}
        lines = []
        for message in filter(None, messages):
            for file in message.files:
                undated = file.pop("undated", False)
                # A file with undated rows may belong to any question about days.
                days = {"first_day": None, "last_day": None} if undated else {}
                lines.append(json.dumps({**file, **days, **owner}) + "\n")
        put_whole(system, folder, f"batch_id={batch_id}.json", "".join(lines))

    def discard(self, messages: list[_Written | None]) -> None:
        system, root = opened(self._path)
        for message in filter(None, messages):
            for file in message.files:
                _delete(system, f"{root}/files/{file['file']}")


def _delete(system: fs.FileSystem, path: str) -> bool:
    """Delete a file that may be gone already."""
    try:
        system.delete_file(path)
        return True
    except FileNotFoundError:
        return False


class _BatchWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, schema: StructType):
        self._files = _Files(options, schema)
        self._batch_id = int(options["batch_id"])

    def write(self, iterator):
        return self._files.write(iterator)

    def commit(self, messages):
        self._files.publish(messages, self._batch_id)

    def abort(self, messages):
        self._files.discard(messages)


class _StreamWriter(DataSourceStreamArrowWriter):
    def __init__(self, options: dict, schema: StructType):
        self._files = _Files(options, schema)

    def write(self, iterator):
        return self._files.write(iterator)

    def commit(self, messages, batchId):
        self._files.publish(messages, batchId)

    def abort(self, messages, batchId):
        self._files.discard(messages)


class CommittedFiles(DataSource):
    """`df.write.format("committed_files")` and `writeStream`; options path, run_id, day, file_bytes, and batch_id for a batch."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        if overwrite:
            raise ValueError(f"{FORMAT} only takes appends")
        return _BatchWriter(dict(self.options), schema)

    def streamWriter(self, schema: StructType, overwrite: bool) -> DataSourceStreamArrowWriter:
        return _StreamWriter(dict(self.options), schema)


@dataclass(frozen=True)
class CommittedSink:
    """Micro-batches into a committed table; a batch that is there is not written again."""

    path: str
    day: str | None = "event_date"

    def write_batch(self, df: DataFrame, run_id: str, batch_id: int) -> None:
        df.sparkSession.dataSource.register(CommittedFiles)
        day = {"day": self.day} if self.day else {}
        even = df.hint("rebalance", *day.values())
        # Sorted by day, a file holds few days, and readers of others skip it.
        rows = even.sortWithinPartitions(*day.values()) if day else even
        options = {"path": self.path, "run_id": run_id, "batch_id": str(batch_id), **day}
        rows.write.format(FORMAT).options(**options).mode("append").save()


def commits(spark: SparkSession, path: str) -> DataFrame:
    """One row per committed file."""
    return spark.read.schema(COMMIT_SCHEMA).option("recursiveFileLookup", "true").json(f"{path}/commits")


def read_committed(
    spark: SparkSession, path: str, schema: StructType | str, first_day: date | None = None, last_day: date | None = None
) -> DataFrame:
    """Rows of committed batches; of those files only that may hold one of the days, if days are given.

    Files, not rows, are picked by day: filter the rows as well. The names of the
    picked files pass through the driver, as in any file scan. A table without
    files gives no rows.
    """
    files = commits(spark, path)
    undated = F.col("first_day").isNull()
    if first_day:
        files = files.where(undated | (F.col("last_day") >= F.lit(first_day)))
    if last_day:
        files = files.where(undated | (F.col("first_day") <= F.lit(last_day)))
    names = [f"{path}/files/{r.file}" for r in files.select("file").toLocalIterator()]
    return spark.read.schema(schema).parquet(*names) if names else spark.createDataFrame([], schema)


def remove_unnamed(spark: SparkSession, path: str, before: datetime) -> int:
    """Delete files written before `before` that no commit names, in tasks; returns how many.

    `before` must lie further back than the longest batch takes, whose files have no commit yet.
    """
    # The content column is not read.
    found = spark.read.format("binaryFile").load(f"{path}/files").select("path", "modificationTime")
    old = found.where(F.col("modificationTime") < F.lit(before)).select(F.substring_index("path", "/", -1).alias("file"))
    lost = old.join(commits(spark, path).select("file"), "file", "left_anti")

    def delete(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = opened(path)
        for batch in batches:
            gone = [_delete(system, f"{root}/files/{name}") for name in batch.column("file").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([sum(gone)], pa.int64())], names=["n"])

    return lost.mapInArrow(delete, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
