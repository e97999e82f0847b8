"""Counts, lag and rate of each batch of a stream as it ends, without a job of their own.

The writes of a batch count their rows in passing, and the query's own report
adds lag and rate. One small file for each batch goes below a folder, under
(run_id, batch_id), so a batch that is tried again replaces its row.

The report of a batch comes shortly after its commit. A driver that dies in
between leaves no row for that batch, and rows of a stage that Spark ran again may
count twice: these are figures to watch. `PipelineConfig.metrics` holds exact ones.
"""

from __future__ import annotations

import json
import threading
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from txnflow.sinks.committed import opened, put_whole
from txnflow.streaming.progress import consumer_lag

COUNTS = ("rows_in", "duplicates", "rows_written", "rows_invalid")
SCHEMA = ", ".join([*(f"{c} long" for c in COUNTS), "lag long, rows_per_second double, batch_ms long, reported timestamp"])
SCHEMA += ", run_id string, batch_id long"


class LiveMetrics(StreamingQueryListener):
    """Register with `spark.streams.addListener` and hand to `PipelineConfig.live`.

    Batches of queries that note nothing here are passed over.
    """

    def __init__(self, folder: str):
        self._folder = folder
        self._noted: dict[tuple[str, int], tuple[str, dict]] = {}
        self._changed = threading.Condition()

    def note(self, query_id: str, run_id: str, batch_id: int, counts: dict) -> None:
        """What the writes of a batch counted; the report of its end is still to come."""
        with self._changed:
            self._noted[query_id, batch_id] = (run_id, counts)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = json.loads(event.progress.json)
        place = (progress["id"], progress["batchId"])
        with self._changed:
            noted = self._noted.get(place)
        if noted is None:
            return
        try:
            self._put(progress, *noted)
        finally:
            with self._changed:
                # Batches before this one have ended; those that failed noted something and report nothing.
                for key in [k for k in self._noted if k[0] == place[0] and k[1] <= place[1]]:
                    del self._noted[key]
                self._changed.notify_all()

    def _put(self, progress: dict, run_id: str, counts: dict) -> None:
        row = {
            **counts,
            "lag": consumer_lag(progress),
            # Not a number, which JSON lacks, where a batch took no time.
            "rows_per_second": _number(progress.get("processedRowsPerSecond")),
            "batch_ms": progress.get("batchDuration"),
            "reported": progress["timestamp"],
            "run_id": run_id,
            "batch_id": progress["batchId"],
        }
        system, root = opened(self._folder)
        put_whole(system, f"{root}/run_id={run_id}", f"batch_id={progress['batchId']}.json", json.dumps(row) + "\n")

    def wait(self, seconds: float = 30) -> bool:
        """Wait until every noted batch has its row; False if one has not by then."""
        end = time.monotonic() + seconds
        with self._changed:
            return self._changed.wait_for(lambda: not self._noted, max(0.0, end - time.monotonic()))


def _number(value) -> float | None:
    return float(value) if isinstance(value, int | float) and value == value else None


def read_live(spark: SparkSession, folder: str) -> DataFrame:
    """One row per batch."""
    return spark.read.schema(SCHEMA).option("recursiveFileLookup", "true").json(folder)
