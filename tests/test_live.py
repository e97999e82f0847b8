"""Live metrics against the exact ones of the same stream."""

import json
from dataclasses import replace

import pytest

from tests.test_parse import having, without
from tests.test_streaming import KEY, config, drop_file
from txnflow.schema import ENVELOPE_SCHEMA
from txnflow.sinks.landing import ConnectorSink
from txnflow.streaming import pipeline
from txnflow.streaming.live import COUNTS, LiveMetrics, read_live
from txnflow.streaming.progress import consumer_lag

BATCHES = (
    [having(transaction_id="a"), having(transaction_id="a"), having(transaction_id="b"), "nonsense"],
    ["{", "[]", without("transaction_id")],  # nothing to land
    [having(transaction_id="c"), having(transaction_id="a")],  # nothing refused
)


def run(spark, root, name, **settings):
    stream = spark.readStream.schema(ENVELOPE_SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    pipeline.start_pipeline(stream, replace(config(f"{root}/{name}"), **settings), KEY).awaitTermination()


def counts(rows):
    return [tuple(r) for r in rows.orderBy("batch_id").select("batch_id", *COUNTS).collect()]


@pytest.fixture
def meter(spark, tmp_path):
    listener = LiveMetrics(f"{tmp_path}/live")
    spark.streams.addListener(listener)
    yield listener
    spark.streams.removeListener(listener)


@pytest.fixture
def source(spark, tmp_path):
    for k, texts in enumerate(BATCHES):
        drop_file(spark, tmp_path, texts, start=10 * k)
    return tmp_path


def test_live_counts_equal_the_exact_ones(spark, source, meter, monkeypatch):
    run(spark, source, "exact")
    exact = counts(spark.read.parquet(f"{source}/exact/metrics"))
    assert len(exact) == 3 and sorted(r[1:] for r in exact) == [(0, 0, 0, 3), (2, 0, 2, 0), (3, 1, 2, 1)]

    def no_job(tagged):
        raise AssertionError("a job that counts")

    monkeypatch.setattr(pipeline, "_batch_counts", no_job)
    run(spark, source, "observed", live=meter, metrics=None)
    assert meter.wait()
    live = read_live(spark, f"{source}/live")
    assert counts(live) == exact
    assert live.where("batch_ms is null or reported is null or lag <> 0").count() == 0
    # The same rows landed and were refused.
    for table in ("landing", "dlq"):
        one, other = (spark.read.parquet(f"{source}/{name}/{table}") for name in ("exact", "observed"))
        apart = [c for c in ("run_id", "ingested_at", "_file_row_number", "metadata") if c in one.columns]
        one, other = one.drop(*apart), other.drop(*apart)
        assert one.count() == other.count() and one.exceptAll(other).isEmpty()


def test_exact_metrics_are_reported_too(spark, source, meter):
    run(spark, source, "both", live=meter)
    assert meter.wait()
    assert counts(read_live(spark, f"{source}/live")) == counts(spark.read.parquet(f"{source}/both/metrics"))


def test_a_sink_that_has_the_batch_leaves_its_count_unknown(spark, source, meter):
    sink = ConnectorSink("parquet", f"{source}/ledger", {"path": f"{source}/warehouse"})
    run(spark, source, "first", live=meter, metrics=None, landing=sink, run_id="one")
    assert meter.wait()
    before = counts(read_live(spark, f"{source}/live"))
    run(spark, source, "again", live=meter, metrics=None, landing=sink, run_id="one")
    assert meter.wait()
    after = counts(read_live(spark, f"{source}/live"))
    assert [(r[0], r[4]) for r in after] == [(r[0], r[4]) for r in before] and sorted(r[3] for r in before) == [0, 2, 2]
    assert all(r[1:4] == (None, None, None) for r in after)
    assert spark.read.parquet(f"{source}/warehouse").count() == 4


class _Event:
    def __init__(self, **progress):
        self.progress = type("Progress", (), {"json": json.dumps(progress)})


def test_reports(spark, tmp_path):
    meter = LiveMetrics(str(tmp_path))
    sources = [{"latestOffset": {"t": {"0": 50, "1": 7}}, "endOffset": {"t": {"0": 20, "1": 7}}}, {"latestOffset": {"logOffset": 3}}]
    assert consumer_lag({"sources": sources}) == 30
    for batch in (3, 4, 5):  # batch 3 failed and was not reported
        meter.note("q", "run", batch, dict.fromkeys(COUNTS, batch))
    assert not meter.wait(0)
    for batch, rate in ((4, float("nan")), (5, 8.5), (5, 9.5), (6, 1.0)):
        meter.onQueryProgress(
            _Event(id="q", batchId=batch, timestamp="2024-01-01T00:00:00Z", sources=sources, processedRowsPerSecond=rate, batchDuration=10)
        )
    assert meter.wait(0)
    rows = read_live(spark, str(tmp_path)).orderBy("batch_id").collect()
    assert [(r.batch_id, r.rows_in, r.lag, r.rows_per_second) for r in rows] == [(4, 4, 30, None), (5, 5, 30, 8.5)]
