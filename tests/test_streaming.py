from dataclasses import replace
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.test_files import STAGED
from tests.test_parse import envelopes, having, without
from txnflow.functions import TokenKey
from txnflow.operators.dedupe import dedupe_in_batch
from txnflow.operators.parse import parse_and_validate
from txnflow.operators.transform import landing_projection, transform
from txnflow.plans.models import stg_card_transactions
from txnflow.schema import ENVELOPE_SCHEMA
from txnflow.sinks.landing import ConnectorSink, FileSink
from txnflow.sources.files import read_dead_letters, stream_envelopes, stream_staged_json
from txnflow.sinks.topic import TopicSink
from txnflow.streaming.pipeline import HeldBatch, MicroBatchWriter, PipelineConfig, start_file_ingest, start_pipeline
from txnflow.streaming.progress import consumer_lag
from txnflow.streaming.views import dead_letter_spikes, dedupe_within_watermark

KEY = TokenKey(b"k")
ONCE = {"availableNow": True}


def config(root, **settings):
    return PipelineConfig(
        landing=FileSink(f"{root}/landing"),
        dead_letters=FileSink(f"{root}/dlq"),
        metrics=FileSink(f"{root}/metrics", partition_by=()),
        checkpoint=f"{root}/checkpoint",
        trigger=ONCE,
        **settings,
    )


def drop_file(spark, root, texts, start=0):
    """Add one file of envelopes to the source folder."""
    rows = envelopes(spark, texts).withColumn("offset", F.col("offset") + start)
    rows.coalesce(1).write.mode("append").parquet(f"{root}/in")


def run(spark, root, cfg):
    query = start_pipeline(stream_envelopes(spark, f"{root}/in", 1), cfg, KEY)
    query.awaitTermination()
    return query


def ids(frame):
    return sorted(r.transaction_id for r in frame.collect())


def test_stream_equals_batch(spark, tmp_path):
    texts = [having(transaction_id="a"), having(transaction_id="a"), having(transaction_id="b"), "junk", without("transaction_id")]
    drop_file(spark, tmp_path, texts)
    run(spark, tmp_path, config(tmp_path))
    raw = envelopes(spark, texts)
    valid, invalid = parse_and_validate(raw)
    batch = landing_projection(transform(dedupe_in_batch(valid), KEY)).drop("ingested_at")
    landed = spark.read.parquet(f"{tmp_path}/landing").drop("ingested_at", "run_id", "batch_id")
    assert sorted(map(str, landed.select(batch.columns).collect())) == sorted(map(str, batch.collect()))
    letters = read_dead_letters(spark, f"{tmp_path}/dlq")
    assert sorted(r.offset for r in letters.collect()) == sorted(r.offset for r in invalid.collect()) == [3, 4]
    row = spark.read.parquet(f"{tmp_path}/metrics").first()
    assert (row.rows_in, row.duplicates, row.rows_written, row.rows_invalid) == (3, 1, 2, 2)


def test_restart_goes_on_from_the_checkpoint(spark, tmp_path):
    cfg = config(tmp_path)
    drop_file(spark, tmp_path, [having(transaction_id="a")])
    first = run(spark, tmp_path, cfg)
    drop_file(spark, tmp_path, [having(transaction_id="b")], start=10)
    second = run(spark, tmp_path, cfg)
    landed = spark.read.parquet(f"{tmp_path}/landing")
    assert ids(landed) == ["a", "b"]
    assert {(r.run_id, r.batch_id) for r in landed.collect()} == {(str(first.id), 0), (str(first.id), 1)}
    assert str(first.id) == str(second.id)


def test_replayed_batch_leaves_the_tables(spark, tmp_path):
    cfg = config(tmp_path, run_id="r")
    raw = envelopes(spark, [having(transaction_id="a"), "junk"])
    writer = MicroBatchWriter(cfg, KEY)
    for _ in range(3):
        writer.write(raw, 4)
    assert ids(spark.read.parquet(f"{tmp_path}/landing")) == ["a"]
    assert read_dead_letters(spark, f"{tmp_path}/dlq").count() == 1
    assert spark.read.parquet(f"{tmp_path}/metrics").count() == 1


def test_empty_batch_writes_nothing(spark, tmp_path):
    MicroBatchWriter(config(tmp_path, run_id="r"), KEY).write(envelopes(spark, []), 0)
    assert not (tmp_path / "landing").exists() and not (tmp_path / "metrics").exists()


def test_batch_of_dead_letters_only(spark, tmp_path):
    MicroBatchWriter(config(tmp_path, run_id="r"), KEY).write(envelopes(spark, ["junk"]), 0)
    row = spark.read.parquet(f"{tmp_path}/metrics").first()
    assert (row.rows_in, row.rows_written, row.rows_invalid) == (0, 0, 1)


def test_failed_write_fails_the_query(spark, tmp_path):
    drop_file(spark, tmp_path, [having()])
    broken = ConnectorSink("no_such_format", f"{tmp_path}/ledger")
    cfg = PipelineConfig(landing=broken, dead_letters=FileSink(f"{tmp_path}/dlq"), checkpoint=f"{tmp_path}/checkpoint", trigger=ONCE)
    query = start_pipeline(stream_envelopes(spark, f"{tmp_path}/in"), cfg, KEY)
    with pytest.raises(Exception, match="no_such_format"):
        query.awaitTermination()
    # The batch was not committed: a repaired sink gets it on the next start.
    run(spark, tmp_path, config(tmp_path))
    assert ids(spark.read.parquet(f"{tmp_path}/landing")) == ["t1"]


def test_strict_pipeline_refuses_broken_fields(spark, tmp_path):
    drop_file(spark, tmp_path, [having(transaction_id="ok"), having(amount_cents="x")])
    run(spark, tmp_path, config(tmp_path, strict=True))
    assert ids(spark.read.parquet(f"{tmp_path}/landing")) == ["ok"]
    assert read_dead_letters(spark, f"{tmp_path}/dlq").first().dlq_reason == "CONTRACT_amount_cents"


def test_a_place_for_dead_letters_and_a_run_id_are_required(spark, tmp_path):
    with pytest.raises(TypeError, match="dead_letters"):
        PipelineConfig(landing=FileSink("l"), checkpoint="c")
    with pytest.raises(ValueError, match="run_id"):
        MicroBatchWriter(config(tmp_path), KEY).write(envelopes(spark, ["junk"]), 0)


def test_dead_letters_to_a_topic_from_the_same_query(spark, tmp_path):
    cfg = config(tmp_path)
    cfg = replace(cfg, dead_letters=TopicSink({"path": f"{tmp_path}/topic"}, fmt="parquet"))
    drop_file(spark, tmp_path, [having(transaction_id="a"), "junk"])
    run(spark, tmp_path, cfg)
    message = spark.read.parquet(f"{tmp_path}/topic").first()
    assert bytes(message.key) == b"ACC-1" and '"dlq_reason":"PARSE_FAILURE"' in message.value
    assert ids(spark.read.parquet(f"{tmp_path}/landing")) == ["a"]


def test_every_prefix_of_a_payload_takes_one_route(spark, tmp_path):
    text = having(metadata={"a": "b", "c": {"d": 1}})
    texts = [text[:i] for i in range(len(text) + 1)]
    drop_file(spark, tmp_path, texts)
    run(spark, tmp_path, config(tmp_path))
    assert [r.kafka_offset for r in spark.read.parquet(f"{tmp_path}/landing").collect()] == [len(text)]
    letters = read_dead_letters(spark, f"{tmp_path}/dlq").collect()
    assert sorted(r.offset for r in letters) == list(range(len(text)))


def test_gate_holds_a_batch_back(spark, tmp_path):
    cfg = config(tmp_path, gate=True, run_id="r")
    writer = MicroBatchWriter(cfg, KEY)
    for texts, reason in (
        ([having(), "junk"], "contract payload: 1"),
        ([having(transaction_id="a", event_type="GIFT")], "accepted_values event_type: 1"),
        ([having(transaction_id="a", amount_cents="x")], "not_null amount_cents: 1"),
    ):
        with pytest.raises(HeldBatch, match=reason):
            writer.write(envelopes(spark, texts), 0)
        assert not (tmp_path / "landing").exists() and not (tmp_path / "dlq").exists()
    writer.write(envelopes(spark, [having(transaction_id="a"), having(transaction_id="a")]), 0)
    assert ids(spark.read.parquet(f"{tmp_path}/landing")) == ["a"]


def test_held_batch_stops_the_stream_and_is_tried_again(spark, tmp_path):
    drop_file(spark, tmp_path, [having(transaction_id="a"), "junk"])
    query = start_pipeline(stream_envelopes(spark, f"{tmp_path}/in"), config(tmp_path, gate=True), KEY)
    with pytest.raises(Exception, match="contract payload: 1"):
        query.awaitTermination()
    run(spark, tmp_path, config(tmp_path))
    assert ids(spark.read.parquet(f"{tmp_path}/landing")) == ["a"]


def test_broken_staged_records_become_dead_letters(spark, tmp_path):
    import json

    folder = tmp_path / "staged"
    folder.mkdir()
    good = json.dumps(STAGED)
    nameless = json.dumps({k: v for k, v in STAGED.items() if k != "transaction_id"})
    long = json.dumps(STAGED | {"transaction_id": "s9", "currency": "EUROS"})
    (folder / "a.json").write_text("\n".join([good, good[:-5], nameless, nameless.replace("1", "2"), long]))
    cfg = config(tmp_path, strict=True)
    start_file_ingest(stream_staged_json(spark, str(folder)), cfg).awaitTermination()
    assert ids(spark.read.parquet(f"{tmp_path}/landing")) == ["s1"]
    letters = read_dead_letters(spark, f"{tmp_path}/dlq").collect()
    assert sorted(r.dlq_reason for r in letters) == ["CONSTRAINT_currency"] + ["PARSE_FAILURE"] * 3
    assert all(r.topic.endswith("a.json") for r in letters) and bytes(good[:-5], "utf-8") in [bytes(r.payload) for r in letters]


def test_staged_files_load_once(spark, tmp_path):
    import json

    folder = tmp_path / "staged"
    folder.mkdir()
    cfg = config(tmp_path)

    def ingest():
        start_file_ingest(stream_staged_json(spark, str(folder), whole_file_arrays=True), cfg).awaitTermination()
        return ids(spark.read.parquet(f"{tmp_path}/landing"))

    (folder / "a.json").write_text(json.dumps([STAGED, STAGED | {"transaction_id": "s2"}], indent=1))
    assert ingest() == ["s1", "s2"]
    (folder / "b.json").write_text(json.dumps([STAGED | {"transaction_id": "s3"}]))
    assert ingest() == ["s1", "s2", "s3"]


def typed(envelope_rows):
    return transform(parse_and_validate(envelope_rows).valid, KEY)


def run_dedupe(spark, root, lanes=0):
    rows = dedupe_within_watermark(typed(stream_envelopes(spark, f"{root}/in", 1)), "10 minutes", lanes=lanes)
    query = rows.select("transaction_id").writeStream.option("checkpointLocation", f"{root}/view-checkpoint")
    query.trigger(**ONCE).start(f"{root}/view", format="parquet", outputMode="append").awaitTermination()
    return ids(spark.read.parquet(f"{root}/view"))


def test_view_drops_a_copy_from_a_later_batch_but_also_late_rows(spark, tmp_path):
    at = datetime(2024, 1, 2, 12)

    def sent(name, time):
        return having(transaction_id=name, event_timestamp=time.isoformat())

    drop_file(spark, tmp_path, [sent("a", at), sent("b", at)])
    drop_file(spark, tmp_path, [sent("a", at)], start=10)
    assert run_dedupe(spark, tmp_path) == ["a", "b"]
    drop_file(spark, tmp_path, [sent("mark", at + timedelta(hours=3))], start=20)
    run_dedupe(spark, tmp_path)
    drop_file(spark, tmp_path, [sent("late", at)], start=30)
    run_dedupe(spark, tmp_path)
    assert "late" not in run_dedupe(spark, tmp_path)
    # The landing path keeps the late row, and staging still has one row per id.
    run(spark, tmp_path, config(tmp_path))
    staged = stg_card_transactions(spark.read.parquet(f"{tmp_path}/landing"))
    assert ids(staged) == ["a", "b", "late", "mark"]


def test_lanes_give_the_same_view(spark, tmp_path):
    drop_file(spark, tmp_path, [having(transaction_id="hot")] * 40 + [having(transaction_id="a")])
    drop_file(spark, tmp_path, [having(transaction_id="hot")] * 40 + [having(transaction_id="b")], start=100)
    assert run_dedupe(spark, tmp_path, lanes=4) == ["a", "b", "hot"]


def test_spikes_in_stream_and_batch(spark, tmp_path):
    def letters(minute, n):
        at = datetime(2024, 1, 2, 0, minute)
        return [(b"k", b"junk", "t", 0, minute * 100 + i, at, 0) for i in range(n)]

    for part in (letters(0, 11) + letters(1, 10), letters(30, 1), letters(59, 1)):
        spark.createDataFrame(part, ENVELOPE_SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    batch = dead_letter_spikes(parse_and_validate(spark.read.parquet(f"{tmp_path}/in")).invalid, delay=None)
    assert [(r.window_start.minute, r.messages) for r in batch.collect()] == [(0, 11)]
    stream = dead_letter_spikes(parse_and_validate(stream_envelopes(spark, f"{tmp_path}/in", 1)).invalid)
    query = stream.writeStream.option("checkpointLocation", f"{tmp_path}/c").trigger(**ONCE)
    query.start(f"{tmp_path}/out", format="parquet", outputMode="append").awaitTermination()
    assert [(r.window_start.minute, r.messages) for r in spark.read.parquet(f"{tmp_path}/out").collect()] == [(0, 11)]


def test_lag_from_progress():
    progress = {
        "sources": [
            {"endOffset": {"t": {"0": 10, "1": 5}}, "latestOffset": {"t": {"0": 110, "1": 5, "2": 7}}},
            {"endOffset": '{"u": {"0": 3}}', "latestOffset": '{"u": {"0": 4}}'},
            {"endOffset": None, "latestOffset": None},
        ]
    }
    assert consumer_lag(progress) == 108
    assert consumer_lag({}) == 0
