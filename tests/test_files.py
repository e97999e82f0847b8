import json
from collections import Counter
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from catalog.registry import QUERIES
import catalog.ingest  # noqa: F401
from tests.conftest import plan_of
from tests.test_models import landing
from tests.test_parse import envelopes, having, without
from txnflow.operators.parse import parse_and_validate
from txnflow.operators.transform import landing_projection, staged_projection, transform, with_row_number
import txnflow.sinks.landing as landing_module
from txnflow.sinks.landing import (
    ConnectorSink,
    FileSink,
    compact,
    create_landing_table,
    merge_into,
    searched_files,
    write_days,
)
from txnflow.sinks.skipping import ends_of_files, files_that_may_hold, index_files, write_sorted_days
from txnflow.sinks.topic import publish, to_topic_records
from txnflow.schema import PAYLOAD_NAMES
from txnflow.session import cut_lineage, scratch_path, shared_dir
from txnflow.sources import arrays
from txnflow.sources.arrays import read_staged_arrays, split_arrays
from txnflow.sources.files import newest_day, read_landed_days, read_landing, read_staged_json
from txnflow.sources.topic import TopicConfig

STAGED = {
    "transaction_id": "s1",
    "account_id_token": "tok",
    "amount_cents": 5,
    "currency": " eur",
    "merchant_id": "M",
    "merchant_category_code": "7011",
    "event_type": "REFUND",
    "event_timestamp": "2024-01-02T00:00:00",
    "card_last_four": "1",
    "is_international": "true",
    "metadata": {"a": {"b": 1}},
}


def test_staged_arrays(spark, tmp_path):
    objects = [STAGED, STAGED | {"transaction_id": "s2", "amount_cents": "12"}, STAGED | {"transaction_id": "s3", "amount_cents": "x"}]
    (tmp_path / "pretty").mkdir()
    (tmp_path / "lines").mkdir()
    (tmp_path / "pretty" / "a.json").write_text(json.dumps(objects, indent=2))
    (tmp_path / "lines" / "a.json").write_text(json.dumps(objects[:2]) + "\n" + json.dumps(objects[2]))
    pretty = read_staged_json(spark, str(tmp_path / "pretty"), whole_file_arrays=True)
    lines = read_staged_json(spark, str(tmp_path / "lines"))
    for staged in (pretty, lines):
        rows = landing_projection(transform(staged_projection(staged), key=None))
        got = {r.transaction_id: r for r in rows.collect()}
        assert {k: r.amount_cents for k, r in got.items()} == {"s1": 5, "s2": 12, "s3": None}
        first = got["s1"]
        assert (first.account_id, first.account_id_token, first.currency) == ("[TOKENIZED]", "tok", "EUR")
        assert first.is_international is True and first.mcc_category == "HOTEL" and first.metadata == {"a": '{"b":1}'}
        assert first.kafka_offset is None and first.is_high_value is False


def test_row_numbers_are_unique(spark):
    rows = landing(spark, *({"transaction_id": str(i)} for i in range(50))).repartition(4)
    assert with_row_number(rows).select("_file_row_number").distinct().count() == 50


def test_repeat_of_a_batch_replaces_it(spark, tmp_path):
    sink = FileSink(str(tmp_path / "t"))
    first = landing(spark, {"transaction_id": "a"}, {"transaction_id": "b", "event_ts": datetime(2024, 1, 5)})
    sink.write_batch(first, "r1", 0)
    sink.write_batch(landing(spark, {"transaction_id": "c"}), "r1", 1)
    sink.write_batch(first, "r1", 0)
    # A new checkpoint counts from zero again; its run id keeps the older batch.
    sink.write_batch(landing(spark, {"transaction_id": "d"}), "r2", 0)
    table = read_landing(spark, sink.path)
    assert sorted(r.transaction_id for r in table.collect()) == ["a", "b", "c", "d"]
    day = table.where(F.col("event_date") == F.lit("2024-01-05").cast("date"))
    assert "PartitionFilters: [isnotnull(event_date" in plan_of(day) and day.count() == 1


def test_connector_takes_any_format(spark, tmp_path):
    target = str(tmp_path / "out")
    sink = ConnectorSink("json", str(tmp_path / "ledger"), {"path": target})
    for batch in (7, 7, 8, 7):
        sink.write_batch(spark.range(3).toDF("x"), "r", batch)
    rows = [(r.run_id, r.batch_id) for r in spark.read.json(target).collect()]
    assert sorted(rows) == [("r", 7)] * 3 + [("r", 8)] * 3, "a batch tried again is not written again"


def test_connector_failure_propagates(spark, tmp_path):
    with pytest.raises(Exception, match="no_such_format"):
        ConnectorSink("no_such_format", str(tmp_path / "ledger")).write_batch(spark.range(1).toDF("x"), "r", 0)
    assert not (tmp_path / "ledger").exists()


def test_compaction_keeps_rows_and_other_days(spark, tmp_path):
    sink, table = FileSink(str(tmp_path / "l")), str(tmp_path / "t")
    write_days(landing(spark, {"transaction_id": "kept", "event_ts": datetime(2024, 1, 1)}), table)
    for i in range(4):
        sink.write_batch(landing(spark, {"transaction_id": f"b{i}"}), "r", i)
    sink.write_batch(landing(spark, {"transaction_id": "today", "event_ts": datetime(2024, 1, 3)}), "r", 9)
    sink.write_batch(landing(spark, {"transaction_id": "undated", "event_ts": None}), "r", 10)
    compact(spark, sink.path, table, "2024-01-01", "2024-01-02", str(tmp_path / "s1"))
    rows = read_landing(spark, table)
    first = ["b0", "b1", "b2", "b3", "kept"]
    assert sorted(r.transaction_id for r in rows.collect()) == first
    assert rows.where("event_date = date'2024-01-02'").select(F.input_file_name()).distinct().count() == 1
    assert sorted(p.name for p in (tmp_path / "l").iterdir() if p.name.startswith("event_date")) == [
        "event_date=2024-01-03", "event_date=__HIVE_DEFAULT_PARTITION__",
    ]
    both = lambda: sorted(r.transaction_id for r in read_landed_days(spark, table, sink.path).collect())
    assert both() == [*first, "today", "undated"]
    # A late row of a closed day, and a batch written again with another content.
    sink.write_batch(landing(spark, {"transaction_id": "late"}), "r", 11)
    sink.write_batch(landing(spark, {"transaction_id": "b1 again"}), "r", 1)
    late = sorted(["b0", "b1 again", "b2", "b3", "kept", "late", "today", "undated"])
    assert both() == late
    compact(spark, sink.path, table, "2024-01-01", "2024-01-02", str(tmp_path / "s2"))
    assert both() == late
    compact(spark, sink.path, table, "2024-01-01", "2024-01-02", str(tmp_path / "s3"))
    assert both() == late
    assert str(newest_day(spark, table)) == "2024-01-02" and newest_day(spark, str(tmp_path / "none")) is None


def test_merge_rewrites_touched_days_only(spark, tmp_path):
    table = str(tmp_path / "t")
    write_days(
        landing(
            spark,
            {"transaction_id": "same", "event_ts": datetime(2024, 1, 1)},
            {"transaction_id": "moves", "event_ts": datetime(2024, 1, 3)},
            {"transaction_id": "fixed", "event_ts": datetime(2024, 1, 2)},
            {"transaction_id": "beside", "event_ts": datetime(2024, 1, 2)},
        ),
        table,
    )
    untouched = sorted(f.name for f in (tmp_path / "t" / "event_date=2024-01-01").iterdir())
    later = datetime(2024, 2, 1)
    updates = landing(
        spark,
        {"transaction_id": "fixed", "event_ts": datetime(2024, 1, 2), "amount_cents": 7, "ingested_at": later},
        {"transaction_id": "moves", "event_ts": datetime(2024, 1, 4), "ingested_at": later},
        {"transaction_id": "new", "event_ts": datetime(2024, 1, 9)},
    )
    for n in range(2):  # a second run changes nothing
        merge_into(spark, table, updates, str(tmp_path / f"staging{n}"))
        got = {(r.transaction_id, str(r.event_date), r.amount_cents) for r in read_landing(spark, table).collect()}
        assert got == {
            ("same", "2024-01-01", 100), ("moves", "2024-01-04", 100), ("fixed", "2024-01-02", 7),
            ("beside", "2024-01-02", 100), ("new", "2024-01-09", 100),
        }
    assert sorted(f.name for f in (tmp_path / "t" / "event_date=2024-01-01").iterdir()) == untouched


def test_merge_of_rows_without_a_date(spark, tmp_path):
    table, later = str(tmp_path / "t"), datetime(2024, 2, 1)
    old = [("u1", None), ("u2", None), ("dated", datetime(2024, 1, 2)), ("loses", datetime(2024, 1, 3))]
    write_days(landing(spark, *({"transaction_id": i, "event_ts": t} for i, t in old)), table)
    new = [("u2", datetime(2024, 1, 5)), ("u3", None), ("loses", None)]
    updates = landing(spark, *({"transaction_id": i, "event_ts": t, "ingested_at": later} for i, t in new))
    for n in range(2):
        merge_into(spark, table, updates, str(tmp_path / f"staging{n}"))
        got = {(r.transaction_id, r.event_date and str(r.event_date)) for r in read_landing(spark, table).collect()}
        assert got == {("u1", None), ("u2", "2024-01-05"), ("u3", None), ("dated", "2024-01-02"), ("loses", None)}
        assert read_landing(spark, table).count() == 5
    assert not (tmp_path / "t" / "event_date=2024-01-03").exists()


def test_added_field_is_null_in_older_files(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = landing(spark, {"transaction_id": "old"})
    rows.write.mode("append").parquet(path)
    landing(spark, {"transaction_id": "new"}).withColumn("channel", F.lit("web")).write.mode("append").parquet(path)
    got = {r.transaction_id: r.channel for r in read_landing(spark, path, merge_schema=True).collect()}
    assert got == {"old": None, "new": "web"}


def test_topic_options():
    assert TopicConfig("b:9092", "transactions").options() == {
        "kafka.bootstrap.servers": "b:9092",
        "subscribe": "transactions",
        "startingOffsets": "latest",
        "maxOffsetsPerTrigger": "50000",
        "failOnDataLoss": "false",
    }
    more = TopicConfig("b", "t", "earliest", 10, "g", True, 64, {"kafka.security.protocol": "SSL"}).options()
    assert more["kafka.group.id"] == "g" and more["minPartitions"] == "64" and more["startingOffsets"] == "earliest"
    assert more["failOnDataLoss"] == "true" and more["kafka.security.protocol"] == "SSL"


def test_topic_records(spark):
    frame = spark.createDataFrame([("k", 1)], "kafka_key string, n int")
    row = to_topic_records(frame, "kafka_key").first()
    assert bytes(row.key) == b"k" and json.loads(row.value) == {"kafka_key": "k", "n": 1}


def test_publish_counts_produced_and_refused(spark, tmp_path):
    raw = envelopes(spark, [having(transaction_id="a"), having(transaction_id="b"), without("currency")])
    events = parse_and_validate(raw).valid.select(*PAYLOAD_NAMES)
    counts = publish(events, {"path": str(tmp_path / "topic")}, str(tmp_path / "refused"), fmt="parquet")
    assert counts == (2, 1)
    messages = spark.read.parquet(str(tmp_path / "topic")).collect()
    assert sorted(json.loads(bytes(m.value))["transaction_id"] for m in messages) == ["a", "b"]
    assert spark.read.parquet(str(tmp_path / "refused")).first().currency is None


def test_declared_table_shows_landed_batches(spark, tmp_path):
    path = str(tmp_path / "t")
    create_landing_table(spark, "landed_here", path)
    create_landing_table(spark, "landed_here", path)
    sink = FileSink(path, table="landed_here")
    sink.write_batch(with_row_number(landing(spark, {"transaction_id": "a"})), "r", 3)
    sink.write_batch(with_row_number(landing(spark, {"transaction_id": "b", "event_ts": None})), "r", 4)
    rows = spark.table("landed_here").orderBy("batch_id").collect()
    assert [(r.transaction_id, r.run_id, r.batch_id) for r in rows] == [("a", "r", 3), ("b", "r", 4)]
    assert all(r._file_row_number is not None for r in rows)
    compact(spark, path, str(tmp_path / "days"), "2024-01-01", "2024-01-31", str(tmp_path / "s"), table="landed_here")
    assert [r.transaction_id for r in spark.table("landed_here").collect()] == ["b"]
    spark.sql("DROP TABLE landed_here")


def test_compaction_drops_many_partitions_with_each_statement(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    create_landing_table(spark, "landed_often", path)
    sink = FileSink(path, table="landed_often")
    for k in range(5):
        sink.write_batch(with_row_number(landing(spark, {"transaction_id": f"t{k}"})), f"r{k % 2}", k)
    monkeypatch.setattr(landing_module, "PARTITIONS_A_DROP", 2)
    compact(spark, path, str(tmp_path / "days"), "2024-01-01", "2024-01-31", str(tmp_path / "s"), table="landed_often")
    assert spark.table("landed_often").count() == 0
    assert spark.sql("SHOW PARTITIONS landed_often").count() == 0
    assert spark.read.parquet(str(tmp_path / "days")).count() == 5
    assert not [p for p in (tmp_path / "t").iterdir() if p.name.startswith("event_date")]
    spark.sql("DROP TABLE landed_often")


def test_a_delete_that_fails_is_not_passed_over():
    def call(name):
        raise OSError(name)

    with pytest.raises(OSError, match="folder"):
        landing_module._at_once(call, ["folder"])


def test_scratch_lies_in_the_shared_folder(spark):
    folder = shared_dir(spark)
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert named is None or folder == named
    assert scratch_path(spark, "a").startswith(folder.rstrip("/"))
    assert scratch_path(spark, "a") != scratch_path(spark, "a")
    assert "FileScan parquet" in plan_of(cut_lineage(spark.range(3)))


def test_no_local_scratch_on_a_cluster(monkeypatch):
    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)  # noqa: N815
        getConf = staticmethod(lambda: {})  # noqa: N815

    class Session:
        sparkContext = Context()  # noqa: N815
        conf = {}  # noqa: RUF012

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Session())


def test_the_library_uses_no_rdd():
    from pathlib import Path

    for folder in ("txnflow", "catalog"):
        for path in Path(folder).rglob("*.py"):
            assert ".rdd" not in path.read_text(), path


def indexed_table(spark, path, days=6, rows=40):
    """Days of ids that rise with time, in several files each."""
    at = datetime(2024, 1, 1)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        own = [{"transaction_id": f"{d:02d}-{k:03d}", "event_ts": at + timedelta(days=d)} for d in range(days) for k in range(rows)]
        write_sorted_days(landing(spark, *own, {"transaction_id": "00-undated", "event_ts": None}), path)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_a_merge_searches_only_files_that_may_hold_an_id(spark, tmp_path):
    table, later = str(tmp_path / "t"), datetime(2024, 2, 1)
    indexed_table(spark, table)
    every = spark.read.parquet(table).inputFiles()
    assert len(every) >= 8

    def named(*ids):
        return spark.createDataFrame([(i,) for i in ids], "transaction_id string")

    for ids in (["02-007"], ["00-000", "05-039"], ["03-010", "03-011", "zz"], ["99"], [None, "00-undated"]):
        found = files_that_may_hold(spark, table, named(*ids))
        holding = {r[0] for r in spark.read.parquet(table).where(F.col("transaction_id").isin([i for i in ids if i])).select("_metadata.file_path").distinct().collect()}
        assert {p.removeprefix("file:") for p in holding} <= {p.removeprefix("file://") for p in found} and len(found) <= 2 * len(ids), ids
    assert files_that_may_hold(spark, table, named("99")) == []
    assert searched_files(spark, table, named("99")) is None
    # Old rows are found whatever their day, undated ones too; a new file that the index lacks is searched.
    changes = [("02-007", datetime(2024, 1, 6), 5), ("00-undated", datetime(2024, 1, 2), 6), ("new", None, 7)]
    updates = landing(spark, *({"transaction_id": i, "event_ts": t, "amount_cents": c, "ingested_at": later} for i, t, c in changes))
    for n in range(2):
        merge_into(spark, table, updates, str(tmp_path / f"staging{n}"))
        got = {r.transaction_id: (r.event_date and str(r.event_date), r.amount_cents) for r in read_landing(spark, table).collect()}
        assert len(got) == read_landing(spark, table).count() == 242
        assert (got["02-007"], got["00-undated"], got["new"]) == (("2024-01-06", 5), ("2024-01-02", 6), (None, 7))
    landing(spark, {"transaction_id": "02-500", "event_ts": datetime(2024, 1, 9)}).write.mode("append").partitionBy("event_date").parquet(table)
    assert any("event_date=2024-01-09" in path for path in files_that_may_hold(spark, table, named("02-500")))


def test_a_table_without_index_is_searched_whole(spark, tmp_path):
    table = str(tmp_path / "t")
    write_days(landing(spark, {"transaction_id": "a"}, {"transaction_id": "b", "event_ts": datetime(2024, 3, 1)}), table)
    ids = spark.createDataFrame([("none",)], "transaction_id string")
    assert len(files_that_may_hold(spark, table, ids)) == len(spark.read.parquet(table).inputFiles()) == 2
    index_files(spark, table)
    assert files_that_may_hold(spark, table, ids) == []


def test_names_of_files_are_cut_out_once_for_each_file(spark, tmp_path):
    table = str(tmp_path / "t")
    indexed_table(spark, table)
    rows = spark.read.parquet(table)
    ends = {r.file: (r.first_id, r.last_id, r.rows) for r in ends_of_files(rows).collect()}
    assert set(ends) == {"/".join(path.rsplit("/", 2)[-2:]) for path in rows.inputFiles()}
    assert sum(n for *_, n in ends.values()) == 241 and ("00-undated",) * 2 + (1,) in ends.values()
    rows_read = plan_of(ends_of_files(rows)).lower().split("exchange", 1)[1]  # what is done to each row
    assert "file_path" in rows_read and "substring" not in rows_read and "regexp" not in rows_read


ODD_STRINGS = ["}", "{", "},{", '"', "\\", '\\"}', "[]", "a\n}", "", "}}]", "é}", "\\\\", ',"x":{']


def array_objects(n=300):
    return [{"transaction_id": f"t{k}", "merchant_id": ODD_STRINGS[k % len(ODD_STRINGS)], "metadata": {"k": {"n": k, "s": ODD_STRINGS[-k % 5]}}, "amount_cents": k} for k in range(n)]


@pytest.mark.parametrize("layout", [{"indent": 2}, {"indent": None}, {"separators": (",", ":")}])
def test_one_array_is_read_by_many_tasks(spark, tmp_path, layout):
    objects = array_objects()
    for name, own in (("a", objects), ("b", objects[:1]), ("c", [])):
        (tmp_path / f"{name}.json").write_text(json.dumps(own, ensure_ascii=False, **layout))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        assert spark.read.option("lineSep", "}").text(str(tmp_path)).select(F.spark_partition_id()).distinct().count() > 4
        for slices in (2, 7):
            records = sorted((r.source_file[-6:], r.place, r.record) for r in split_arrays(spark, str(tmp_path), slices).collect())
            assert [json.loads(r) for f, _, r in records if f == "a.json"] == objects
            assert [json.loads(r) for f, _, r in records if f != "a.json"] == objects[:1]
        rows = read_staged_arrays(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(rows) == 301 and all(r._corrupt_record is None for r in rows)
    assert sorted(r.merchant_id for r in rows) == sorted([o["merchant_id"] for o in objects] + ["}"])


def test_cut_arrays_lose_nothing(spark, tmp_path, monkeypatch):
    text = json.dumps(array_objects(20))
    cut = text.index('"transaction_id": "t7"') + 20  # inside the name of the eighth
    (tmp_path / "cut.json").write_text(text[:cut])
    for most in (10_000, 0):
        monkeypatch.setattr(arrays, "MOST_PIECES", most)
        rows = read_staged_arrays(spark, str(tmp_path)).collect()
        if most:
            assert sorted(r.transaction_id for r in rows if r._corrupt_record is None) == [f"t{k}" for k in range(7)]
            assert [r._corrupt_record for r in rows if r._corrupt_record is not None] == ['{"transaction_id": "t']
        else:  # every piece by itself
            kept = "".join(r._corrupt_record or "" for r in rows)
            assert all(f"t{k}" in kept for k in range(7))
    (tmp_path / "cut.json").write_text(" ")
    assert read_staged_arrays(spark, str(tmp_path)).count() == 0


def test_arrays_are_written_object_by_object(spark, tmp_path, monkeypatch):
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    ids = [*range(200), *range(0, 200, 9), -3, None, None]
    rows = [(i, datetime(2024, 1, 2), 7, "purchase", 1.5, '{"k": 50}') for i in ids]
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    paths, longest, write = [], [], DataFrameWriter.text

    def written(self, path, **options):
        paths.append(path)
        longest.append(self._df.agg(F.max(F.length("value"))).first()[0])
        return write(self, path, **options)

    monkeypatch.setattr(DataFrameWriter, "text", written)
    got = QUERIES["bulk_array_load"](spark, str(tmp_path)).collect()
    assert Counter(r.transaction_id for r in got) == Counter(i if i is None else str(i) for i in ids)
    # No row holds more than one object: what a task has in memory does not grow with a group.
    assert longest[0] < 600
    arrays = [json.loads(f.read_text()) for f in Path(paths[0].removeprefix("file:")).rglob("part-*") if f.stat().st_size]
    assert len(arrays) == 18 and sum(map(len, arrays)) == len(ids)  # 16 groups, one below zero, one without an id
    assert all(len({int(x["transaction_id"]) % 16 for x in a if "transaction_id" in x}) <= 1 for a in arrays)
