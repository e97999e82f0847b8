"""The sliced forms against plain Python, on data where one account holds most rows."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of
from txnflow.operators import hotkeys
from txnflow.operators.hotkeys import SLICE, count_hot_keys, find_hot_keys, read_hot_keys, slice_by_range
from txnflow.operators.sequence import account_order, account_sequence, distinct_in_span, inter_txn_gap, velocity
from txnflow.plans.buckets import bucketed_table

START = datetime(2024, 1, 1)
SCHEMA = "transaction_id string, account_id_token string, event_ts timestamp_ntz, amount_cents bigint"


def rows(shape):
    rng = random.Random(7)
    out = []
    for i in range(600):
        account = "hot" if i % 3 else f"cold{i % 20}"
        if shape == "spread":
            at = START + timedelta(seconds=rng.randrange(0, 40 * 3600))
        elif shape == "instants":  # many rows share a few instants exactly one hour apart
            at = START + timedelta(hours=rng.randrange(0, 4))
        else:  # one instant holds nearly everything
            at = START if i % 10 else START + timedelta(minutes=rng.randrange(0, 200))
        out.append((f"t{i:04d}", account, at, None if i % 17 == 0 else rng.randrange(-500, 5000)))
    return out


def by_account(data):
    groups = {}
    for r in sorted(data, key=lambda r: (r[2], r[0])):
        groups.setdefault(r[1], []).append(r)
    return groups


@pytest.mark.parametrize("shape", ["spread", "instants", "one"])
@pytest.mark.parametrize("limit", [40, 10_000])
def test_sequence(spark, shape, limit):
    data = rows(shape)
    got = account_sequence(spark.createDataFrame(data, SCHEMA), rows_per_task=limit).collect()
    want = {r[0]: i for group in by_account(data).values() for i, r in enumerate(group, 1)}
    assert {r.transaction_id: r.sequence_no for r in got} == want and len(got) == len(data)


@pytest.mark.parametrize("shape", ["spread", "instants", "one"])
@pytest.mark.parametrize("limit", [40, 10_000])
def test_gap(spark, shape, limit):
    data = rows(shape)
    got = inter_txn_gap(spark.createDataFrame(data, SCHEMA), rows_per_task=limit).collect()
    want = {}
    for group in by_account(data).values():
        for before, r in zip([None, *group], group):
            want[r[0]] = None if before is None else (r[2] - before[2]) // timedelta(microseconds=1)
    assert {r.transaction_id: r.gap_micros for r in got} == want and len(got) == len(data)


@pytest.mark.parametrize("shape", ["spread", "instants", "one"])
@pytest.mark.parametrize("limit", [40, 10_000])
def test_velocity(spark, shape, limit):
    data = rows(shape)
    got = velocity(spark.createDataFrame(data, SCHEMA), rows_per_task=limit).collect()
    want = {}
    for group in by_account(data).values():
        for r in group:
            span = [o[3] for o in group if r[2] - timedelta(hours=1) <= o[2] <= r[2]]
            priced = [c for c in span if c is not None]
            want[r[0]] = (len(span), sum(priced) if priced else None)
    assert {r.transaction_id: (r.txn_count, r.cents_total) for r in got} == want and len(got) == len(data)


def test_velocity_without_time_or_account_is_the_same_on_all_paths(spark):
    data = [
        (f"t{i:03d}", None if i % 4 == 0 else "hot" if i % 4 == 1 else "cold", None if i % 3 == 0 else START + timedelta(minutes=i), i)
        for i in range(240)
    ]
    frame = spark.createDataFrame(data, SCHEMA)
    plain, sliced = (
        {r.transaction_id: (r.txn_count, r.cents_total) for r in velocity(frame, rows_per_task=limit).collect()}
        for limit in (10_000, 30)
    )
    assert plain == sliced and len(plain) == 240
    assert plain["t001"][0] == 1 and plain["t000"][0] == 20, "rows without a time form one group per account"


@pytest.mark.parametrize("limit", [1, 10_000])
def test_velocity_of_extreme_amounts(spark, limit):
    big = 6 * 10**18
    data = [(f"t{i}", "a", START + timedelta(hours=5 * i), big) for i in range(4)]
    data += [("u0", "b", START, big), ("u1", "b", START + timedelta(minutes=1), big), ("u2", "b", START + timedelta(hours=9), 1)]
    got = {r.transaction_id: (r.txn_count, r.cents_total) for r in velocity(spark.createDataFrame(data, SCHEMA), rows_per_task=limit).collect()}
    assert got == {**{f"t{i}": (1, big) for i in range(4)}, "u0": (1, big), "u1": (2, None), "u2": (1, 1)}


def test_velocity_reads_its_rows_in_one_shuffle(spark):
    frame = spark.createDataFrame(rows("one"), SCHEMA)
    assert plan_of(velocity(frame)).count("Exchange hashpartitioning") == 1


def test_many_hot_keys_are_all_found(spark):
    frame = spark.range(36_500).selectExpr("if(id < 36000, concat('k', id % 12000), concat('c', id)) account_id_token", "id")
    hot = find_hot_keys(frame, "account_id_token", 2)
    assert hot.keys.count() == 12_000 and hot.rows == 36_000
    assert hot.hot(frame).count() == 36_000 and hot.cold(frame).count() == 500


def test_ordered_accounts_spread_over_tasks(spark):
    data = [(f"t{i:04d}", "hot", START + timedelta(seconds=i * 7 % 4001), i) for i in range(4000)]
    parts = account_order(spark.createDataFrame(data, SCHEMA), 4).withColumn("p", F.spark_partition_id()).collect()
    assert len({r.p for r in parts}) == 4
    order = [(r.p, r.event_ts, r.transaction_id) for r in parts]
    assert order == sorted(order) and [o[1:] for o in order] == sorted(o[1:] for o in order)


def test_null_account_can_be_hot(spark):
    data = [(f"t{i:03d}", None if i % 2 else "a", START + timedelta(minutes=i), 1) for i in range(200)]
    got = account_sequence(spark.createDataFrame(data, SCHEMA), rows_per_task=30).collect()
    assert sorted(r.sequence_no for r in got if r.account_id_token is None) == list(range(1, 101))


def test_hot_rows_spread_over_slices(spark):
    df = spark.createDataFrame(rows("one"), SCHEMA)
    hot = find_hot_keys(df, "account_id_token", 100)
    assert [r.account_id_token for r in hot.keys.collect()] == ["hot"] and hot.rows == 400
    sliced = slice_by_range(hot.hot(df), "account_id_token", ["event_ts", "transaction_id"], 4)
    sizes = [r["count"] for r in sliced.groupBy(SLICE).count().collect()]
    assert len(sizes) == 4 and max(sizes) < 200 and sum(sizes) == 400
    assert find_hot_keys(df, "account_id_token", 1000) is None


@pytest.mark.parametrize("shape", ["spread", "instants", "one"])
@pytest.mark.parametrize("limit", [40, 10_000])
def test_distinct_in_span(spark, shape, limit):
    data = [(*r, None if k % 19 == 0 else f"m{k * k % 7}") for k, r in enumerate(rows(shape))] + [("t", "hot", None, 1, "m1"), ("u", None, START, 1, "m1")]
    df = spark.createDataFrame(data, SCHEMA + ", merchant_id string")
    got = {r.transaction_id: r.distinct_merchants for r in distinct_in_span(df, rows_per_task=limit).collect()}
    assert len(got) == len(data)
    for name, account, at, _, _ in data:
        near = {m for _, a, t, _, m in data if a == account and t is not None and at is not None and timedelta(0) <= at - t <= timedelta(hours=1) and m}
        assert got[name] == (None if at is None else len(near)), name


def test_distinct_in_span_needs_one_shuffle(spark):
    df = spark.createDataFrame([("t1", "a", START, 1, "m")], SCHEMA + ", merchant_id string")
    assert plan_of(distinct_in_span(df)).count("Exchange") == 1


def test_bucketed_tables_need_no_exchange(spark):
    data = rows("spread")
    df = spark.createDataFrame(data, SCHEMA)
    accounts = df.select("account_id_token").distinct().withColumn("segment", F.upper("account_id_token"))
    want = sorted(map(tuple, velocity(account_sequence(df)).join(accounts, "account_id_token", "left").select("transaction_id", "sequence_no", "txn_count", "cents_total", "segment").collect()))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with bucketed_table(df, 4) as stored, bucketed_table(accounts, 4) as segments:
            found = velocity(account_sequence(stored)).join(segments, "account_id_token", "left")
            assert "Exchange" not in plan_of(found) and "SortMergeJoin" in plan_of(found)
            got = found.select("transaction_id", "sequence_no", "txn_count", "cents_total", "segment").collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sorted(map(tuple, got)) == want


def test_known_hot_keys_take_the_place_of_a_count(spark, tmp_path, monkeypatch):
    df = spark.createDataFrame([(*r, f"m{i % 7}") for i, r in enumerate(rows("spread"))], f"{SCHEMA}, merchant_id string")
    signals = (account_sequence, inter_txn_gap, velocity, distinct_in_span)
    want = [signal(df, rows_per_task=40).collect() for signal in signals]
    hot = count_hot_keys(df, "account_id_token", 40)
    hot.write(str(tmp_path / "hot"))
    stored = read_hot_keys(spark, str(tmp_path / "hot"), "account_id_token")
    assert hot.rows == stored.rows == 400
    none = count_hot_keys(df, "account_id_token", 10_000)
    assert none.rows == 0 and find_hot_keys(df, "account_id_token", 40, none) is None

    counts = []
    counted = hotkeys.count_hot_keys
    monkeypatch.setattr(hotkeys, "count_hot_keys", lambda df, key, n: counts.append(key) or counted(df, key, n))
    for known in (hot, stored, none):
        got = [signal(df, rows_per_task=40, known=known).collect() for signal in signals]
        assert [sorted(map(repr, g)) for g in got] == [sorted(map(repr, w)) for w in want]
    # Only pairs of account and merchant, which are no accounts, are counted.
    assert set(counts) <= {"_pair"}
    with pytest.raises(ValueError, match="do not tell"):
        velocity(df, account="merchant_id", known=hot)
