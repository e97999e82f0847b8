"""Sessions and per-account signals, in batch and on streams, against plain Python."""

import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from txnflow.operators.sequence import account_sequence, inter_txn_gap, velocity
from txnflow.operators.sessions import account_sessions
from txnflow.streaming.accounts import STATE_STORE, account_signals, state_store, stream_sessions

SCHEMA = "transaction_id string, account_id_token string, event_ts timestamp, amount_cents bigint"
START = datetime(2024, 5, 1)
NAMES = ["transaction_id", "account_id_token", "sequence_no", "gap_micros", "txn_count", "cents_total"]


def make(n=400, seed=1):
    """Rows of few accounts, with ties, pauses of exactly an hour or the gap, and missing amounts."""
    rng, at, rows = random.Random(seed), defaultdict(lambda: START), []
    for k in range(n):
        account = rng.choice(["a", "a", "a", "b", "c", None])
        at[account] += timedelta(seconds=rng.choice([0, 1, 60, 1799, 1800, 1801, 3600, 7200]), microseconds=rng.choice([0, 0, 1]))
        rows.append((f"t{k:04d}", account, at[account], rng.choice([None, 5, 10**6, -3, (1 << 62)])))
    return rows


def plain_sessions(rows, gap=timedelta(minutes=30)):
    by = defaultdict(list)
    for r in rows:
        if r[2] is not None:
            by[r[1]].append(r)
    out = []
    for account, own in by.items():
        held = []
        for r in sorted(own, key=lambda r: r[2]):
            if held and r[2] - held[-1][2] > gap:
                out.append((account, held))
                held = []
            held.append(r)
        out.append((account, held))
    total = lambda own: sum(r[3] for r in own if r[3] is not None) if any(r[3] is not None for r in own) else None
    fits = lambda x: x if x is not None and -(1 << 63) <= x < 1 << 63 else None
    return {(a, own[0][2], own[-1][2] + gap, len(own), fits(total(own))) for a, own in out}


def found(df):
    return {(r["account_id_token"], r["session_start"], r["session_end"], r["transactions"], r["cents_total"]) for r in df.collect()}


def zoneless(df):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("session_start", "session_end")})


def test_sessions_equal_plain_ones(spark):
    rows = make() + [("x", "a", None, 1)]
    df = spark.createDataFrame([(i, a, None if t is None else t.isoformat(), c) for i, a, t, c in rows], SCHEMA.replace("event_ts timestamp", "event_ts string"))
    df = df.withColumn("event_ts", F.col("event_ts").cast("timestamp"))
    out = account_sessions(df)
    assert out.count() == len(plain_sessions(rows)) and found(zoneless(out)) == plain_sessions(rows)
    short = timedelta(seconds=30)  # shorter than the slots
    assert found(zoneless(account_sessions(df, "30 seconds"))) == plain_sessions(rows, short)
    assert account_sessions(df.limit(0)).count() == 0


def drop_file(spark, folder, rows):
    df = spark.createDataFrame([(i, a, t.isoformat(), c) for i, a, t, c in rows], SCHEMA.replace("event_ts timestamp", "event_ts string"))
    df.withColumn("event_ts", F.col("event_ts").cast("timestamp")).coalesce(1).write.mode("append").parquet(str(folder))


def run(spark, make_stream, root, name):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    with state_store(spark):
        query = make_stream(stream).writeStream.option("checkpointLocation", f"{root}/{name}-checkpoint").trigger(availableNow=True)
        query.start(f"{root}/{name}", format="parquet", outputMode="append").awaitTermination()
    return spark.read.parquet(f"{root}/{name}")


def beat(days):
    return [(None, None, START + timedelta(days=days), None)]


@pytest.fixture(scope="module")
def disordered(spark, tmp_path_factory):
    """Three files in which times overlap, then a heartbeat."""
    root = tmp_path_factory.mktemp("accounts")
    rows = make()
    random.Random(7).shuffle(rows)
    for k in range(3):
        drop_file(spark, root / "in", rows[k::3])
    drop_file(spark, root / "in", beat(900))
    return root, rows


def batch_signals(spark, root):
    rows = spark.read.schema(SCHEMA).parquet(f"{root}/in").where("transaction_id IS NOT NULL")
    return velocity(inter_txn_gap(account_sequence(rows)))


def test_signals_of_a_stream_equal_those_of_a_batch(spark, disordered):
    root, rows = disordered
    stream = run(spark, lambda s: account_signals(s, "400 days"), root, "signals")
    names = [*NAMES, "event_ts"]
    got, want = ([tuple(r) for r in df.select(*names).collect()] for df in (stream, batch_signals(spark, root)))
    assert len(got) == len(rows) and sorted(got, key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("groups", [1, 3])
def test_accounts_that_share_a_group_keep_apart(spark, tmp_path, groups):
    """Some accounts rest while others of their group go on, and state is kept for each."""
    rows = sorted(make(), key=lambda r: r[2])
    drop_file(spark, tmp_path / "in", [r for r in rows[:200] if r[1] != "b"])
    drop_file(spark, tmp_path / "in", [r for r in rows[200:] if r[1] != "a"])
    drop_file(spark, tmp_path / "in", beat(900))
    got = run(spark, lambda s: account_signals(s, "6 hours", groups=groups), tmp_path, "groups")
    want = batch_signals(spark, tmp_path)
    assert sorted(map(tuple, got.select(*NAMES).collect()), key=repr) == sorted(map(tuple, want.select(*NAMES).collect()), key=repr)


def test_sessions_of_a_stream_equal_those_of_a_batch(spark, disordered):
    root, rows = disordered
    assert found(zoneless(run(spark, lambda s: stream_sessions(s, "400 days"), root, "sessions"))) == plain_sessions(rows)


def test_rows_are_given_step_by_step_as_time_passes(spark, tmp_path):
    """With a short delay every micro-batch gives some rows of an account, and the rest wait for the next."""
    rows = sorted(make(), key=lambda r: r[2])
    for k in range(0, len(rows), 100):
        drop_file(spark, tmp_path / "in", rows[k : k + 100])
    drop_file(spark, tmp_path / "in", beat(900))
    got = run(spark, lambda s: account_signals(s, "6 hours"), tmp_path, "steps")
    want = batch_signals(spark, tmp_path)
    assert sorted(map(tuple, got.select(*NAMES).collect()), key=repr) == sorted(map(tuple, want.select(*NAMES).collect()), key=repr)


def test_state_lives_on_when_a_stream_starts_again(spark, tmp_path):
    first = [("t1", "a", START, 1), ("t2", "a", START + timedelta(minutes=90), 2)]
    drop_file(spark, tmp_path / "in", first)
    assert run(spark, lambda s: account_signals(s, "1 hour"), tmp_path, "out").count() == 1  # t2 may still be overtaken
    drop_file(spark, tmp_path / "in", [("t3", "a", START + timedelta(minutes=80), 4), ("late", "a", START + timedelta(minutes=5), 8)])
    drop_file(spark, tmp_path / "in", beat(2))
    got = {r["transaction_id"]: tuple(r[n] for n in NAMES[2:]) for r in run(spark, lambda s: account_signals(s, "1 hour"), tmp_path, "out").collect()}
    minute = 60_000_000
    assert got == {"t1": (1, None, 1, 1), "t3": (2, 80 * minute, 1, 4), "t2": (3, 10 * minute, 2, 6)}  # 'late' came after the delay


def test_the_state_store_is_set_for_the_stream_only(spark):
    (name, value) = next(iter(STATE_STORE.items()))
    before = spark.conf.get(name, None)
    with state_store(spark):
        assert spark.conf.get(name) == value
    assert spark.conf.get(name, None) == before
