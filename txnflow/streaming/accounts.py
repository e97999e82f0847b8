"""Per-account signals on a stream: sequence, gap, trailing-hour velocity, sessions.

State is kept per account, in groups of accounts, and event-time timers say when rows are complete. Rows
may come in any order within the watermark's delay; a row's values are given
once the watermark has passed its time, in the order of time, and equal those of
the batch forms in `txnflow.operators`. Rows that come later than the delay are
left out here; the landing table has them.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from txnflow.operators.sequence import HOUR_MICROS
from txnflow.operators.sessions import GAP

#: Keyed state with timers needs this store; it keeps state on disk and in the checkpoint.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
}


@contextmanager
def state_store(spark: SparkSession) -> Iterator[None]:
    """The session with `STATE_STORE` set for the streams that are started inside."""
    before = {name: spark.conf.get(name, None) for name in STATE_STORE}
    for name, value in STATE_STORE.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


SIGNALS = """account_id_token string, transaction_id string, event_micros bigint, sequence_no bigint, gap_micros bigint,
             txn_count bigint, cents_total bigint"""

#: Accounts are dealt to this many groups that share a timer. A state call costs far more than a row, and each group
#: makes a dozen of them in a batch; the rows of one group are in memory at a time.
GROUPS = 2048

#: An account: rows done with, the last one's time, rows of the last span, and rows that may still be overtaken.
#: Entries without `n` hold rows that came since.
_ACCOUNT = """account string, n bigint, last bigint, recent_t array<bigint>, recent_cents array<bigint>,
              t array<bigint>, id array<string>, cents array<bigint>"""


def _signals(span_micros: int) -> StatefulProcessor:
    """The processor, as a class of its own call: so it travels to executors by value."""
    most, state_schema = (1 << 63) - 1, _ACCOUNT
    signal = Row(*(f.split()[0] for f in SIGNALS.split(",")))

    class AccountSignals(StatefulProcessor):
        def init(self, handle):
            self.handle = handle
            self.accounts = handle.getListState("accounts", state_schema)

        def handleInputRows(self, key, rows, timerValues):
            new = {}
            for r in rows:
                if r["transaction_id"] is not None:
                    times, names, cents = new.setdefault(r["account_id_token"], ([], [], []))
                    times.append(r["event_micros"])
                    names.append(r["transaction_id"])
                    cents.append(r["amount_cents"])
            if new:
                self.accounts.appendList([(account, None, None, [], [], *own) for account, own in new.items()])
                self._wake(min(min(times) for times, _, _ in new.values()))
            return iter([])

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            passed = timerValues.getCurrentWatermarkInMs() * 1000
            done, waiting = {}, {}
            for account, n, last, recent_t, recent_cents, *own in self.accounts.get():
                if n is not None:
                    done[account] = (n, last, list(zip(recent_t, recent_cents)))
                waiting.setdefault(account, []).extend(zip(*own))
            kept, first = [], None
            for account, rows in waiting.items():
                rows.sort(key=lambda r: r[:2])
                ready, rest = [r for r in rows if r[0] <= passed], [r for r in rows if r[0] > passed]
                n, last, recent = done.get(account, (0, None, []))
                yield from self._ready(account, n, last, recent, ready)
                if ready:
                    n, last = n + len(ready), ready[-1][0]
                    recent = recent + [(t, cents) for t, _, cents in ready]
                recent = [r for r in recent if r[0] >= passed - span_micros]
                kept.append((account, n, last, *_columns(recent, 2), *_columns(rest, 3)))
                if rest:
                    first = rest[0][0] if first is None else min(first, rest[0][0])
            self.accounts.put(kept)
            if first is not None:
                self._wake(first, expiredTimerInfo.getExpiryTimeInMs())

        def _ready(self, account, n, last, recent, ready):
            """The signals of rows that the watermark has passed, sorted, after `n` earlier ones."""
            held = recent + [(t, cents) for t, _, cents in ready]  # older ones first: they were ready before
            low = high = count = priced = cents_in = 0
            for t, name, _ in ready:
                while high < len(held) and held[high][0] <= t:  # all rows of one time count for each of them
                    count, priced = count + 1, priced + (held[high][1] is not None)
                    cents_in += held[high][1] or 0
                    high += 1
                while held[low][0] < t - span_micros:
                    count, priced = count - 1, priced - (held[low][1] is not None)
                    cents_in -= held[low][1] or 0
                    low += 1
                n += 1
                fits = priced > 0 and -most - 1 <= cents_in <= most
                gap = None if last is None else t - last
                yield signal(account, name, t, n, gap, count, cents_in if fits else None)
                last = t

        def _wake(self, micros: int, gone: int | None = None):
            """One timer for the first row that waits; `gone` is one that is over once this call ends."""
            at = -(-micros // 1000)
            timers = [t for t in self.handle.listTimers() if t != gone]
            if not timers or at < min(timers):
                for timer in timers:
                    self.handle.deleteTimer(timer)
                self.handle.registerTimer(at)

        def close(self):
            pass

    def _columns(rows, width):
        return [list(c) for c in zip(*rows)] if rows else [[] for _ in range(width)]

    return AccountSignals()


def account_signals(
    rows: DataFrame,
    delay: str = "10 minutes",
    account: str = "account_id_token",
    time: str = "event_ts",
    tie: str = "transaction_id",
    amount: str = "amount_cents",
    span_micros: int = HOUR_MICROS,
    groups: int = GROUPS,
) -> DataFrame:
    """Each transaction with `sequence_no`, `gap_micros`, `txn_count` and `cents_total`, as `account_sequence`,
    `inter_txn_gap` and `velocity` give them for all rows that came in time.

    A row is given when the watermark, which is `delay` behind the latest time
    seen, has passed it. A row without an id is a heartbeat: it only moves the
    time, so that a quiet stream gives its last rows. Rows without a time are
    left out. An account's state is its rows of the last `delay` and span.
    Accounts are kept in `groups` groups by a hash, and one task has a group at a
    time: of many more accounts, give more groups. A stream that has a checkpoint
    must keep their number. Start the stream inside `state_store`.
    """
    timed = rows.where(F.col(time).isNotNull()).withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay)
    keyed = timed.select(
        F.pmod(F.xxhash64(account), F.lit(groups)).alias("account_group"),
        F.col(account).alias("account_id_token"),
        F.col(tie).alias("transaction_id"),
        F.col(amount).alias("amount_cents"),
        F.unix_micros(F.col(time).cast("timestamp")).alias("event_micros"),
        F.col(time).alias("event_ts"),
    )
    found = keyed.groupBy("account_group").transformWithState(_signals(span_micros), SIGNALS, "Append", "EventTime")
    return found.withColumn("event_ts", F.timestamp_micros("event_micros")).drop("event_micros")


def stream_sessions(
    rows: DataFrame, delay: str = "10 minutes", gap: str = GAP, account: str = "account_id_token", time: str = "event_ts", amount: str = "amount_cents"
) -> DataFrame:
    """The sessions of `account_sessions` on a stream, each given when the watermark has passed its end.

    Sessions grow and merge across micro-batches. Rows without an id are
    heartbeats, as in `account_signals`.
    """
    timed = rows.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay)
    sessions = timed.groupBy(account, F.session_window(time, gap).alias("session")).agg(
        F.count("transaction_id").alias("transactions"), F.sum(F.col(amount).cast("decimal(20,0)")).alias("cents")
    )
    return sessions.where("transactions > 0").select(
        account,
        F.col("session.start").alias("session_start"),
        F.col("session.end").alias("session_end"),
        "transactions",
        F.col("cents").try_cast("bigint").alias("cents_total"),
    )
