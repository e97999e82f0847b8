"""Order-dependent values per account: sequence number, gap, trailing-hour velocity and distinct merchants.

Each function runs a plain window per account and, where an account holds too
many rows for one task, the sliced form of `txnflow.operators.hotkeys` for that
account. `rows_per_task` sets the limit; both forms give the same values. Accounts
are counted in a job of its own unless `known` tells those with too many rows, as
`count_hot_keys` found them for these rows or for those of an earlier run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from txnflow.operators.hotkeys import (
    ROWS_PER_TASK,
    HotKeys,
    attach_carry,
    carry,
    find_hot_keys,
    in_slice,
    slice_by_range,
    slices_for,
)

HOUR_MICROS = 3_600_000_000
# Holds the sum of any number of bigints that a table can have.
WIDE = "decimal(38,0)"


def _zero() -> Column:
    return F.lit(0).cast("bigint")


def account_order(df: DataFrame, partitions: int, account: str = "account_id_token") -> DataFrame:
    """Each account's rows in order of time, as a keyed topic gives them.

    Rows are dealt by range, so an account that is too large for one task goes
    on, in order, in the next.
    """
    order = (account, "event_ts", "transaction_id")
    return df.repartitionByRange(partitions, *order).sortWithinPartitions(*order)


def account_sequence(
    df: DataFrame,
    account: str = "account_id_token",
    time: str = "event_ts",
    tie: str = "transaction_id",
    rows_per_task: int = ROWS_PER_TASK,
    known: HotKeys | None = None,
) -> DataFrame:
    """Add `sequence_no`: 1, 2, ... per account by time, then by id."""
    order = [time, tie]

    def plain(rows: DataFrame) -> DataFrame:
        number = F.row_number().over(Window.partitionBy(account).orderBy(*order))
        return rows.withColumn("sequence_no", number.cast("bigint"))

    hot = find_hot_keys(df, account, rows_per_task, known)
    if hot is None:
        return plain(df)
    sliced = slice_by_range(hot.hot(df), account, order, slices_for(hot.rows, rows_per_task))
    earlier = carry(sliced, account, {"_earlier": F.count(F.lit(1))}, F.sum)
    number = F.row_number().over(in_slice(account, order)) + F.coalesce("_earlier", _zero())
    numbered = attach_carry(sliced, earlier, account).select(*df.columns, number.alias("sequence_no"))
    return plain(hot.cold(df)).unionByName(numbered)


def inter_txn_gap(
    df: DataFrame,
    account: str = "account_id_token",
    time: str = "event_ts",
    tie: str = "transaction_id",
    rows_per_task: int = ROWS_PER_TASK,
    known: HotKeys | None = None,
) -> DataFrame:
    """Add `gap_micros`: time since the account's previous transaction, null for the first."""
    order = [time, tie]

    def since(previous: Column) -> Column:
        return F.unix_micros(F.col(time).cast("timestamp")) - F.unix_micros(previous.cast("timestamp"))

    def plain(rows: DataFrame) -> DataFrame:
        return rows.withColumn("gap_micros", since(F.lag(time).over(Window.partitionBy(account).orderBy(*order))))

    hot = find_hot_keys(df, account, rows_per_task, known)
    if hot is None:
        return plain(df)
    sliced = slice_by_range(hot.hot(df), account, order, slices_for(hot.rows, rows_per_task))
    latest = carry(sliced, account, {"_latest": F.max(time)}, F.max)
    inside = in_slice(account, order)
    previous = F.when(F.row_number().over(inside) == 1, F.col("_latest")).otherwise(F.lag(time).over(inside))
    gaps = attach_carry(sliced, latest, account).select(*df.columns, since(previous).alias("gap_micros"))
    return plain(hot.cold(df)).unionByName(gaps)


def velocity(
    df: DataFrame,
    account: str = "account_id_token",
    time: str = "event_ts",
    amount: str = "amount_cents",
    span_micros: int = HOUR_MICROS,
    rows_per_task: int = ROWS_PER_TASK,
    known: HotKeys | None = None,
) -> DataFrame:
    """Add `txn_count` and `cents_total` over the trailing span, both ends included.

    The difference of two running totals, whose cost does not depend on how
    dense an account is. Totals run in decimals, so that no account's history
    overflows; a difference that does not fit a bigint is null. Rows without a
    time form one group per account.
    """
    timed = df.withColumn("_t", F.unix_micros(F.col(time).cast("timestamp")))
    hot = find_hot_keys(df, account, rows_per_task, known)
    totals = _running_difference(timed if hot is None else hot.cold(timed), df.columns, account, amount, span_micros)
    if hot is None:
        return totals
    rows = hot.hot(timed).withColumn("_at", F.struct(account, "_t"))
    at_instant = _trailing_totals(rows, account, amount, span_micros, slices_for(2 * hot.rows, rows_per_task))
    joined = rows.join(at_instant, "_at", "left")
    return totals.unionByName(joined.select(*df.columns, "txn_count", "cents_total"))


def _running_difference(
    rows: DataFrame, columns: list[str], account: str, amount: str, span_micros: int
) -> DataFrame:
    """Trailing totals with one shuffle by account.

    Each row puts two marks on its account's time line, its own and the begin of
    its span; only the first carries the row. Begins lie in the order of their
    rows, so the n-th begin belongs to the n-th row. All windows are partitioned
    by the account and more, which one shuffle by account serves.
    """
    own = F.struct(F.col("_t").alias("pos"), F.lit(1).alias("own"), F.struct(*columns).alias("row"))
    begin = F.struct((F.col("_t") - span_micros).alias("pos"), F.lit(0).alias("own"), F.lit(None).alias("row"))
    marks = rows.select(F.col(account).alias("_account"), F.inline(F.array(own, begin)))
    # Begin marks sort before rows at the same position: the span is closed.
    up_to = Window.partitionBy("_account").orderBy("pos", "own").rangeBetween(Window.unboundedPreceding, 0)
    nth = Window.partitionBy("_account", "own").orderBy("pos")
    cents = F.col("row")[amount]
    running = marks.select(
        "_account",
        "own",
        "row",
        F.row_number().over(nth).alias("n"),
        F.sum("own").over(up_to).alias("rows"),
        F.count(cents).over(up_to).alias("priced"),
        F.coalesce(F.sum(cents.cast("decimal(20,0)")).over(up_to).cast(WIDE), F.lit(0).cast(WIDE)).alias("cents"),
    )
    pair = Window.partitionBy("_account", "n")
    totals = running.select(
        "_account",
        "own",
        "row",
        *(F.sum(_signed(F.col(name))).over(pair).alias(name) for name in ("rows", "priced", "cents")),
    )
    return totals.where(F.col("own") == 1).select(*_unpacked(columns, account), F.col("rows").alias("txn_count"), _cents_total())


def _unpacked(columns: list[str], account: str) -> list[Column]:
    """The columns of a carried row; the account is that of the windows, so Spark knows that rows still lie by it."""
    return [F.col("_account").alias(c) if c == account else F.col("row")[c].alias(c) for c in columns]


def _signed(value: Column) -> Column:
    return F.when(F.col("own") == 1, value).otherwise(-value)


def _cents_total() -> Column:
    return F.when(F.col("priced") > 0, F.col("cents").try_cast("bigint")).alias("cents_total")


def _trailing_totals(rows: DataFrame, account: str, amount: str, span_micros: int, slices: int) -> DataFrame:
    """Totals of the span that ends at each (account, instant).

    The same two marks as above, but one pair per instant, so that positions are
    unique and a slice never ends between marks that belong together.
    """
    instants = rows.groupBy(account, "_t").agg(
        F.count(F.lit(1)).alias("n"),
        F.count(amount).alias("priced"),
        F.sum(F.col(amount).cast("decimal(20,0)")).cast(WIDE).alias("cents"),
    )
    begin = F.struct((F.col("_t") - span_micros).alias("pos"), F.lit(0).alias("own"))
    end = F.struct(F.col("_t").alias("pos"), F.lit(1).alias("own"))
    marks = instants.select(account, "_t", "n", "priced", "cents", F.inline(F.array(begin, end)))
    order = ["pos", "own", "_t"]
    sliced = slice_by_range(marks, account, order, slices)
    # A begin mark sorts before an instant at the same position: the span is closed.
    measures = {
        f"_{m}": F.when(F.col("own") == 1, F.coalesce(F.col(m), _zero())).otherwise(_zero())
        for m in ("n", "priced", "cents")
    }
    earlier = carry(sliced, account, {name: F.sum(value) for name, value in measures.items()}, F.sum)
    running = in_slice(account, order).rowsBetween(Window.unboundedPreceding, 0)
    terms = attach_carry(sliced, earlier, account).select(
        account,
        "_t",
        *(
            _signed(F.sum(value).over(running) + F.coalesce(F.col(name), _zero())).alias(f"t{name}")
            for name, value in measures.items()
        ),
    )
    return (
        terms.groupBy(account, "_t")
        .agg(F.sum("t_n").alias("txn_count"), F.sum("t_priced").alias("priced"), F.sum("t_cents").alias("cents"))
        .select(
            F.struct(account, "_t").alias("_at"),
            "txn_count",
            _cents_total(),
        )
    )


def distinct_in_span(
    df: DataFrame,
    item: str = "merchant_id",
    name: str = "distinct_merchants",
    account: str = "account_id_token",
    time: str = "event_ts",
    span_micros: int = HOUR_MICROS,
    rows_per_task: int = ROWS_PER_TASK,
    known: HotKeys | None = None,
) -> DataFrame:
    """Add how many different values of `item` the account has in the trailing span, both ends included.

    An occurrence counts until the next one of its item, or until the span is
    over: two marks on the account's time line, whose running total is the
    count. Rows without an item add nothing; rows without a time get null. One
    shuffle by account serves all windows; accounts with too many rows go by
    sliced totals.
    """
    timed = df.withColumn("_t", F.unix_micros(F.col(time).cast("timestamp")))
    hot = find_hot_keys(timed, account, rows_per_task, known)
    counted = _running_distinct(timed if hot is None else hot.cold(timed), df.columns, account, item, name, span_micros)
    if hot is None:
        return counted
    rows = hot.hot(timed).withColumn("_at", F.struct(account, "_t"))
    at_instant = _sliced_distinct(rows, account, item, name, span_micros, slices_for(3 * hot.rows, rows_per_task), rows_per_task)
    joined = rows.join(at_instant, "_at", "left")
    return counted.unionByName(joined.select(*df.columns, F.when(F.col("_t").isNotNull(), F.col(name)).alias(name)))


def _running_distinct(rows: DataFrame, columns: list[str], account: str, item: str, name: str, span_micros: int) -> DataFrame:
    """Distinct counts with one shuffle by account. Occurrences at one instant end at once, but for one of them."""
    own = Window.partitionBy(account, item).orderBy("_t")
    until = F.least(F.lead("_t").over(own), F.col("_t") + span_micros + 1)
    counts = F.when(F.col(item).isNotNull() & F.col("_t").isNotNull(), 1).otherwise(0)
    seen = rows.repartition(account).select(
        F.col(account).alias("_account"), "_t", until.alias("_until"), counts.alias("_counts"), F.struct(*columns).alias("_row")
    )
    begin = F.struct(F.col("_t").alias("pos"), F.col("_counts").alias("delta"), F.col("_row").alias("row"))
    end = F.struct(F.col("_until").alias("pos"), (-F.col("_counts")).alias("delta"), F.lit(None).alias("row"))
    marks = seen.select("_account", F.inline(F.array(begin, end)))
    up_to = Window.partitionBy("_account").orderBy("pos").rangeBetween(Window.unboundedPreceding, 0)
    running = marks.select("_account", "pos", "row", F.sum("delta").over(up_to).alias("n"))
    return running.where(F.col("row").isNotNull()).select(*_unpacked(columns, account), F.when(F.col("pos").isNotNull(), F.col("n")).alias(name))


def _sliced_distinct(rows: DataFrame, account: str, item: str, name: str, span_micros: int, slices: int, rows_per_task: int) -> DataFrame:
    """(_at, count) at each instant of hot accounts: marks where an item comes after more than a span, and where it goes."""
    timed = rows.where(F.col("_t").isNotNull())
    seen = timed.where(F.col(item).isNotNull()).select(account, item, "_t").distinct()
    seen = seen.withColumn("_pair", F.struct(account, item)).withColumn("_time", F.timestamp_micros("_t"))
    gaps = inter_txn_gap(seen, "_pair", "_time", "_t", rows_per_task)
    comes = F.col("gap_micros").isNull() | (F.col("gap_micros") > span_micros)
    left = F.col("_t") - F.col("gap_micros") + span_micros + 1
    came = gaps.where(comes).select(
        account, F.inline(F.array(F.struct(F.col("_t").alias("pos"), F.lit(1).alias("delta")), F.struct(left.alias("pos"), F.lit(-1).alias("delta"))))
    )
    last = seen.groupBy(account, item).agg((F.max("_t") + span_micros + 1).alias("pos")).select(account, "pos", F.lit(-1).alias("delta"))
    instants = timed.select(account, F.col("_t").alias("pos"), F.lit(0).alias("delta"))
    marks = came.where(F.col("pos").isNotNull()).unionByName(last).unionByName(instants)
    net = marks.groupBy(account, "pos").agg(F.sum("delta").alias("delta"))
    sliced = slice_by_range(net, account, ["pos"], slices)
    earlier = carry(sliced, account, {"_before": F.sum("delta")}, F.sum)
    running = F.sum("delta").over(in_slice(account, ["pos"]).rowsBetween(Window.unboundedPreceding, 0))
    counted = attach_carry(sliced, earlier, account)
    return counted.select(F.struct(F.col(account), F.col("pos").alias("_t")).alias("_at"), (running + F.coalesce("_before", _zero())).alias(name))
