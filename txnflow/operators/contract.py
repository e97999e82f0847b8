"""Checks against the declared contract, as rows that can be counted or refused."""

from __future__ import annotations

from collections.abc import Sequence
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnflow.operators.parse import refused_fields, tag
from txnflow.schema import LANDING_COLUMNS


def contract_violations(raw: DataFrame) -> DataFrame:
    """Messages that the strict route refuses, with the offending fields; `payload` where none can be named."""
    return (
        tag(raw, strict=True)
        .where(F.col("dlq_reason").isNotNull())
        .withColumn("violations", refused_fields())
        .select("topic", "partition", "offset", "kafka_timestamp", "transaction_id", "violations")
    )


def _landing_checks() -> Column:
    checks = []
    for c in LANDING_COLUMNS:
        if c.not_null:
            checks.append(F.when(F.col(c.name).isNull(), F.lit(f"{c.name}:not_null")))
        if c.max_length is not None:
            checks.append(F.when(F.length(c.name) > c.max_length, F.lit(f"{c.name}:length")))
    return F.array_compact(F.array(*checks))


def landing_constraint_violations(landing: DataFrame) -> DataFrame:
    """Landing rows that break NOT NULL or a column length."""
    return landing.withColumn("violations", _landing_checks()).where(F.size("violations") > 0)


def contract_gate(raw: DataFrame, batch: Column) -> DataFrame:
    """One row per batch; a batch passes only when the strict route refuses none of its messages."""
    broken = F.col("dlq_reason").isNotNull().cast("bigint").alias("broken")
    checked = tag(raw, strict=True).select(batch.alias("batch"), broken)
    return (
        checked.groupBy("batch")
        .agg(F.count(F.lit(1)).alias("messages"), F.sum("broken").alias("violations"))
        .withColumn("passed", F.col("violations") == 0)
    )


def data_tests(
    df: DataFrame,
    not_null: Sequence[str] = (),
    unique: Sequence[str] = (),
    accepted: dict[str, Sequence[str]] | None = None,
    relationships: dict[str, tuple[DataFrame, str]] | None = None,
) -> DataFrame:
    """`(check_name, column_name, failures)` for every test, zero included.

    One pass over `df`: each row gives one marked row for each key test and, if
    it fails any, one for its row tests. Marked rows are counted by value first,
    so a frequent key travels as one row per task; parent keys join the same
    groups as rows with a count of zero, marked as known.
    """
    accepted, relationships = accepted or {}, relationships or {}
    row_tests = [("not_null", c, F.col(c).isNull()) for c in not_null]
    row_tests += [("accepted_values", c, ~F.col(c).isin(*values)) for c, values in accepted.items()]
    tests = [(check, c) for check, c, _ in row_tests]
    tests += [("unique", c) for c in unique] + [("relationships", c) for c in relationships]
    if not tests:
        return df.sparkSession.createDataFrame([], "check_name string, column_name string, failures bigint")
    marks = [F.when(failed, _mark(i, F.lit(None))) for i, (_, _, failed) in enumerate(row_tests)]
    key_tests = list(enumerate(tests))[len(row_tests) :]
    marks += [F.when(F.col(c).isNotNull(), _mark(i, F.col(c))) for i, (_, c) in key_tests]
    marked = df.select(F.inline(F.array_compact(F.array(*marks)))).withColumn("known", F.lit(False))
    for i, (check, c) in key_tests:
        if check == "relationships":
            frame, key = relationships[c]
            marked = marked.unionByName(frame.select(F.inline(F.array(_mark(i, F.col(key))))).withColumn("known", F.lit(True)))
    rows = F.count_if(~F.col("known"))
    groups = marked.groupBy("test", "value").agg(rows.alias("n"), F.max("known").alias("known"))
    failures = []
    for i, (check, c) in enumerate(tests):
        mine = F.col("test") == i
        if check == "unique":
            failures.append((check, c, F.count_if(mine & (F.col("n") > 1))))
        elif check == "relationships":
            failures.append((check, c, F.coalesce(F.sum(F.when(mine & ~F.col("known"), F.col("n"))), F.lit(0).cast("bigint"))))
        else:
            failures.append((check, c, F.coalesce(F.sum(F.when(mine, F.col("n"))), F.lit(0).cast("bigint"))))
    return _results(groups, failures)


def _mark(i: int, value: Column) -> Column:
    return F.struct(F.lit(i).alias("test"), value.cast("string").alias("value"))


def _results(df: DataFrame, tests: list) -> DataFrame:
    """Aggregate each test's failures and turn the one row into one row per test."""
    counts = df.agg(*(failures.alias(f"t{i}") for i, (_, _, failures) in enumerate(tests)))
    rows = [
        F.struct(F.lit(check).alias("check_name"), F.lit(c).alias("column_name"), F.col(f"t{i}").alias("failures"))
        for i, (check, c, _) in enumerate(tests)
    ]
    return counts.select(F.inline(F.array(*rows)))
