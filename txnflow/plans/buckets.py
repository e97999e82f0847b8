"""Tables stored by buckets of accounts, for jobs that ask for an account's rows again and again.

Rows are dealt to buckets and sorted once, when the table is written. Windows by
account and joins on the account then read bucket after bucket, without an
exchange. Two tables join so if their numbers of buckets are equal.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame

from txnflow.session import scratch_path

BUCKETS = 64


def write_buckets(df: DataFrame, table: str, path: str, account: str = "account_id_token", time: str | None = "event_ts", buckets: int = BUCKETS) -> DataFrame:
    """Store `df` as the table named `table` at `path`, by buckets of accounts, sorted by account and time in each.

    A bucket is one file: rows are dealt by the buckets' own hash before they
    are written. `buckets` should hold some hundred MB each. Null accounts are
    an account as any other.
    """
    order = [account, *([time] if time and time in df.columns else [])]
    writer = df.repartition(buckets, account).write.bucketBy(buckets, account).sortBy(*order)
    writer.format("parquet").mode("overwrite").option("path", path).saveAsTable(table)
    return df.sparkSession.table(table)


@contextmanager
def bucketed_table(df: DataFrame, buckets: int = BUCKETS, account: str = "account_id_token") -> Iterator[DataFrame]:
    """`df` as a bucketed table of its own for as long as the block lasts; the name is dropped after it, files stay."""
    spark, name = df.sparkSession, f"buckets_{uuid.uuid4().hex}"
    try:
        yield write_buckets(df, name, scratch_path(spark, "buckets"), account, buckets=buckets)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
