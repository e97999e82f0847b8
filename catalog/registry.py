"""Registry of named queries and the SQL each one is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from catalog.adapters import CURRENCIES, EVENT_TYPE_OF, KEY, MCC_CODES
from txnflow.functions import MCC_CATEGORIES, TokenKey
from txnflow.session import configure

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECK_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; `sql` may use the relations of `RELATIONS` as CTEs."""

    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(configure(spark), sf_dir)

        run.__doc__ = build.__doc__
        QUERIES[name] = run
        if sql is not None:
            CHECK_SQL[name] = _with_relations(sql)
        return build

    return register


def token_sql(text: str, key: TokenKey = KEY) -> str:
    inner = f"sha256(unhex('{key.pad(0x36).hex()}') || encode({text}))"
    return f"sha256(unhex('{key.pad(0x5C).hex()}') || unhex({inner}))"


def dollars_sql(cents: str) -> str:
    return f"CAST(CAST({cents} AS DECIMAL(20,2)) * 0.01 AS DECIMAL(18,2))"


def percent_sql(part: str, whole: str) -> str:
    thousandths = f"(200000 * CAST({part} AS BIGINT) + {whole}) // (2 * {whole})"
    return f"CAST(CAST({thousandths} AS DECIMAL(12,3)) * 0.001 AS DECIMAL(9,3))"


def mean_sql(cents: str, rows: str) -> str:
    return dollars_sql(f"CAST((2 * CAST({cents} AS HUGEINT) + {rows}) // (2 * {rows}) AS BIGINT)")


def category_sql(code: str) -> str:
    cases = " ".join(f"WHEN '{c}' THEN '{name}'" for c, name in MCC_CATEGORIES.items())
    return f"CASE {code} {cases} ELSE 'OTHER' END"


def _list_sql(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


_EVENT_TYPES = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in EVENT_TYPE_OF.items())

RELATIONS = {
    "txn": f"""
    SELECT event_id, user_id, ts, k,
           CAST(event_id AS VARCHAR) AS transaction_id,
           'ACC-' || user_id AS account_id,
           CAST(round(value * 1000) AS BIGINT) AS amount_cents,
           CASE WHEN k = 6 THEN 'euros' ELSE {_list_sql(CURRENCIES)}[event_id % 4 + 1] END AS currency,
           'MERCH-' || (event_id % 50) AS merchant_id,
           {_list_sql(MCC_CODES)}[event_id % 11 + 1] AS merchant_category_code,
           CASE event_type {_EVENT_TYPES} ELSE 'FEE' END AS event_type,
           strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS event_timestamp,
           lpad(CAST(user_id AS VARCHAR), 4, '0') AS card_last_four,
           event_id % 7 = 0 AS is_international,
           '{{"k":"' || k || '"}}' AS metadata
    FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)""",
    "delivered": """
    SELECT * REPLACE (CASE WHEN k IN (2, 3) THEN NULL ELSE transaction_id END AS transaction_id),
           CAST(user_id % 8 AS INTEGER) AS kafka_partition,
           event_id * 2 + delivery - 1 AS kafka_offset,
           CASE WHEN cut OR k IN (2, 3) THEN date_trunc('day', ts) + INTERVAL 1 DAY
                ELSE ts + to_seconds(delivery * 60 - 55) END AS kafka_timestamp
    FROM (SELECT *, k = 1 OR (k = 0 AND delivery = 1) AS cut
          FROM (SELECT *, unnest(range(1, CASE WHEN k = 0 OR k BETWEEN 90 AND 94 THEN 3 ELSE 2 END)) AS delivery
                FROM txn))""",
    "valid": """
    SELECT * REPLACE (CASE WHEN k IN (4, 5) THEN NULL ELSE amount_cents END AS amount_cents)
    FROM delivered WHERE NOT cut AND transaction_id IS NOT NULL""",
    "refused": "SELECT * FROM delivered WHERE cut OR transaction_id IS NULL",
    "landed": f"""
    SELECT event_id, user_id, k, delivery, transaction_id, {token_sql("account_id")} AS account_id_token,
           '[TOKENIZED]' AS account_id, amount_cents, {dollars_sql("amount_cents")} AS amount_dollars,
           upper(trim(currency)) AS currency, merchant_id, merchant_category_code,
           {category_sql("merchant_category_code")} AS mcc_category, event_type, ts AS event_ts,
           card_last_four, is_international, coalesce(amount_cents >= 100000, FALSE) AS is_high_value, metadata,
           kafka_partition, kafka_offset, kafka_timestamp,
           kafka_timestamp + to_milliseconds(100 + 19 * k) AS ingested_at, CAST(ts AS DATE) AS event_date
    FROM valid""",
    "first_delivery": """
    SELECT * FROM landed
    QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY kafka_offset, kafka_partition) = 1""",
    "settled": f"""
    SELECT *, {token_sql("account_id")} AS account_id_token, {dollars_sql("amount_cents")} AS amount_dollars,
           {category_sql("merchant_category_code")} AS mcc_category, ts AS event_ts, CAST(ts AS DATE) AS event_date,
           amount_cents >= 100000 AS is_high_value
    FROM txn""",
    "ordered": f"""
    SELECT *, {token_sql("account_id")} AS account_id_token, {dollars_sql("amount_cents")} AS amount_dollars,
           {category_sql("merchant_category_code")} AS mcc_category, amount_cents >= 100000 AS is_high_value
    FROM (SELECT o_orderkey, 'ORD-' || o_orderkey AS transaction_id, 'ACC-' || o_custkey AS account_id,
                 CAST(round(o_totalprice * 100) AS BIGINT) AS amount_cents,
                 {_list_sql(MCC_CODES)}[o_orderkey % 11 + 1] AS merchant_category_code,
                 CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN 'CHARGEBACK'
                      WHEN o_orderpriority = '5-LOW' THEN 'REFUND'
                      WHEN o_orderstatus = 'F' THEN 'SETTLEMENT'
                      WHEN o_orderstatus = 'O' THEN 'AUTHORIZATION' ELSE 'FEE' END AS event_type,
                 o_orderdate AS event_ts, CAST(o_orderdate AS DATE) AS event_date,
                 o_orderkey % 7 = 0 AS is_international
          FROM orders)""",
    "account_dim": f"""
    SELECT {token_sql("'ACC-' || c_custkey")} AS account_id_token, c_mktsegment AS segment FROM customer""",
    "merchant_dim": "SELECT 'MERCH-' || s_suppkey AS merchant_id, s_name AS merchant_name FROM supplier",
    "monthly": f"""
    SELECT CAST(date_trunc('month', event_ts) AS DATE) AS event_month, count(*) AS transactions,
           count(DISTINCT account_id_token) AS cardholders,
           CAST(sum(amount_dollars) AS DECIMAL(38,2)) AS volume_usd,
           {percent_sql("count(*) FILTER (event_type = 'CHARGEBACK')", "count(*)")} AS dispute_rate
    FROM ordered GROUP BY 1""",
}

_ALSO_NEEDS = {
    "delivered": ("txn",),
    "valid": ("delivered",),
    "refused": ("delivered",),
    "landed": ("valid",),
    "first_delivery": ("landed",),
    "settled": ("txn",),
    "monthly": ("ordered",),
}


def _needs(text: str) -> list[str]:
    import re

    words = set(re.findall(r"\b\w+\b", text))
    found: list[str] = []

    def add(name: str) -> None:
        for needed in _ALSO_NEEDS.get(name, ()):
            add(needed)
        if name not in found:
            found.append(name)

    for name in RELATIONS:
        if name in words:
            add(name)
    return found


def _with_relations(sql: str) -> str:
    ctes = ",\n".join(f"{name} AS ({RELATIONS[name]})" for name in _needs(sql))
    return f"WITH {ctes}\n{sql}" if ctes else sql
