"""Every registered query against its check SQL, over the whole small tables."""

import duckdb
import pytest

import __spark_entry__ as driver
from catalog.registry import CHECK_SQL, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "boolean": "BOOLEAN", "date": "DATE",
         "timestamp_ntz": "TIMESTAMP", "double": "DOUBLE"}


@pytest.fixture(scope="module")
def tables(sf_dir):
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf_dir, tables, name):
    frame = driver.queries()[name](spark, sf_dir)
    names = sorted(frame.columns)
    got = [tuple(r) for r in frame.select(*names).collect()]
    relation = tables.sql(driver.oracle_sql()[name])
    assert sorted(relation.columns) == names
    types = dict(zip(relation.columns, map(str, relation.types)))
    for field in frame.schema.fields:
        spark_type = field.dataType.simpleString()
        assert TYPES.get(spark_type, spark_type.upper()) == types[field.name], field.name
    want = relation.select(*(f'"{n}"' for n in names)).fetchall()
    assert sorted(got, key=repr) == sorted(want, key=repr)
    if name != "dlq_spike_minutes":  # no minute of the smallest table has a spike
        assert got


def test_every_query_has_sql():
    assert set(QUERIES) == set(CHECK_SQL)
    assert set(QUERIES) <= set(driver.queries()) and set(CHECK_SQL) <= set(driver.oracle_sql())


def test_entry(spark):
    assert driver.entry(spark).count() == 1
