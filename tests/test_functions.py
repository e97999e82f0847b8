import hashlib
import hmac
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from txnflow import functions as fn
from txnflow.functions import TokenKey


def values(spark, rows, schema, expression):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expression).collect()]


@pytest.mark.parametrize("secret", [b"k", b"s" * 64, b"long" * 40])
def test_token_equals_hmac(spark, secret):
    texts = ["ACC-1", "日本-ü", "x" * 200, " ", "", None]
    got = values(spark, [(t,) for t in texts], "v string", fn.tokenize_account_id("v", TokenKey(secret)))
    want = [hmac.new(secret, t.encode(), hashlib.sha256).hexdigest() if t else "" for t in texts]
    assert got == want


def test_card_token_is_the_same_function(spark):
    key = TokenKey(b"k")
    frame = spark.createDataFrame([("4000123412341234",)], "v string")
    row = frame.select(fn.tokenize_card_number("v", key).alias("c"), fn.tokenize_account_id("v", key).alias("a")).first()
    assert row.c == row.a and len(row.c) == 64


def test_secret_is_required_and_hidden(spark, monkeypatch):
    with pytest.raises(ValueError):
        TokenKey(b"")
    monkeypatch.delenv("SOME_SECRET", raising=False)
    with pytest.raises(OSError):
        TokenKey.from_env("SOME_SECRET")
    monkeypatch.setenv("SOME_SECRET", "abc")
    key = TokenKey.from_env("SOME_SECRET")
    assert "abc" not in repr(key)
    plan = spark.range(1).select(fn.tokenize_account_id(F.col("id").cast("string"), key))
    text = plan._jdf.queryExecution().toString()
    assert key.pad(0x36).hex().lower() not in text.lower()


def test_rotation_picks_the_key_by_date(spark):
    keys = [fn.RotatingKey("b", TokenKey(b"two"), date(2024, 2, 1)), fn.RotatingKey("a", TokenKey(b"one"), date(2024, 1, 1))]
    days = [date(2023, 12, 1), date(2024, 1, 31), date(2024, 2, 1)]
    frame = spark.createDataFrame([("ACC", d) for d in days], "acc string, d date")
    got = frame.select(fn.rotating_token("acc", F.col("d"), keys).alias("t")).select("t.*").collect()
    assert [r.key_id for r in got] == ["a", "a", "b"]
    assert got[0].token == got[1].token != got[2].token


@pytest.mark.parametrize(("code", "category"), [("5411", "GROCERY"), ("5812", "RESTAURANT"), ("4511", "AIRLINE")])
def test_known_category(spark, code, category):
    assert fn.MCC_CATEGORIES[code] == category
    assert values(spark, [(code,)], "c string", fn.enrich_with_mcc_category("c")) == [category]


def test_category_list_form():
    assert all(name == name.upper() for name in fn.MCC_CATEGORIES.values())
    assert all(len(code) == 4 and code.isdigit() for code in fn.MCC_CATEGORIES)


def test_unknown_category(spark):
    got = values(spark, [("0000",), (None,), (" 5411",), ("",)], "c string", fn.enrich_with_mcc_category("c"))
    assert got == ["OTHER"] * 4


def test_threshold():
    assert fn.HIGH_VALUE_THRESHOLD_CENTS >= 10_000


def test_high_value_is_inclusive(spark):
    got = values(spark, [(99_999,), (100_000,), (0,), (-5,), (None,)], "c bigint", fn.flag_high_value_transactions("c"))
    assert got == [False, True, False, False, None]


def test_currency_trims_spaces_only(spark):
    got = values(spark, [(" usd ",), ("\tusd",), (" eur",), ("",), (None,)], "c string", fn.normalize_currency("c"))
    assert got == ["USD", "\tUSD", " EUR", "", None]


def test_dollars_are_exact(spark):
    cents = [(9007199254740993,), (2**63 - 1,), (-5,), (0,), (None,), (10**18 - 1,)]
    got = values(spark, cents, "c bigint", fn.cents_to_dollars("c"))
    assert got == [
        Decimal("90071992547409.93"), None, Decimal("-0.05"), Decimal("0.00"), None, Decimal("9999999999999999.99"),
    ]


def test_percent_and_mean_round_half_up(spark):
    frame = spark.createDataFrame([(1, 3), (1, 1600), (0, 0)], "p bigint, w bigint")
    got = [r[0] for r in frame.select(fn.percent(F.col("p"), F.col("w"))).collect()]
    assert got == [Decimal("33.333"), Decimal("0.063"), None]
    sums = spark.createDataFrame([(Decimal("0.05"), 2), (Decimal("-0.05"), 2), (Decimal("1.00"), 0)], "v decimal(38,2), n bigint")
    got = [r[0] for r in sums.select(fn.average_dollars(F.col("v"), F.col("n"))).collect()]
    assert got == [Decimal("0.03"), Decimal("-0.03"), None]


def test_event_time_forms(spark):
    texts = ["2024-01-02T03:04:05", "2024-01-02T03:04:05.120000", "2024-01-02T03:04:05Z", "2024-01-02T03:04:05+05:00",
             "2024-01-02", "bad", "", None]
    got = values(spark, [(t,) for t in texts], "t string", fn.event_time("t").cast("timestamp_ntz"))
    base = datetime(2024, 1, 2, 3, 4, 5)
    assert got == [base, base.replace(microsecond=120000), base, datetime(2024, 1, 1, 22, 4, 5),
                   datetime(2024, 1, 2), None, None, None]
    wall = values(spark, [(t,) for t in texts], "t string", fn.event_time_ntz("t"))
    assert wall[3] == base and wall[5:] == [None, None, None]


def test_metadata(spark):
    texts = [('{"a": 1, "b": {"c": 2}}',), ("[1]",), ("junk",), (None,)]
    got = values(spark, texts, "m string", fn.metadata_map("m"))
    assert got[0] == {"a": "1", "b": '{"c":2}'} and not any(got[1:])
    variant = values(spark, texts, "m string", F.try_variant_get(fn.metadata_variant("m"), "$.b.c", "int"))
    assert variant == [2, None, None, None]
