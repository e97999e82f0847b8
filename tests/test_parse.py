import json
import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of
from txnflow.operators.contract import contract_gate, contract_violations
from txnflow.operators.parse import invalid_rows, parse_and_validate, tag, valid_rows
from txnflow.operators.transform import event_envelope, fill_defaults, landing_projection, transform
from txnflow.functions import TokenKey
from txnflow.plans.operations import replay
from txnflow.schema import ENVELOPE_SCHEMA, LANDING_NAMES, PAYLOAD_SCHEMA

GOOD = {
    "transaction_id": "t1",
    "account_id": "ACC-1",
    "amount_cents": 100000,
    "currency": " usd ",
    "merchant_id": "M1",
    "merchant_category_code": "5411",
    "event_type": "AUTHORIZATION",
    "event_timestamp": "2024-01-02T03:04:05",
    "card_last_four": "1234",
    "is_international": True,
    "metadata": {"a": "1"},
}


def without(*names):
    return json.dumps({k: v for k, v in GOOD.items() if k not in names})


def having(**fields):
    return json.dumps(GOOD | fields)


def envelopes(spark, texts):
    rows = [
        (b"ACC-1", t.encode() if isinstance(t, str) else t, "t", 0, i, datetime(2024, 1, 2), 0)
        for i, t in enumerate(texts)
    ]
    return spark.createDataFrame(rows, ENVELOPE_SCHEMA)


# payload, lenient route, strict reason (None: valid)
CASES = [
    (None, False, "PARSE_FAILURE"),
    ("", False, "PARSE_FAILURE"),
    ("   ", False, "PARSE_FAILURE"),
    ("garbage", False, "PARSE_FAILURE"),
    (having()[:-1], False, "PARSE_FAILURE"),
    (b"\x00\x00\x00\x00\x01abc", False, "PARSE_FAILURE"),
    ("[1, 2]", False, "PARSE_FAILURE"),
    (without("transaction_id"), False, "PARSE_FAILURE"),
    (having(transaction_id=None), False, "PARSE_FAILURE"),
    (without("transaction_id").replace("account_id", "TRANSACTION_ID", 1), False, "PARSE_FAILURE"),
    (having(transaction_id=""), True, "CONTRACT_transaction_id"),
    (having(transaction_id=7), True, None),
    (having(amount_cents="5"), True, "CONTRACT_amount_cents"),
    (having(amount_cents="x"), True, "CONTRACT_amount_cents"),
    (having(amount_cents=1.5), True, "CONTRACT_amount_cents"),
    (having(is_international="true"), True, "CONTRACT_is_international"),
    (without("currency"), True, "CONTRACT_currency"),
    (having(extra=1), True, None),
    (having()[:-1] + ', "currency": "EUR"}', True, None),
    (having(metadata={"n": {"m": 1}, "k": 2}), True, None),
    (having(metadata=5), True, "CONTRACT_payload"),
    (without("metadata"), True, None),
    (having(), True, None),
]


def test_lenient_routes(spark):
    raw = envelopes(spark, [c[0] for c in CASES])
    valid, invalid = parse_and_validate(raw)
    assert sorted(r.offset for r in valid.collect()) == [i for i, c in enumerate(CASES) if c[1]]
    refused = {r.offset: r for r in invalid.collect()}
    assert sorted(refused) == [i for i, c in enumerate(CASES) if not c[1]]
    assert {r.dlq_reason for r in refused.values()} == {"PARSE_FAILURE"}
    assert bytes(refused[5].payload) == CASES[5][0], "raw bytes are kept"


def test_strict_reasons(spark):
    tagged = tag(envelopes(spark, [c[0] for c in CASES]), strict=True)
    got = {r.offset: r.dlq_reason for r in tagged.collect()}
    assert got == {i: c[2] for i, c in enumerate(CASES)}


def test_every_message_takes_exactly_one_route(spark):
    nested = having(metadata={"a": "b", "c": {"d": [1, {"e": 2}]}})
    first = '{"metadata":' + nested.split('"metadata":')[1][:-1] + "," + having()[1:]
    texts = [c[0] for c in CASES] + [t[:i] for t in (nested, first) for i in range(len(t) + 1)]
    texts += [having() + t for t in (" junk", ",", "}", having())]
    raw = envelopes(spark, texts).cache()
    for strict in (False, True):
        tagged = tag(raw, strict)
        routed = parse_and_validate(raw, strict)
        for valid, invalid in ((valid_rows(tagged), invalid_rows(tagged)), routed):
            offsets = [r.offset for r in valid.select("offset").collect()] + [r.offset for r in invalid.select("offset").collect()]
            assert sorted(offsets) == list(range(len(texts)))
    cut = set(range(len(CASES), len(CASES) + len(nested))) | set(range(len(CASES) + len(nested) + 1, len(CASES) + len(nested) + 1 + len(first)))
    assert cut.isdisjoint(r.offset for r in parse_and_validate(raw).valid.collect())


def test_strict_takes_one_object_and_nothing_else(spark):
    texts = [having() + t for t in ("", " \n", " junk", ",", "}", having())]
    got = {r.offset: r.dlq_reason for r in tag(envelopes(spark, texts), strict=True).collect()}
    assert got == {0: None, 1: None, **{i: "CONTRACT_payload" for i in range(2, 6)}}


def test_strict_refuses_what_the_landing_table_cannot_hold(spark):
    texts = [
        having(currency="EUROS"), having(currency=" usd "), having(event_timestamp="bad"), having(transaction_id="x" * 37),
        having(merchant_category_code="54111"), having(amount_cents=2**62), having(event_type="F" * 31),
    ]
    got = [r.dlq_reason for r in tag(envelopes(spark, texts), strict=True).orderBy("offset").collect()]
    names = ("currency", None, "event_timestamp", "transaction_id", "merchant_category_code", "amount_cents", "event_type")
    assert got[:5] == [n and f"CONSTRAINT_{n}" for n in names[:5]] and got[6] == "CONSTRAINT_event_type"


def test_lenient_keeps_the_other_fields(spark):
    row = parse_and_validate(envelopes(spark, [having(amount_cents="x")])).valid.first()
    assert row.amount_cents is None and row.account_id == "ACC-1" and row.metadata == {"a": "1"}


def test_last_of_duplicate_keys_wins(spark):
    text = having()[:-1] + ', "currency": "EUR"}'
    assert parse_and_validate(envelopes(spark, [text])).valid.first().currency == "EUR"


def test_each_side_parses_once(spark):
    raw = envelopes(spark, [having()])
    valid, invalid = parse_and_validate(raw)
    assert plan_of(invalid).count("from_json") == 1
    assert plan_of(valid).count("from_json") == 2, "one full parse, and one of the id alone"


def test_gate(spark):
    assert contract_violations(envelopes(spark, [having()])).isEmpty()
    row = contract_violations(envelopes(spark, [without("currency", "event_type")])).first()
    assert row.violations == ["currency", "event_type"]


def test_transform_columns_and_values(spark):
    valid = parse_and_validate(envelopes(spark, [having()])).valid
    out = transform(valid, TokenKey(b"k"))
    assert out.columns == [
        *("transaction_id", "account_id", "amount_cents", "currency", "merchant_id", "merchant_category_code"),
        *("event_type", "card_last_four", "is_international", "metadata", "kafka_timestamp", "partition", "offset"),
        *("account_id_token", "event_ts", "amount_dollars", "mcc_category", "is_high_value", "ingested_at"),
    ]
    row = out.first()
    assert (row.account_id, row.currency, row.mcc_category, row.is_high_value) == ("[TOKENIZED]", "USD", "GROCERY", True)
    assert str(row.amount_dollars) == "1000.00" and row.event_ts == datetime(2024, 1, 2, 3, 4, 5)


def test_no_python_worker_in_the_transform(spark):
    plan = plan_of(landing_projection(transform(parse_and_validate(envelopes(spark, [having()])).valid, TokenKey(b"k"))))
    assert "Python" not in plan and "Arrow" not in plan


def test_landing_names_defaults_and_types(spark):
    valid = parse_and_validate(envelopes(spark, [having(amount_cents="x", is_international=None)])).valid
    landing = landing_projection(transform(valid, TokenKey(b"k")))
    assert tuple(landing.columns) == (*LANDING_NAMES, "event_date")
    row = landing.first()
    assert row.is_high_value is False and row.is_international is False and row.amount_dollars is None
    assert (row.kafka_partition, row.kafka_offset) == (0, 0)


def test_new_event_keeps_given_fields_and_fills_the_rest(spark):
    partial = spark.createDataFrame([{"account_id": "ACC-123", "amount_cents": 5000, "merchant_id": "MERCH-456"}], partial_schema())
    row = fill_defaults(partial).first()
    assert (row.account_id, row.amount_cents, row.merchant_id, row.currency) == ("ACC-123", 5000, "MERCH-456", "USD")
    assert len(row.transaction_id) == 36
    datetime.fromisoformat(row.event_timestamp)


def test_new_event_defaults(spark):
    partial = spark.createDataFrame([{"account_id": "ACC-999", "amount_cents": 0, "merchant_id": "MERCH-001"}], partial_schema())
    row = fill_defaults(partial, transaction_id=F.lit("fixed")).first()
    assert row.is_international is False and row.currency == "USD" and row.metadata == {}
    assert (row.merchant_category_code, row.event_type, row.card_last_four) == ("5411", "AUTHORIZATION", "0000")
    assert row.transaction_id == "fixed"


def partial_schema():
    from pyspark.sql import types as T

    return T.StructType([T.StructField(f.name, f.dataType) for f in PAYLOAD_SCHEMA.fields])


def test_envelope_round_trip(spark):
    valid = parse_and_validate(envelopes(spark, [having()])).valid
    sent = event_envelope(valid)
    assert sent.columns == ["key", "value"] and bytes(sent.first().key) == b"ACC-1"
    back = spark.createDataFrame([(bytes(r.key), bytes(r.value), "t", 0, 0, datetime(2024, 1, 2), 0) for r in sent.collect()], ENVELOPE_SCHEMA)
    names = PAYLOAD_SCHEMA.names
    assert parse_and_validate(back).valid.select(names).collect() == valid.select(names).collect()


def test_replay_after_a_fix(spark):
    cut = [having(transaction_id="a")[:-1], having(transaction_id="b")[:-1], having(transaction_id="b")[:-1], "junk"]
    letters = parse_and_validate(envelopes(spark, cut)).invalid
    landed = spark.createDataFrame([("a",), ("a",)], "transaction_id string")
    again = replay(letters, landed, lambda text: F.concat(text, F.lit("}")))
    assert [(r.transaction_id, r.offset) for r in again.valid.collect()] == [("b", 1)]
    assert again.invalid.count() == 1


@pytest.mark.parametrize("strict", [False, True])
def test_dead_letters_have_position_and_payload(spark, strict):
    row = parse_and_validate(envelopes(spark, ["junk"]), strict).invalid.first()
    assert (row.kafka_key, row.topic, row.partition, row.offset, bytes(row.payload)) == ("ACC-1", "t", 0, 0, b"junk")


def test_report_and_gate_agree_with_the_strict_route(spark):
    odd = [
        having() + " x", having() + having(), having(currency="EUROS"), having(event_timestamp="nonsense"), having(),
        having(merchant_id="a}b"), having(metadata={"k": "}"}), having()[:-1], "junk", having(amount_cents="5"), having() + "  ", having() + "}",
    ]
    raw = envelopes(spark, odd)
    strict = {r.offset: r.dlq_reason for r in tag(raw, strict=True).collect()}
    refused = {k for k, reason in strict.items() if reason}
    report = {r.offset: r.violations for r in contract_violations(raw).collect()}
    assert refused == set(report) and {k for k in range(len(odd)) if k not in refused} == {4, 5, 6, 10}
    assert report[0] == report[1] == report[11] == ["payload"] and report[2] == ["currency"] and report[3] == ["event_timestamp"]
    for k, reason in strict.items():
        assert reason is None or reason == "PARSE_FAILURE" or reason.split("_", 1)[1] == report[k][0]
    gate = contract_gate(raw, F.lit(0)).first()
    assert (gate.messages, gate.violations, gate.passed) == (len(odd), len(refused), False)


def test_well_formed_messages_are_parsed_once(spark):
    """The id is asked for again behind a condition that only rows meet which were not read cleanly."""
    for strict in (False, True):
        plan = tag(envelopes(spark, [having()]), strict)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json(") == 2 and re.search(r"CASE WHEN isnotnull\(_corrupt#\d+\) THEN isnull\(from_json\(", plan)
