"""Parsing and validation on literal records."""

import json

import pytest
from pyspark.sql import functions as F

from tillstream import schemas as S
from tillstream.operators import ingest

GOOD = {
    "event_type": "pay_success", "tenant_id": "T0001", "app_id": "A1", "order_id": "O1",
    "payment_id": "P1", "user_id": "U1", "idempotency_key": "K1", "amount_minor": 9900,
    "currency": "CNY", "channel_id": "ch", "pay_method": "wx", "take_rate_rule_version": 3,
    "take_rate_pct": 0.03, "take_rate_amount": 297, "settlement_amount": 9603,
    "event_time": 1710576896000, "ingest_time": 1710576897000, "data_quality_flag": "normal",
}
NOW = 1710580000000


def text_of(**changes):
    doc = GOOD | changes
    return json.dumps({k: v for k, v in doc.items() if v is not ...})


def check(spark, raw, lenient=False):
    df = spark.createDataFrame([(raw,)], "value string")
    return ingest.validate_pay(ingest.parse_events(df, lenient=lenient))


CASES = [
    (text_of(), None),
    ("not json", "json_parse_error"),
    ('{"tenant_id": "T1"', "json_parse_error"),
    ("", "missing_tenant_id"),
    ("  ", "missing_tenant_id"),
    ("null", "missing_tenant_id"),
    ("[1]", "missing_tenant_id"),
    ("5", "missing_tenant_id"),
    ('{"tenant_id": "T1"}', "missing_app_id"),
    (text_of(tenant_id=...), "missing_tenant_id"),
    (text_of(tenant_id=None), "missing_tenant_id"),
    (text_of(tenant_id=""), "missing_tenant_id"),
    (text_of(tenant_id=" "), None),
    (text_of(tenant_id={"a": 1}), "missing_tenant_id"),
    (text_of(tenant_id=["a"]), "missing_tenant_id"),
    (text_of(tenant_id=17), None),
    (text_of(tenant_id="{x"), None),
    (text_of(app_id=...), "missing_app_id"),
    (text_of(order_id=...), "missing_order_id"),
    (text_of(payment_id=...), "missing_payment_id"),
    (text_of(idempotency_key=...), "missing_idempotency_key"),
    (text_of(user_id=...), "missing_user_id"),
    (text_of(event_time=...), "missing_event_time"),
    (text_of(event_time="1710576896000"), "missing_event_time"),
    (text_of(amount_minor=...), "missing_amount_minor"),
    (text_of(amount_minor="100"), "missing_amount_minor"),
    (text_of(amount_minor=True), "missing_amount_minor"),
    (text_of(amount_minor=0), "amount_le_zero:0"),
    (text_of(amount_minor=0.9), "amount_le_zero:0"),
    (text_of(amount_minor=-2510), "amount_le_zero:-2510"),
    (text_of(pay_method="unknown"), "invalid_pay_method:unknown"),
    (text_of(pay_method=""), None),
    (text_of(pay_method=...), None),
    (text_of(tenant_id=..., app_id=..., amount_minor=...), "missing_tenant_id"),
    (text_of() + " trailing", None),
    ("  " + text_of(), None),
]


def test_validator(spark):
    df = spark.createDataFrame([(i, raw) for i, (raw, _) in enumerate(CASES)], "i int, value string")
    got = ingest.validate_pay(ingest.parse_events(df)).orderBy("i").collect()
    for row, (raw, reason) in zip(got, CASES, strict=True):
        assert row.dirty_reason == reason, raw


def test_numbers(spark):
    strict = check(spark, text_of(amount_minor=3.7)).first()
    assert strict.amount_minor == 3
    assert check(spark, text_of(amount_minor="100"), True).first().amount_minor == 100
    assert check(spark, text_of(amount_minor="+7"), True).first().amount_minor == 7
    assert check(spark, text_of(amount_minor="1.5"), True).first().amount_minor is None
    assert check(spark, text_of(amount_minor=" 5"), True).first().amount_minor is None
    assert check(spark, text_of(amount_minor=3.7), True).first().amount_minor == 3
    big = 9_007_199_254_740_993
    assert check(spark, text_of(amount_minor=big)).first().amount_minor == big


def test_optional_fields(spark):
    row = check(spark, text_of(take_rate_pct="x", take_rate_amount="297", psp=5)).first()
    assert row.take_rate_pct is None
    assert row.take_rate_amount is None
    assert row.psp == "5"
    assert row.settlement_amount == 9603


def test_detail(spark):
    valid, _ = ingest.split(check(spark, text_of(pay_method=..., data_quality_flag=...)))
    detail = ingest.to_detail(valid, NOW)
    assert detail.columns == [f.name for f in S.DETAIL]
    row = detail.first()
    assert str(row.event_date) == "2024-03-16"
    assert str(row.event_time) == "2024-03-16 16:14:56"
    assert row.pay_method == ""
    assert row.data_quality_flag == "normal"
    assert str(row.take_rate_pct) == "0.030000"


def test_dirty_rows(spark):
    raws = ["not json", '{"tenant_id":"T1"}', text_of(amount_minor=0), "x" * 2500]
    df = spark.createDataFrame([(r,) for r in raws], "value string")
    _, dirty = ingest.split(ingest.validate_pay(ingest.parse_events(df)))
    rows = {r.raw_payload[:14]: r for r in ingest.dirty_rows(dirty, NOW).collect()}
    assert (rows["not json"].event_type, rows["not json"].tenant_id) == ("", "")
    assert rows['{"tenant_id":"'].event_type == "pay_success"
    assert rows['{"tenant_id":"'].tenant_id == "T1"
    assert len(rows["x" * 14].raw_payload) == 2500


def test_long_text_is_read_whole(spark):
    raw = text_of(trace_id="t" * 100_000, amount_minor=7)
    row = check(spark, raw).first()
    assert row.dirty_reason is None and len(row.trace_id) == 100_000


def test_gmv_filter(spark):
    raws = [
        text_of(), text_of(tenant_id=" "), text_of(amount_minor=0), text_of(pay_method="unknown"),
        text_of(pay_method=..., channel_id=" "), "not json", text_of(amount_minor="12"),
        text_of(event_time=...),
    ]
    df = spark.createDataFrame([(r,) for r in raws], "value string")
    got = ingest.valid_for_gmv(ingest.parse_events(df, lenient=True))
    rows = sorted((r.pay_method, r.channel_id, r.amount_minor) for r in got.collect())
    assert rows == [
        ("unknown", "ch", 9900), ("unknown_pay_method", "unknown_channel", 9900),
        ("wx", "ch", 12), ("wx", "ch", 9900),
    ]


def test_recovery_detail(spark):
    raws = [
        text_of(amount_minor=-2510), text_of(payment_id=" "), text_of(payment_id=..., order_id=...),
        text_of(event_id=" E9 "), text_of(channel_id=..., pay_method=...),
    ]
    df = spark.createDataFrame([(r,) for r in raws], "value string")
    got = ingest.to_recovery_detail(ingest.parse_events(df, lenient=True), NOW).collect()
    assert sorted((r.event_id, r.amount_minor, r.channel_id) for r in got) == [
        ("E9", 9900, "ch"), ("O1", 9900, "ch"), ("P1", -2510, "ch"), ("P1", 9900, "unknown"),
    ]


def test_correction_signs(spark):
    base = {k: GOOD[k] for k in GOOD if k != "event_type"}
    rows = [
        base | {"event_type": "refund_success", "amount_minor": -5},
        base | {"event_type": "refund_success", "amount_minor": 5},
        base | {"event_type": "chargeback", "amount_minor": 0},
        base | {"event_type": "settlement_adjust", "amount_minor": -5},
        base | {"event_type": "settlement_adjust", "amount_minor": 5},
    ]
    df = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(rows)], "i int, value string")
    got = ingest.validate_events(ingest.parse_events(df)).orderBy("i").collect()
    assert [r.dirty_reason for r in got] == [None, "amount_ge_zero:5", "amount_ge_zero:0", None, None]


def test_conform(spark):
    df = spark.range(1).select(F.lit("x").alias("event_id"))
    with pytest.raises(ValueError, match="event_type"):
        ingest.conform(df, S.RECOVERY_DETAIL)
    nulls = spark.range(1).select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in S.RECOVERY_DETAIL]
    )
    with pytest.raises(Exception, match="event_id is null"):
        ingest.conform(nulls, S.RECOVERY_DETAIL).collect()


def test_wire_round_trip(spark):
    df = spark.createDataFrame([(text_of(),)], "value string")
    parsed = ingest.parse_events(df)
    wire = ingest.to_wire(parsed.drop("raw_payload", "parse_error", "event_id")).first().value
    assert json.loads(wire) == GOOD
    assert list(json.loads(wire)) == [f for f in S.WIRE_FIELDS if f in GOOD]


def test_routing(spark):
    df = spark.createDataFrame(
        [("chargeback", "T1", "O1"), ("take_rate_rule_change", "T1", None), ("other", None, None)],
        "event_type string, tenant_id string, order_id string",
    )
    got = ingest.to_topic_records(df).collect()
    assert [r.topic for r in got] == ["tp_chargeback", "tp_take_rate_rule_change", "tp_pay_success"]
    assert [r.key for r in got[:2]] == ["T1|O1", "T1"]
    assert len(got[2].key) == 36


def test_quality_flags(spark):
    cols = "amount_minor long, channel_id string, region string, pay_method string, event_time long, ingest_time long, data_quality_flag string"
    hour = 3_600_000
    df = spark.createDataFrame(
        [
            (100, "c", "r", "wx", 0, 0, "normal"),
            (0, None, "r", "unknown", 0, 0, "normal"),
            (99_999_999, "c", None, None, 0, 0, "normal"),
            (-1, "c", "r", "wx", 9 * hour, hour, None),
        ],
        cols,
    )
    got = [r.quality_issues for r in ingest.quality_flags(df).collect()]
    assert got == [
        [], ["zero_amount", "missing_channel", "unknown_method"],
        ["huge_amount", "missing_region", "unknown_method"], ["negative_amount", "clock_shift"],
    ]
