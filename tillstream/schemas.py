"""Explicit schemas of events and stored tables; nothing is ever inferred."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(), "bigint": T.LongType(), "int": T.IntegerType(),
    "double": T.DoubleType(), "date": T.DateType(), "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(), "decimal(10,6)": T.DecimalType(10, 6),
}


def columns(text: str) -> T.StructType:
    """Schema from ``name type [not null], ...``; needs no running session."""
    fields = []
    for part in text.split(", "):
        name, kind, *rest = part.split()
        fields.append(T.StructField(name, _TYPES[kind], nullable=not rest))
    return T.StructType(fields)


PAY, REFUND, CHARGEBACK, ADJUST, RULE_CHANGE = (
    "pay_success",
    "refund_success",
    "chargeback",
    "settlement_adjust",
    "take_rate_rule_change",
)

# Topic of each event type, and the topic of anything else.
TOPICS = {
    PAY: "tp_pay_success",
    REFUND: "tp_refund_success",
    CHARGEBACK: "tp_chargeback",
    ADJUST: "tp_settlement_adjust",
    RULE_CHANGE: "tp_take_rate_rule_change",
}
DEFAULT_TOPIC = "tp_pay_success"
RISK_TOPIC = "tp_risk_hit"
THROTTLE_TOPIC = "tp_tenant_throttle"

# Accepted payment methods.
PAY_METHODS = ["wx", "alipay", "card", "h5", "quickpay"]

# Common amounts in minor units, and the marker of a huge amount.
COMMON_AMOUNTS = [600, 3000, 6800, 12800, 32800, 64800, 9800, 19800, 4800, 1200, 30000, 50000]
HUGE_AMOUNT = 99_999_999

RULE_PAYLOAD = columns(
    "rate_type string, rate_pct double, fixed_fee bigint, cap_amount bigint, "
    "floor_amount bigint, pay_method string, channel_id string"
)

TEXT_FIELDS = [
    "event_type", "tenant_id", "app_id", "order_id", "payment_id", "refund_id",
    "chargeback_id", "adjust_id", "user_id", "idempotency_key", "currency", "channel_id",
    "pay_method", "psp", "region", "ref_type", "ref_id", "adjust_reason", "refund_reason",
    "rule_id", "trace_id", "data_quality_flag", "event_id",
]
LONG_FIELDS = [
    "amount_minor", "take_rate_rule_version", "take_rate_fixed_fee", "take_rate_amount",
    "settlement_amount", "rule_version", "effective_time", "event_time", "ingest_time",
]
DOUBLE_FIELDS = ["take_rate_pct"]

# Key order of an event on the wire.
WIRE_FIELDS = [
    "event_type", "tenant_id", "app_id", "order_id", "payment_id", "refund_id",
    "chargeback_id", "adjust_id", "user_id", "idempotency_key", "amount_minor", "currency",
    "channel_id", "pay_method", "psp", "region", "take_rate_rule_version", "take_rate_pct",
    "take_rate_fixed_fee", "take_rate_amount", "settlement_amount", "ref_type", "ref_id",
    "adjust_reason", "refund_reason", "rule_id", "rule_version", "effective_time",
    "rule_payload", "event_time", "ingest_time", "trace_id", "data_quality_flag",
]

TOPIC_RECORD = columns(
    "key string, value string, topic string, partition int, offset bigint, timestamp timestamp"
)

DETAIL = columns(
    "event_date date not null, idempotency_key string not null, tenant_id string not null, "
    "app_id string not null, order_id string not null, payment_id string, "
    "user_id string not null, event_type string not null, amount_minor bigint not null, "
    "currency string, channel_id string, pay_method string, psp string, region string, "
    "take_rate_rule_version int, take_rate_pct decimal(10,6), take_rate_amount bigint, "
    "settlement_amount bigint, trace_id string, event_time timestamp_ntz not null, "
    "ingest_time timestamp_ntz, process_time timestamp_ntz, data_quality_flag string"
)

DETAIL_FULL = columns(
    "event_date date not null, idempotency_key string not null, tenant_id string not null, "
    "app_id string not null, order_id string not null, payment_id string, refund_id string, "
    "chargeback_id string, adjust_id string, user_id string not null, "
    "event_type string not null, amount_minor bigint not null, currency string, "
    "channel_id string, pay_method string, psp string, region string, "
    "take_rate_rule_version int, take_rate_pct decimal(10,6), take_rate_fixed_fee bigint, "
    "take_rate_amount bigint, settlement_amount bigint, ref_type string, ref_id string, "
    "adjust_reason string, refund_reason string, trace_id string, "
    "event_time timestamp_ntz not null, ingest_time timestamp_ntz, "
    "process_time timestamp_ntz, data_quality_flag string"
)

DIRTY = columns(
    "event_date date not null, receive_time timestamp_ntz not null, "
    "dirty_reason string not null, event_type string, tenant_id string, raw_payload string"
)

RULE_DIM = columns(
    "tenant_id string not null, rule_version int not null, rule_id string not null, "
    "effective_time timestamp_ntz not null, pay_method string, channel_id string, "
    "rate_type string not null, rate_pct decimal(10,6), fixed_fee bigint, cap_amount bigint, "
    "floor_amount bigint, publish_time timestamp_ntz, operator string, "
    "create_time timestamp_ntz"
)

MINUTE_GMV = columns(
    "stat_date date not null, stat_minute timestamp_ntz not null, tenant_id string not null, "
    "app_id string not null, channel_id string not null, pay_method string not null, "
    "pay_count bigint not null, pay_amount bigint not null, net_amount bigint not null, "
    "update_time timestamp_ntz not null"
)

RECOVERY_DETAIL = columns(
    "event_id string not null, event_type string not null, event_time timestamp_ntz not null, "
    "ingest_time timestamp_ntz, tenant_id string not null, app_id string not null, "
    "channel_id string, pay_method string, amount_minor bigint not null, "
    "update_time timestamp_ntz"
)

# Metric columns of the minute and hour settlement tables, in table order.
SETTLEMENT_METRICS = [
    "pay_count", "pay_amount", "refund_count", "refund_amount", "chargeback_count",
    "chargeback_amount", "adjust_count", "adjust_amount", "net_amount", "take_rate_total",
    "settlement_total",
]
MINUTE_KEYS = ["stat_date", "stat_minute", "tenant_id", "app_id", "channel_id", "pay_method"]
RECON_KEYS = ["recon_date", "recon_hour", "tenant_id"]
