"""Parsing, validation and detail projection of payment events."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstream import schemas as S
from tillstream.functions import clock, text
from tillstream.operators.ordered import latest_per_key


_BAD = "_bad"

_TYPED = T.StructType(
    [T.StructField(f, T.StringType()) for f in S.TEXT_FIELDS]
    + [T.StructField(f, T.LongType()) for f in S.LONG_FIELDS]
    + [T.StructField(f, T.DoubleType()) for f in S.DOUBLE_FIELDS]
    + [T.StructField("rule_payload", T.StringType()), T.StructField(_BAD, T.StringType())]
)


#: Fields that decide whether an event is valid, of all four kinds.
CHECKED_FIELDS = [
    "event_type", "tenant_id", "app_id", "order_id", "payment_id", "idempotency_key", "user_id", "event_time",
    "amount_minor", "pay_method",
]


def _careful_fields(doc: Column, raw: Column, lenient: bool, names: Sequence[str]) -> Column:
    """The fields by inspecting the type of each member."""
    payload = F.try_variant_get(doc, "$.rule_payload", "variant")
    made = {
        **{f: text.v_text(doc, f) for f in S.TEXT_FIELDS},
        **{f: text.v_long(doc, f, lenient) for f in S.LONG_FIELDS},
        **{f: text.v_double(doc, f) for f in S.DOUBLE_FIELDS},
        "rule_payload": F.when(payload.isNotNull(), F.to_json(payload)),
    }
    broken = doc.isNull() & (text.squeeze(raw) != "")
    return F.struct(broken.alias("parse_error"), *[made[n].alias(n) for n in names])


def _plain_fields(typed: Column, names: Sequence[str]) -> Column:
    """The same fields from a text whose members all have the expected type."""
    return F.struct(F.lit(False).alias("parse_error"), *[typed[n].alias(n) for n in names])


def parse_events(
    df: DataFrame, value: str = "value", lenient: bool = False, fields: Iterable[str] | None = None
) -> DataFrame:
    """JSON text to typed event columns; other columns of ``df`` are kept.

    ``parse_error`` marks broken syntax. Empty text and JSON that is no object
    parse to a row without fields. ``lenient`` also reads integers in quotes. ``fields`` names
    the columns wanted, if not all.

    Flat texts with the expected types are read in one pass. The others (broken,
    nested, a number in quotes, a fraction for a whole number) are read again
    member by member.
    """
    raw = F.col("raw_payload")
    wanted = None if fields is None else set(fields)
    read_as = T.StructType([f for f in _TYPED if wanted is None or f.name in wanted or f.name == _BAD])
    names = [f.name for f in read_as if f.name != _BAD]
    keep = [c for c in df.columns if c != value and c not in S.WIRE_FIELDS]
    typed = df.select(*keep, F.col(value).alias("raw_payload")).withColumn(
        "_t", F.from_json(raw, read_as, {"columnNameOfCorruptRecord": _BAD})
    )
    # looked for bytewise: to locate a character counts all of them before it
    rest = F.substring(raw, 2, 1 << 30)
    nested = rest.contains("{") | rest.contains("[")
    marked = typed.withColumn("_careful", F.col(f"_t.{_BAD}").isNotNull() | nested)
    opened = marked.withColumn("_v", F.when(F.col("_careful"), F.try_parse_json(raw)))
    read = opened.select(
        *keep,
        "raw_payload",
        F.when(F.col("_careful"), _careful_fields(F.col("_v"), raw, lenient, names))
        .otherwise(_plain_fields(F.col("_t"), names))
        .alias("_e"),
    )
    # Generators are not merged into later filters, so each text is read once
    # however often a check refers to one of its fields.
    return read.select(*keep, "raw_payload", F.inline(F.array("_e")))


def _first_reason(checks: list[tuple[Column, Column]]) -> Column:
    return F.coalesce(*[F.when(bad, reason) for bad, reason in checks])


def _required(fields: list[str]) -> list[tuple[Column, Column]]:
    return [(text.is_blank(F.col(f), strict=True), F.lit(f"missing_{f}")) for f in fields]


def _pay_checks() -> list[tuple[Column, Column]]:
    amount, method = F.col("amount_minor"), F.col("pay_method")
    return [
        (F.col("parse_error"), F.lit("json_parse_error")),
        *_required(
            ["tenant_id", "app_id", "order_id", "payment_id", "idempotency_key", "user_id"]
        ),
        (F.col("event_time").isNull(), F.lit("missing_event_time")),
        (amount.isNull(), F.lit("missing_amount_minor")),
        (amount <= 0, F.concat(F.lit("amount_le_zero:"), amount.cast("string"))),
        (
            (method != "") & ~method.isin(S.PAY_METHODS),
            F.concat(F.lit("invalid_pay_method:"), method),
        ),
    ]


def _correction_checks() -> list[tuple[Column, Column]]:
    amount = F.col("amount_minor")
    return [
        (F.col("parse_error"), F.lit("json_parse_error")),
        *_required(["tenant_id", "app_id", "payment_id", "idempotency_key", "user_id"]),
        (F.col("event_time").isNull(), F.lit("missing_event_time")),
        (amount.isNull(), F.lit("missing_amount_minor")),
        (amount >= 0, F.concat(F.lit("amount_ge_zero:"), amount.cast("string"))),
    ]


def _adjust_checks() -> list[tuple[Column, Column]]:
    return [
        (F.col("parse_error"), F.lit("json_parse_error")),
        *_required(["tenant_id", "app_id", "idempotency_key", "user_id"]),
        (F.col("event_time").isNull(), F.lit("missing_event_time")),
        (F.col("amount_minor").isNull(), F.lit("missing_amount_minor")),
    ]


def _with_parse_flag(df: DataFrame) -> DataFrame:
    return df if "parse_error" in df.columns else df.withColumn("parse_error", F.lit(False))


def validate_pay(df: DataFrame) -> DataFrame:
    """Add ``dirty_reason``: the first failed check of a payment, or null."""
    return _with_parse_flag(df).withColumn("dirty_reason", _first_reason(_pay_checks()))


def validate_events(df: DataFrame) -> DataFrame:
    """As :func:`validate_pay` for all four money events, each with its own checks."""
    kind = F.col("event_type")
    reason = (
        F.when(kind.isin(S.REFUND, S.CHARGEBACK), _first_reason(_correction_checks()))
        .when(kind == S.ADJUST, _first_reason(_adjust_checks()))
        .otherwise(_first_reason(_pay_checks()))
    )
    return _with_parse_flag(df).withColumn("dirty_reason", reason)


def split(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, dirty) parts of a validated frame."""
    return (
        validated.where("dirty_reason is null").drop("dirty_reason", "parse_error"),
        validated.where("dirty_reason is not null"),
    )


def dirty_rows(dirty: DataFrame, now_ms: int | Column, *others: str) -> DataFrame:
    """Archive rows of the dirty part, with the whole raw text and the type the record has, if any."""
    now = now_ms if isinstance(now_ms, Column) else F.lit(now_ms).cast("long")
    untyped = F.col("dirty_reason").isin("json_parse_error", "missing_tenant_id")
    return dirty.select(
        clock.stat_date(now).alias("event_date"),
        clock.wall_clock(now).alias("receive_time"),
        "dirty_reason",
        F.when(untyped, F.lit("")).otherwise(F.coalesce("event_type", F.lit(S.PAY))).alias("event_type"),
        F.when(untyped, F.lit("")).otherwise(F.col("tenant_id")).alias("tenant_id"),
        "raw_payload",
        *others,
    )


def to_detail(valid: DataFrame, now_ms: int | Column) -> DataFrame:
    """The 23-column payment detail of valid payments."""
    now = now_ms if isinstance(now_ms, Column) else F.lit(now_ms).cast("long")
    t = F.col("event_time")
    typed = valid.select(
        clock.stat_date(t).alias("event_date"),
        "idempotency_key",
        "tenant_id",
        "app_id",
        "order_id",
        "payment_id",
        "user_id",
        F.lit(S.PAY).alias("event_type"),
        "amount_minor",
        "currency",
        "channel_id",
        F.coalesce("pay_method", F.lit("")).alias("pay_method"),
        "psp",
        "region",
        "take_rate_rule_version",
        "take_rate_pct",
        "take_rate_amount",
        "settlement_amount",
        "trace_id",
        clock.wall_clock(t).alias("event_time"),
        clock.wall_clock(F.col("ingest_time")).alias("ingest_time"),
        clock.wall_clock(now).alias("process_time"),
        F.coalesce("data_quality_flag", F.lit("normal")).alias("data_quality_flag"),
    )
    return conform(typed, S.DETAIL)


def to_detail_full(valid: DataFrame, now_ms: int | Column) -> DataFrame:
    """The 31-column detail of all four money events."""
    now = now_ms if isinstance(now_ms, Column) else F.lit(now_ms).cast("long")
    t = F.col("event_time")
    made = {
        "event_date": clock.stat_date(t),
        "order_id": F.coalesce("order_id", F.lit("")),
        "event_time": clock.wall_clock(t),
        "ingest_time": clock.wall_clock(F.col("ingest_time")),
        "process_time": clock.wall_clock(now),
        "data_quality_flag": F.coalesce("data_quality_flag", F.lit("normal")),
    }
    return conform(
        valid.select(
            *[
                made.get(f.name, F.col(f.name) if f.name in valid.columns else F.lit(None)).alias(
                    f.name
                )
                for f in S.DETAIL_FULL
            ]
        ),
        S.DETAIL_FULL,
    )


def valid_for_gmv(df: DataFrame) -> DataFrame:
    """Rows counted by the minute metrics; others are dropped without a record.

    Unknown methods count here, with defaults for blank channel and method.
    """
    kept = df.where(
        ~text.is_blank(F.col("tenant_id"))
        & ~text.is_blank(F.col("app_id"))
        & F.col("event_time").isNotNull()
        & (F.col("amount_minor") > 0)
    )
    return kept.withColumns(
        {
            "channel_id": text.normalize(F.col("channel_id"), "unknown_channel"),
            "pay_method": text.normalize(F.col("pay_method"), "unknown_pay_method"),
        }
    )


def to_recovery_detail(df: DataFrame, now_ms: int | Column) -> DataFrame:
    """The 10-column detail of the recovery job; zero and negative amounts stay."""
    now = now_ms if isinstance(now_ms, Column) else F.lit(now_ms).cast("long")
    event_id = F.col("event_id") if "event_id" in df.columns else F.lit(None).cast("string")
    rows = df.select(
        text.first_non_blank(event_id, F.col("payment_id"), F.col("order_id")).alias("event_id"),
        F.lit(S.PAY).alias("event_type"),
        clock.wall_clock(clock.floor_ms(F.col("event_time"), clock.SECOND_MS)).alias("event_time"),
        clock.wall_clock(clock.floor_ms(now, clock.SECOND_MS)).alias("ingest_time"),
        "tenant_id",
        "app_id",
        text.normalize(F.col("channel_id"), "unknown").alias("channel_id"),
        text.normalize(F.col("pay_method"), "unknown").alias("pay_method"),
        "amount_minor",
        clock.wall_clock(clock.floor_ms(now, clock.SECOND_MS)).alias("update_time"),
    ).where(
        F.col("event_id").isNotNull()
        & ~text.is_blank(F.col("tenant_id"))
        & ~text.is_blank(F.col("app_id"))
        & F.col("event_time").isNotNull()
        & F.col("amount_minor").isNotNull()
    )
    return conform(rows, S.RECOVERY_DETAIL)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast to an explicit column list.

    A required column that is absent fails at once; a null in one fails the write.
    """
    missing = [f.name for f in schema if f.name not in df.columns and not f.nullable]
    if missing:
        raise ValueError(f"required columns missing: {', '.join(missing)}")
    out = []
    for f in schema:
        c = F.col(f.name) if f.name in df.columns else F.lit(None)
        c = c.cast(f.dataType)
        if not f.nullable:
            c = F.coalesce(c, F.raise_error(F.lit(f"{f.name} is null")).cast(f.dataType))
        out.append(c.alias(f.name))
    return df.select(*out)


def with_defaults(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "currency": F.coalesce("currency", F.lit("CNY")),
            "data_quality_flag": F.coalesce("data_quality_flag", F.lit("normal")),
        }
    )


def quality_flags(df: DataFrame) -> DataFrame:
    """Add ``quality_issues``: names of all data-quality findings of the row."""
    amount = F.col("amount_minor")
    shifted = clock.is_shifted(
        F.col("event_time"), F.col("ingest_time"), F.col("data_quality_flag")
    )
    findings = [
        (amount == 0, "zero_amount"),
        (amount < 0, "negative_amount"),
        (amount >= S.HUGE_AMOUNT, "huge_amount"),
        (text.is_blank(F.col("channel_id")), "missing_channel"),
        (text.is_blank(F.col("region")), "missing_region"),
        (~F.coalesce(F.col("pay_method").isin(S.PAY_METHODS), F.lit(False)), "unknown_method"),
        (shifted, "clock_shift"),
    ]
    return df.withColumn(
        "quality_issues",
        F.array_compact(F.array(*[F.when(found, F.lit(name)) for found, name in findings])),
    )


def to_wire(df: DataFrame) -> DataFrame:
    """Event columns to one JSON text ``value`` without nulls, in wire order."""
    fields = [f for f in S.WIRE_FIELDS if f in df.columns]
    rest = [c for c in df.columns if c not in fields]
    return df.select(
        *rest, F.to_json(F.struct(*fields), {"ignoreNullFields": "true"}).alias("value")
    )


def to_topic_records(df: DataFrame) -> DataFrame:
    """Route each event to its topic and key: tenant and order, else tenant, else random."""
    topic = reduce(
        lambda acc, kv: acc.when(F.col("event_type") == kv[0], F.lit(kv[1])),
        S.TOPICS.items(),
        F.when(F.lit(False), F.lit("")),
    ).otherwise(F.lit(S.DEFAULT_TOPIC))
    order = F.col("order_id") if "order_id" in df.columns else F.lit(None).cast("string")
    key = (
        F.when(
            F.col("tenant_id").isNotNull() & order.isNotNull(),
            F.concat_ws("|", F.col("tenant_id"), order),
        )
        .when(F.col("tenant_id").isNotNull(), F.col("tenant_id"))
        .otherwise(F.uuid())
    )
    fields = [f for f in S.WIRE_FIELDS if f in df.columns]
    return df.select(
        topic.alias("topic"),
        key.alias("key"),
        F.to_json(F.struct(*fields), {"ignoreNullFields": "true"}).alias("value"),
    )


def flatten_rule(events: DataFrame) -> DataFrame:
    """Rule-change events with the nested payload as columns."""
    payload = F.from_json("rule_payload", S.RULE_PAYLOAD)
    return events.where(F.col("event_type") == S.RULE_CHANGE).select(
        "tenant_id",
        "rule_id",
        F.col("rule_version").cast("int").alias("rule_version"),
        "effective_time",
        "event_time",
        "ingest_time",
        payload.alias("_p"),
    ).select("*", "_p.*").drop("_p")


def to_rule_dim(rules: DataFrame, operator: str | None = None) -> DataFrame:
    """Flattened rule changes to the rule dimension, one row per tenant and version."""
    rows = rules.select(
        "tenant_id",
        "rule_version",
        "rule_id",
        clock.wall_clock(F.col("effective_time")).alias("effective_time"),
        F.coalesce("pay_method", F.lit("*")).alias("pay_method"),
        F.coalesce("channel_id", F.lit("*")).alias("channel_id"),
        "rate_type",
        "rate_pct",
        F.coalesce("fixed_fee", F.lit(0)).alias("fixed_fee"),
        "cap_amount",
        "floor_amount",
        clock.wall_clock(F.col("event_time")).alias("publish_time"),
        F.lit(operator).cast("string").alias("operator"),
        clock.wall_clock(F.col("ingest_time")).alias("create_time"),
    )
    return conform(latest_per_key(rows, ["tenant_id", "rule_version"], ["create_time"]), S.RULE_DIM)
