"""Views that read the given star-schema tables as payment, rule and usage events.

Each view takes DataFrames, so the same code serves batch frames and streams.
Column formulas are plain SQL shared with the checking queries; the row logic
(which event an order gives rise to) is built here with one pass over orders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream import schemas as S
from tillstream.functions import clock

# First day of the fixture data, 2024-01-01 in local time.
DAY0_MS = 1_704_038_400_000


def delay(m: str) -> str:
    """Arrival delay in ms as SQL, for a number ``m`` per row."""
    return (
        f"case when ({m}) % 1000 < 930 then (({m}) * 37) % 30000"
        f" when ({m}) % 1000 < 980 then 30000 + (({m}) * 37) % 570000"
        f" when ({m}) % 1000 < 995 then 600000 + (({m}) * 4001) % 21000000"
        f" else 21600000 + (({m}) * 40009) % 151200000 end"
    )


PAY_BASE = {
    "n": "o_orderkey",
    "ck": "o_custkey",
    "t": "cast(case when o_custkey % 10 < 3 then 1 else c_nationkey + 1 end as bigint)",
    "amount_minor": (
        "case when o_orderkey % 2000 = 17 then cast(0 as bigint)"
        " when o_orderkey % 5000 = 23 then cast(-100 as bigint)"
        " else cast(floor(o_totalprice * 100 + 0.5) as bigint) end"
    ),
    "event_time": (
        f"{DAY0_MS} + (o_orderkey % 3) * 86400000 + 86100000"
        " + ((o_orderkey * 7) % 10) * 60000 + (o_orderkey * 7919) % 60000"
    ),
    "pay_method": (
        "case when o_orderkey % 997 = 5 then 'unknown'"
        " else case substring(o_orderpriority, 1, 1) when '1' then 'wx' when '2' then 'alipay'"
        " when '3' then 'card' when '4' then 'h5' else 'quickpay' end end"
    ),
}

PAY = {
    "n": "n",
    "event_type": "'pay_success'",
    "tenant_id": "concat('T', lpad(cast(t as string), 4, '0'))",
    "app_id": (
        "concat('T', lpad(cast(t as string), 4, '0'), '_APP', cast(ck % 2 + 1 as string))"
    ),
    "order_id": "concat('ORD', lpad(cast(n as string), 12, '0'))",
    "payment_id": "concat('PAY', lpad(cast(n as string), 12, '0'))",
    "user_id": "concat('U_', cast(ck as string))",
    "idempotency_key": "concat('PAY_PAY', lpad(cast(n as string), 12, '0'))",
    "amount_minor": "amount_minor",
    "currency": "'CNY'",
    "channel_id": (
        "case when n % 331 = 0 then null"
        " else concat('ch_', cast((n * 31 + ck) % 6 as string)) end"
    ),
    "pay_method": "pay_method",
    "psp": "concat('psp_', cast(n % 3 as string))",
    "region": "case when n % 200 = 1 then null else concat('R', cast(n % 7 as string)) end",
    "event_time": "event_time",
    "ingest_time": f"event_time + {delay('n')}",
    "trace_id": "concat('TR', cast(n as string))",
    "data_quality_flag": "'normal'",
}

# Columns of the event view in order.
EVENT_COLUMNS = [
    "n", "event_type", "tenant_id", "app_id", "order_id", "payment_id", "refund_id",
    "chargeback_id", "adjust_id", "user_id", "idempotency_key", "amount_minor", "currency",
    "channel_id", "pay_method", "psp", "region", "ref_type", "adjust_reason", "refund_reason",
    "event_time", "ingest_time", "trace_id", "data_quality_flag",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _columns(df: DataFrame, exprs: dict[str, str]) -> DataFrame:
    return df.select(*[F.expr(sql).alias(name) for name, sql in exprs.items()])


def payments(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """One payment per order."""
    joined = orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority").join(
        customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey")
    )
    return _columns(_columns(joined, PAY_BASE), PAY)


def noisy(pay: DataFrame) -> DataFrame:
    """Payments, some with a clock eight hours ahead."""
    hit = F.col("n") % 500 == 4
    return pay.withColumns(
        {
            "event_time": F.when(hit, F.col("event_time") + clock.SHIFT_MS).otherwise(
                F.col("event_time")
            ),
            "data_quality_flag": F.when(hit, F.lit("suspect")).otherwise(
                F.col("data_quality_flag")
            ),
        }
    )


# What an order gives rise to, as the condition on its payment.
KINDS = {
    "pay": "true",
    "refund": "amount_minor > 0 and n % 40 = 3",
    "refund_2": "amount_minor > 0 and n % 40 = 3 and n % 80 <> 3",
    "chargeback": "amount_minor > 0 and n % 1000 = 9",
    "adjust": "amount_minor > 0 and n % 500 = 13 and n % 3 <> 1",
    "orphan": "amount_minor > 0 and n % 4000 = 21",
    "copy": "n % 200 = 7",
    "changed_copy": "n % 300 = 11",
    "replay": "n % 500 = 2",
}


def money_events(pay: DataFrame) -> DataFrame:
    """Payments with their refunds, chargebacks, adjustments, orphans, copies and replays.

    The kinds of each order are exploded and the columns follow from the kind:
    one pass over the orders, no union of branches.
    """
    kinds = F.array_compact(
        F.array(*[F.when(F.expr(rule), F.lit(k)) for k, rule in KINDS.items()])
    )
    # most orders are paid and nothing else; for them no list is filtered
    more = F.expr(" or ".join(f"({rule})" for k, rule in KINDS.items() if k != "pay"))
    rows = pay.select("*", F.explode(F.when(more, kinds).otherwise(F.array(F.lit("pay")))).alias("kind"))
    kind, n, amount, at = F.col("kind"), F.col("n"), F.col("amount_minor"), F.col("event_time")
    refund = kind.isin("refund", "refund_2", "orphan")
    back, adjust = kind == "chargeback", kind == "adjust"
    num = n.cast("string")
    half = F.floor(amount / 2.0).cast("long")
    refund_id = F.when(kind == "orphan", F.concat(F.lit("REFX"), num)).otherwise(
        F.concat(F.lit("REF"), num, F.when(kind == "refund_2", F.lit("_2")).otherwise(F.lit("")))
    )
    later = at + 60_000 + (n * 104_729) % 259_140_000
    event_time = (
        F.when(refund, later + F.when(kind == "refund_2", 1_800_000).otherwise(0))
        .when(back, at + 3_600_000 + (n * 104_729) % 601_200_000)
        .otherwise(at)
    )
    shift = F.when(refund, 17).when(back, 29).when(adjust, 5).otherwise(0)
    made = {
        "event_type": F.when(refund, S.REFUND)
        .when(back, S.CHARGEBACK)
        .when(adjust, S.ADJUST)
        .otherwise(S.PAY),
        "refund_id": F.when(refund, refund_id),
        "chargeback_id": F.when(back, F.concat(F.lit("CB"), num)),
        "adjust_id": F.when(adjust, F.concat(F.lit("ADJ"), num)),
        "idempotency_key": F.when(refund, F.concat(F.lit("REF_"), refund_id))
        .when(back, F.concat(F.lit("CB_CB"), num))
        .when(adjust, F.concat(F.lit("ADJ_ADJ"), num))
        .otherwise(F.col("idempotency_key")),
        "payment_id": F.when(kind == "orphan", F.concat(F.lit("PAY_MISSING_"), num)).when(
            ~adjust, F.col("payment_id")
        ),
        "amount_minor": F.when((kind == "refund") & (n % 80 == 3), -amount)
        .when(kind == "refund", -half)
        .when(kind == "refund_2", -(amount - half))
        .when(back | (kind == "orphan"), -amount)
        .when(adjust, (n % 3 - 1) * (100 + n % 50_000))
        .otherwise(amount),
        "ref_type": F.when(adjust, F.lit("none")),
        "adjust_reason": F.when(adjust, F.lit("manual_adjustment")),
        "refund_reason": F.when(refund, F.lit("user_request")),
        "event_time": event_time,
        "trace_id": F.when(kind == "changed_copy", F.concat(F.lit("TRX"), num)).otherwise(
            F.col("trace_id")
        ),
    } | {
        c: F.when(~adjust, F.col(c))
        for c in ("order_id", "channel_id", "pay_method", "psp", "region")
    }
    rows = rows.withColumns({"_event_time": event_time, "_m": n + shift})
    extra = F.when(kind == "changed_copy", 2_500).when(kind == "replay", 600_000).otherwise(0)
    made["event_time"] = F.col("_event_time")
    made["ingest_time"] = F.col("_event_time") + F.expr(delay("_m")) + extra
    event = F.struct(*[made.get(c, F.col(c)).alias(c) for c in EVENT_COLUMNS])
    # The generator keeps later filters from repeating the formulas above.
    return rows.select(event.alias("e")).select(F.inline(F.array("e")))


def rules(nation: DataFrame) -> DataFrame:
    """Three rule versions per tenant; some tenants have none, some miss the first."""
    versions = nation.select(
        (F.col("n_nationkey") + 1).cast("long").alias("t"),
        F.explode(F.array(*[F.lit(v).cast("long") for v in (1, 2, 3)])).alias("v"),
    ).where("t % 5 <> 0 and not (t % 7 = 0 and v = 1)")
    return _columns(versions, RULE_BASE).select(
        "*", F.expr("effective_time - 300000 + (t % 3) * 600000").alias("ingest_time")
    ).drop("t", "v")


RULE_BASE = {
    "t": "t",
    "v": "v",
    "tenant_id": "concat('T', lpad(cast(t as string), 4, '0'))",
    "rule_version": "cast(t * 10 + v as int)",
    "effective_time": (
        f"cast({DAY0_MS} + case v when 1 then 0 when 2 then 86400000 + 86280000"
        " else 2 * 86400000 + 86340000 end as bigint)"
    ),
    "rate_type": "'percent'",
    "rate_pct": "cast(100 + (t * 37 + v * 13) % 400 as double) / 10000",
    "fixed_fee": "case when (t + v) % 3 = 0 then (t * 11) % 500 else 0 end",
    "floor_amount": "case when t % 3 = 0 then 100 else 0 end",
    "cap_amount": "cast(500000 as bigint)",
    "pay_method": "'*'",
    "channel_id": "'*'",
}

# Rule-change events, one per supplier: this history grows with the data.
CHANGE = {
    "k": "s_suppkey",
    "event_type": "'take_rate_rule_change'",
    "tenant_id": "concat('T', lpad(cast(s_nationkey + 1 as string), 4, '0'))",
    "rule_id": "concat('RULE_', cast(s_suppkey + 1 as string))",
    "rule_version": "cast(s_suppkey + 1 as int)",
    "effective_time": f"cast({DAY0_MS} + (s_suppkey * 7919000) % 345600000 as bigint)",
    "rate_type": "case s_suppkey % 5 when 3 then 'fixed' when 4 then 'tiered' else 'percent' end",
    "rate_pct": "cast(100 + (s_suppkey * 13) % 400 as double) / 10000",
    "fixed_fee": "case when s_suppkey % 5 >= 2 then cast(50 + s_suppkey % 400 as bigint) else cast(0 as bigint) end",
    "cap_amount": "cast(500000 as bigint)",
    "floor_amount": "case when s_suppkey % 3 = 0 then cast(100 as bigint) else cast(0 as bigint) end",
    "pay_method": "case s_suppkey % 4 when 1 then 'wx' when 2 then 'alipay' else '*' end",
    "channel_id": "case when s_suppkey % 3 = 1 then 'ch_1' else '*' end",
}


def rule_changes(supplier: DataFrame) -> DataFrame:
    """Flat rule changes with publish time (``event_time``) and arrival time."""
    base = _columns(supplier, CHANGE)
    published = base.withColumn("event_time", F.expr("effective_time - (k * 131071) % 3600000"))
    return published.withColumn(
        "ingest_time",
        F.expr(
            "case when k % 10 < 3 then effective_time + (k * 791900) % 1800000"
            " else event_time + (k * 37) % 30000 end"
        ),
    )


def rule_change_events(supplier: DataFrame) -> DataFrame:
    """The same changes as events with the nested payload as JSON text."""
    flat = rule_changes(supplier)
    payload = [f.name for f in S.RULE_PAYLOAD]
    return flat.select(
        "event_type", "tenant_id", "rule_id", "rule_version", "effective_time",
        F.to_json(F.struct(*payload)).alias("rule_payload"), "event_time", "ingest_time",
    )


USAGE = {
    "event_id": "event_id",
    "user_id": "user_id",
    "kind": "event_type",
    "tenant_id": "concat('T', lpad(cast(user_id % 10 + 1 as string), 4, '0'))",
    "ip": "concat('10.0.0.', cast(user_id % 7 as string))",
    "amount_minor": "cast(floor(value * 100 + 0.5) as bigint)",
}


def usage(events: DataFrame) -> DataFrame:
    """Risk and billing events: payments, registrations, failures and calls."""
    device = F.concat(F.lit("D"), F.get_json_object("props", "$.k"))
    return events.select(
        *[F.expr(sql).alias(name) for name, sql in USAGE.items()],
        device.alias("device_id"),
        clock.ntz_to_ms(F.col("ts")).alias("event_time"),
    ).withColumn("ingest_time", F.col("event_time") + F.expr(delay("event_id")))


# Quota versions, ten per tenant and hundred suppliers.
QUOTA = {
    "tenant_id": "concat('T', lpad(cast(s_suppkey % 10 + 1 as string), 4, '0'))",
    "version": "cast(s_suppkey + 1 as int)",
    "quota_per_hour": "1 + s_suppkey % 3",
    "effective_time": f"cast({DAY0_MS} + (s_suppkey * 86400000) / 4 as bigint)",
}


def quotas(supplier: DataFrame) -> DataFrame:
    return _columns(supplier, QUOTA)


def usage_with_replays(used: DataFrame) -> DataFrame:
    """Usage where every 50th record was delivered twice."""
    copies = F.when(F.col("event_id") % 50 == 3, F.array(F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(0))
    )
    return used.select("*", F.explode(copies).alias("delivery"))


# Views by table folder, for the registered queries.
def a_pay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payments(table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer"))


def a_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return money_events(a_pay(spark, sf_dir))


def a_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules(table(spark, sf_dir, "nation"))


def a_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_changes(table(spark, sf_dir, "supplier"))


def a_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return usage(table(spark, sf_dir, "events"))


def a_quotas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotas(table(spark, sf_dir, "supplier"))
