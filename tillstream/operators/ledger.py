"""Ledger: unsigned legs per event, tenant-day summary, totals and the check against them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream import schemas as S
from tillstream.functions import clock, money

METRICS = [
    "pay_count", "gmv", "refund_count", "refund_amount", "chargeback_count",
    "chargeback_amount", "adjust_count", "adjust_amount", "net_in", "platform_fee",
    "platform_fee_refund", "platform_fee_chargeback", "total_platform_fee", "tenant_settle",
]


def to_ledger(settled: DataFrame) -> DataFrame:
    """Ledger rows: corrections positive, adjustments with their sign."""
    fix = F.col("event_type").isin(S.REFUND, S.CHARGEBACK)
    flip = F.when(fix, F.lit(-1)).otherwise(F.lit(1))
    return settled.select(
        "tenant_id",
        "app_id",
        "order_id",
        "payment_id",
        "event_type",
        (F.col("amount_minor") * flip).alias("amount_minor"),
        F.coalesce("take_rate_rule_version", F.lit(0)).alias("rule_version"),
        F.coalesce("take_rate_pct", F.lit(0.0)).alias("rate_pct"),
        (F.col("take_rate_amount") * flip).alias("platform_fee"),
        (F.col("settlement_amount") * flip).alias("settlement_amount"),
        "event_time",
        clock.stat_date(F.col("event_time")).alias("date"),
    )


def ledger_summary(ledger: DataFrame) -> DataFrame:
    kind = F.col("event_type")

    def total(event: str, column: str):
        return F.coalesce(F.sum(F.when(kind == event, F.col(column))), F.lit(0))

    sums = ledger.groupBy("tenant_id", "date").agg(
        F.count_if(kind == S.PAY).alias("pay_count"),
        total(S.PAY, "amount_minor").alias("gmv"),
        F.count_if(kind == S.REFUND).alias("refund_count"),
        total(S.REFUND, "amount_minor").alias("refund_amount"),
        F.count_if(kind == S.CHARGEBACK).alias("chargeback_count"),
        total(S.CHARGEBACK, "amount_minor").alias("chargeback_amount"),
        F.count_if(kind == S.ADJUST).alias("adjust_count"),
        total(S.ADJUST, "amount_minor").alias("adjust_amount"),
        total(S.PAY, "platform_fee").alias("platform_fee"),
        total(S.REFUND, "platform_fee").alias("platform_fee_refund"),
        total(S.CHARGEBACK, "platform_fee").alias("platform_fee_chargeback"),
    )
    derived = sums.withColumns(
        {
            "net_in": F.expr("gmv - refund_amount - chargeback_amount + adjust_amount"),
            "total_platform_fee": F.expr(
                "platform_fee - platform_fee_refund - platform_fee_chargeback"
            ),
        }
    ).withColumn("tenant_settle", F.expr("net_in - total_platform_fee"))
    return derived.select("tenant_id", "date", *METRICS)


def ledger_totals(summary: DataFrame) -> DataFrame:
    """One row of grand totals in cents and yuan."""
    names = {
        "gmv": "gmv",
        "refund": "refund_amount",
        "chargeback": "chargeback_amount",
        "adjust": "adjust_amount",
        "platform_fee": "total_platform_fee",
        "net_in": "net_in",
    }
    totals = summary.agg(*[F.sum(c).alias(f"total_{n}") for n, c in names.items()])
    return totals.select(
        "*", *[money.yuan(F.col(f"total_{n}")).alias(f"total_{n}_yuan") for n in names]
    )


def verify_ledger(truth: DataFrame, got: DataFrame) -> DataFrame:
    """Every metric of every tenant-day that differs; a missing side counts as null.

    Both sides are stacked and merged by one aggregate instead of an outer join.
    """
    def side(df: DataFrame, name: str, other: str) -> DataFrame:
        pairs = ", ".join(f"'{m}', cast({m} as bigint)" for m in METRICS)
        return df.selectExpr(
            "tenant_id", "date", f"stack({len(METRICS)}, {pairs}) as (metric, {name})"
        ).withColumn(other, F.lit(None).cast("bigint"))

    both = side(truth, "expected", "actual").unionByName(side(got, "actual", "expected"))
    merged = both.groupBy("tenant_id", "date", "metric").agg(
        F.max("expected").alias("expected"), F.max("actual").alias("actual")
    )
    return merged.withColumn(
        "difference", F.coalesce("expected", F.lit(0)) - F.coalesce("actual", F.lit(0))
    ).where(~F.col("expected").eqNullSafe(F.col("actual")))
