"""Minute, hour and day settlement."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream import schemas as S
from tillstream.functions import clock, text
from tillstream.operators.ingest import conform
from tillstream.operators.skew import two_stage

_GMV_KEYS = ["tenant_id", "app_id", "channel_id", "pay_method"]


def _labelled(agg: DataFrame, keys: list[str], metrics: list[str]) -> DataFrame:
    minute = F.col("minute_ms")
    return agg.select(
        clock.stat_date(minute).alias("stat_date"),
        clock.wall_clock(minute).alias("stat_minute"),
        *keys,
        *metrics,
    )


def minute_gmv(valid: DataFrame, salt: int = 0, salt_by: str = "payment_id") -> DataFrame:
    """Count, amount and net of payments per minute, tenant, app, channel and method.

    ``salt`` > 1 aggregates over ``salt`` parts of each key first and merges
    them; the totals are the same.
    """
    rows = valid.withColumn("minute_ms", clock.floor_ms(F.col("event_time"), clock.MINUTE_MS))
    keys = ["minute_ms", *_GMV_KEYS]
    sums = {"pay_count": F.lit(1).cast("bigint"), "pay_amount": F.col("amount_minor")}
    if salt > 1:
        agg = two_stage(rows, keys, sums, salt, F.col(salt_by))
    else:
        agg = rows.groupBy(*keys).agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    agg = agg.withColumn("net_amount", F.col("pay_amount"))
    return _labelled(agg, _GMV_KEYS, ["pay_count", "pay_amount", "net_amount"])


def to_minute_table(minute: DataFrame, now_ms: int | Column) -> DataFrame:
    """Minute GMV rows as they are stored, with the time of their last change."""
    now = now_ms if isinstance(now_ms, Column) else F.lit(now_ms).cast("long")
    return conform(minute.withColumn("update_time", clock.wall_clock(now)), S.MINUTE_GMV)


def increments(event_type: Column, amount: Column) -> dict[str, Column]:
    """What one event adds to each settlement metric."""
    def when(kind: str, value: Column) -> Column:
        return F.when(event_type == kind, value).otherwise(F.lit(0)).cast("bigint")

    one = F.lit(1)
    pay, refund = when(S.PAY, amount), when(S.REFUND, F.abs(amount))
    back, adjust = when(S.CHARGEBACK, F.abs(amount)), when(S.ADJUST, amount)
    return {
        "pay_count": when(S.PAY, one),
        "pay_amount": pay,
        "refund_count": when(S.REFUND, one),
        "refund_amount": refund,
        "chargeback_count": when(S.CHARGEBACK, one),
        "chargeback_amount": back,
        "adjust_count": when(S.ADJUST, one),
        "adjust_amount": adjust,
        "net_amount": pay - refund - back + adjust,
    }


def to_increments(events: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One increment model for all four event types; blank dimensions get their default."""
    made = increments(F.col("event_type"), F.col("amount_minor"))
    has_fee = "take_rate_amount" in events.columns
    fee = F.col("take_rate_amount") if has_fee else F.lit(0)
    settled = F.col("settlement_amount") if has_fee else F.lit(0)
    return events.select(
        *keep,
        clock.floor_ms(F.col("event_time"), clock.MINUTE_MS).alias("minute_ms"),
        "tenant_id",
        "app_id",
        text.normalize(F.col("channel_id"), "unknown_channel").alias("channel_id"),
        text.normalize(F.col("pay_method"), "unknown_pay_method").alias("pay_method"),
        *[c.alias(n) for n, c in made.items()],
        F.coalesce(fee, F.lit(0)).cast("bigint").alias("take_rate_total"),
        F.coalesce(settled, F.lit(0)).cast("bigint").alias("settlement_total"),
    )


def minute_settlement(events: DataFrame) -> DataFrame:
    """All settlement metrics per minute and the four dimensions."""
    return add_increments(to_increments(events))


def add_increments(increments: DataFrame) -> DataFrame:
    """Minute rows from rows of :func:`to_increments`, which may be signed."""
    agg = increments.groupBy("minute_ms", *_GMV_KEYS).agg(
        *[F.sum(m).alias(m) for m in S.SETTLEMENT_METRICS]
    )
    return _labelled(agg, _GMV_KEYS, S.SETTLEMENT_METRICS)


def hour_settlement(minute: DataFrame) -> DataFrame:
    return minute.groupBy(
        "stat_date", F.hour("stat_minute").alias("stat_hour"), "tenant_id", "app_id"
    ).agg(*[F.sum(m).alias(m) for m in S.SETTLEMENT_METRICS])


def tenant_daily_summary(minute: DataFrame) -> DataFrame:
    return minute.groupBy("stat_date", "tenant_id").agg(
        *[F.sum(m).alias(m) for m in S.SETTLEMENT_METRICS]
    )


def rebuild_minutes(events: DataFrame, days: list[str]) -> DataFrame:
    """Minute rows of whole days again from deduplicated events: the exact repair."""
    wanted = [F.to_date(F.lit(d)) for d in days]
    on_days = events.where(clock.stat_date(F.col("event_time")).isin(wanted))
    return minute_settlement(on_days)


def recent_minutes(minute: DataFrame, day: str, n: int = 30) -> DataFrame:
    """Totals of the last ``n`` minutes of a day, newest first."""
    metrics = [m for m in ("net_amount", "pay_amount", "pay_count") if m in minute.columns]
    return (
        minute.where(F.col("stat_date") == F.to_date(F.lit(day)))
        .groupBy("stat_minute")
        .agg(*[F.sum(m).alias(m) for m in metrics])
        .orderBy(F.desc("stat_minute"))
        .limit(n)
    )


def recent_lines(minute: DataFrame, day: str, n: int = 50, by: str = "stat_minute") -> DataFrame:
    """The last ``n`` aggregate lines of a day by minute or update time."""
    return (
        minute.where(F.col("stat_date") == F.to_date(F.lit(day)))
        .orderBy(F.desc(by), "stat_minute", *_GMV_KEYS)
        .limit(n)
    )
