"""Data profiles: skew, keys, freshness, delays, disorder, rates, amounts, duplicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream import schemas as S
from tillstream.functions import clock, money
from tillstream.operators.ordered import quantiles, running
from tillstream.operators.skew import salted_join


def dirty_summary(dirty: DataFrame) -> DataFrame:
    return (
        dirty.groupBy("dirty_reason")
        .agg(F.count("*").alias("cnt"))
        .orderBy(F.desc("cnt"), "dirty_reason")
    )


def audit_sample(df: DataFrame, key: str, n: int = 100) -> DataFrame:
    """``n`` keys in the order of their hash: random, yet the same on every run."""
    return df.select(key).orderBy(F.md5(key), key).limit(n)


def _counts(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("cnt"))


def skew_profile(df: DataFrame, key: str) -> DataFrame:
    """Rows and share per key; the total is a scalar subquery, not a global window."""
    counts = _counts(df, key)
    total = counts.agg(F.sum("cnt")).scalar()
    return counts.select(key, "cnt", money.ppm(F.col("cnt"), total).alias("share_ppm"))


def skew_summary(df: DataFrame, key: str) -> DataFrame:
    """One row: keys, rows, share of the largest key and of the five largest."""
    counts = _counts(df, key)
    ranked = counts.orderBy(F.desc("cnt"), key)
    top1 = ranked.limit(1).agg(F.sum("cnt")).scalar()
    top5 = ranked.limit(5).agg(F.sum("cnt")).scalar()
    return counts.agg(F.count("*").alias("keys"), F.sum("cnt").alias("total")).select(
        "keys",
        "total",
        money.ppm(top1, F.col("total")).alias("top1_ppm"),
        money.ppm(top5, F.col("total")).alias("top5_ppm"),
    )


def top_k(df: DataFrame, key: str, k: int = 5, amount: str | None = None) -> DataFrame:
    """The ``k`` keys with the most rows, optionally with their total in yuan."""
    aggs = [F.count("*").alias("cnt")]
    if amount:
        aggs.append(money.yuan(F.sum(amount)).alias("total_yuan"))
    return df.groupBy(key).agg(*aggs).orderBy(F.desc("cnt"), key).limit(k)


def duplicate_keys(df: DataFrame, key: str, n: int = 20) -> DataFrame:
    return _counts(df, key).where("cnt > 1").orderBy(F.desc("cnt"), key).limit(n)


def key_uniqueness(df: DataFrame, key: str) -> DataFrame:
    """Rows against distinct keys, from counts per key."""
    return _counts(df, key).agg(
        F.sum("cnt").alias("total_rows"), F.count(key).alias("distinct_keys")
    )


def type_totals(df: DataFrame) -> DataFrame:
    return df.groupBy("event_type").agg(
        F.count("*").alias("cnt"), money.yuan(F.sum("amount_minor")).alias("total_yuan")
    )


def daily_counts(df: DataFrame) -> DataFrame:
    return (
        df.groupBy(clock.stat_date(F.col("event_time")).alias("event_date"))
        .agg(F.count("*").alias("cnt"))
        .orderBy(F.desc("event_date"))
    )


def table_health(tables: dict[str, tuple[DataFrame, str, str | None]]) -> DataFrame:
    """Rows, total yuan, first and last time per table.

    ``tables`` maps a name to (frame, time column in epoch ms, amount column or None).
    """
    parts = []
    for name, (df, time_col, amount_col) in tables.items():
        aggs = [
            F.count("*").alias("cnt"),
            clock.wall_clock(F.min(time_col)).alias("earliest"),
            clock.wall_clock(F.max(time_col)).alias("latest"),
        ]
        if amount_col:
            aggs.append(money.yuan(F.sum(amount_col)).alias("total_yuan"))
        parts.append(df.agg(*aggs).withColumn("tbl", F.lit(name)))
    health = parts[0]
    for part in parts[1:]:
        health = health.unionByName(part, allowMissingColumns=True)
    return health


def hourly_distribution(df: DataFrame, now_ms: int, hours: int = 6) -> DataFrame:
    recent = df.where(clock.since(F.col("event_time"), now_ms, hours))
    hour = clock.floor_ms(F.col("event_time"), clock.HOUR_MS)
    agg = recent.groupBy(hour.alias("_hour")).agg(
        F.count("*").alias("cnt"), money.yuan(F.sum("amount_minor")).alias("total_yuan")
    )
    return agg.select(
        clock.wall_clock(F.col("_hour")).alias("hour_bucket"), "cnt", "total_yuan"
    ).orderBy("hour_bucket")


def topic_counts(records: DataFrame) -> DataFrame:
    return records.groupBy("topic").agg(
        F.count("*").alias("events"), F.count("key").alias("keyed")
    )


def delay_profile(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows per arrival-delay tier, with the smallest and largest delay."""
    event, ingest = F.col("event_time"), F.col("ingest_time")
    return df.groupBy(*by, clock.delay_tier(event, ingest).alias("tier")).agg(
        F.count("*").alias("cnt"),
        F.min(ingest - event).alias("min_delay"),
        F.max(ingest - event).alias("max_delay"),
    )


def delay_quantiles(
    df: DataFrame, by: Sequence[str], percents: Sequence[int] = (50, 90, 99)
) -> DataFrame:
    delays = df.withColumn("delay_ms", F.col("ingest_time") - F.col("event_time"))
    return quantiles(delays, by, "delay_ms", percents)


def disorder_profile(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Share of rows whose event time is before that of a row which arrived earlier.

    Rows that arrive in the same millisecond do not count as earlier.
    """
    by = list(by)
    rows = df.groupBy(*by, "ingest_time", "event_time").agg(F.count("*").alias("cnt"))
    seen = running(df, by, "ingest_time", {"latest": (F.col("event_time"), "max")}).select(
        *by, "ingest_time", "latest_before"
    )
    behind = F.col("event_time") < F.col("latest_before")
    joined = salted_join(rows, seen, [*by, "ingest_time"])
    agg = joined.groupBy(*by).agg(
        F.sum("cnt").alias("events"),
        F.coalesce(F.sum(F.when(behind, F.col("cnt"))), F.lit(0)).alias("disordered"),
        F.coalesce(
            F.max(F.when(behind, F.col("latest_before") - F.col("event_time"))), F.lit(0)
        ).alias("max_lag_ms"),
    )
    return agg.withColumn("disorder_ppm", money.ppm(F.col("disordered"), F.col("events")))


# Fixed value: a refund rate above 3 % is outside the normal range.
REFUND_BASELINE_PPM = 30_000


def refund_rates(
    events: DataFrame, by: Sequence[str], baseline_ppm: int = REFUND_BASELINE_PPM
) -> DataFrame:
    """Refund and chargeback counts against payments, flagged above the baseline."""
    kind = F.col("event_type")
    agg = events.groupBy(*by).agg(
        F.count_if(kind == S.PAY).alias("pay_count"),
        F.count_if(kind == S.REFUND).alias("refund_count"),
        F.count_if(kind == S.CHARGEBACK).alias("chargeback_count"),
    )
    rate = F.coalesce(money.ppm(F.col("refund_count"), F.col("pay_count")), F.lit(0))
    back = F.coalesce(money.ppm(F.col("chargeback_count"), F.col("pay_count")), F.lit(0))
    return agg.select(
        "*",
        rate.alias("refund_ppm"),
        back.alias("chargeback_ppm"),
        (rate > baseline_ppm).alias("above_baseline"),
    )


def failure_rates(events: DataFrame, by: Sequence[str], ok: str, failed: str) -> DataFrame:
    """Failed against all payment attempts, for events with a ``kind``."""
    agg = events.where(F.col("kind").isin(ok, failed)).groupBy(*by).agg(
        F.count("*").alias("attempts"), F.count_if(F.col("kind") == failed).alias("failures")
    )
    return agg.withColumn("failure_ppm", money.ppm(F.col("failures"), F.col("attempts")))


def amount_class(amount: Column) -> Column:
    return (
        F.when(amount == 0, F.lit("zero"))
        .when(amount < 0, F.lit("negative"))
        .when(amount >= S.HUGE_AMOUNT, F.lit("huge"))
        .when(amount.isin(S.COMMON_AMOUNTS), F.lit("common"))
        .otherwise(F.lit("custom"))
    )


def amount_profile(df: DataFrame) -> DataFrame:
    """Rows and share per amount class."""
    counts = _counts(
        df.select(amount_class(F.col("amount_minor")).alias("amount_class")), "amount_class"
    )
    total = counts.agg(F.sum("cnt")).scalar()
    return counts.select(
        "amount_class", "cnt", money.ppm(F.col("cnt"), total).alias("share_ppm")
    )


def duplicate_profile(df: DataFrame, key: str, content: Sequence[str], by: str) -> DataFrame:
    """Copies per ``by``: exact ones, later replays of equal content, changed ones.

    Three nested counts, each merged before its shuffle: rows per (key, content,
    arrival), arrivals per (key, content), contents per key.
    """
    full = df.groupBy(by, key, *content, "ingest_time").agg(F.count("*").alias("rows"))
    arrivals = full.groupBy(by, key, *content).agg(
        F.sum("rows").alias("rows"), F.count("*").alias("arrivals")
    )
    keys = arrivals.groupBy(by, key).agg(
        F.sum("rows").alias("rows"),
        F.sum("arrivals").alias("arrivals"),
        F.count("*").alias("contents"),
    )
    return keys.groupBy(by).agg(
        F.count("*").alias("keys"),
        F.sum("rows").alias("total_rows"),
        F.count_if(F.col("rows") > 1).alias("repeated_keys"),
        F.sum(F.col("rows") - F.col("arrivals")).alias("exact_copies"),
        F.sum(F.col("arrivals") - F.col("contents")).alias("replays"),
        F.sum(F.col("contents") - 1).alias("changed_copies"),
    )


def lifecycle_violations(events: DataFrame) -> DataFrame:
    """Orders and payments whose events break the order lifecycle, one row per finding."""
    kind, amount, at = F.col("event_type"), F.col("amount_minor"), F.col("event_time")
    pay, fix = kind == S.PAY, kind.isin(S.REFUND, S.CHARGEBACK)
    orders = (
        events.where(pay & F.col("order_id").isNotNull())
        .groupBy(F.col("order_id").alias("subject"))
        .agg(
            F.count("*").alias("successes"),
            (F.min("payment_id") != F.max("payment_id")).alias("mixed"),
        )
    )
    by_order = F.array(
        F.when(F.col("successes") > 1, F.lit("several_successes")),
        F.when(F.col("mixed"), F.lit("several_payments")),
    )
    payments = (
        events.where((pay | fix) & F.col("payment_id").isNotNull())
        .groupBy(F.col("payment_id").alias("subject"))
        .agg(
            F.max(F.when(pay, amount)).alias("paid"),
            F.min(F.when(pay, at)).alias("paid_at"),
            F.sum(F.when(kind == S.REFUND, -amount)).alias("refunded"),
            F.min(F.when(fix, at)).alias("first_fix"),
        )
    )
    by_payment = F.array(
        F.when(F.col("first_fix").isNotNull() & F.col("paid").isNull(), F.lit("no_payment")),
        F.when(F.col("refunded") > F.col("paid"), F.lit("refund_above_paid")),
        F.when(F.col("first_fix") < F.col("paid_at"), F.lit("correction_before_payment")),
    )
    return orders.select(
        "subject", F.explode(F.array_compact(by_order)).alias("violation")
    ).unionByName(
        payments.select("subject", F.explode(F.array_compact(by_payment)).alias("violation"))
    )


def in_arrival_order(df: DataFrame, tie: str) -> DataFrame:
    """Rows by arrival time, missing times first (a range-partitioned sort)."""
    return df.orderBy(F.coalesce("ingest_time", F.lit(0)), tie)
