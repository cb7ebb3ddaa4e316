"""Tenant billing and quota control."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstream.functions import clock
from tillstream.operators.asof import asof_lookup
from tillstream.operators.ordered import latest_per_key, running
from tillstream.operators.skew import lookup_join

# Billing item of each usage kind.
ITEMS = {
    "purchase": "success",
    "click": "api",
    "error": "risk",
    "view": "report",
    "signup": "push",
}


def billable(usage: DataFrame, key: str = "event_id") -> DataFrame:
    """Usage once per billing key, with its item and local day."""
    once = latest_per_key(usage, [key], ["event_time"])
    item = F.create_map(*[F.lit(x) for pair in ITEMS.items() for x in pair])[F.col("kind")]
    return once.withColumns(
        {"item": item, "dt": clock.stat_date(F.col("event_time"))}
    )


def tenant_daily_bill(billed: DataFrame) -> DataFrame:
    """Counts by billing item and the paid amount, per tenant and day."""
    item = F.col("item")
    return billed.groupBy("tenant_id", "dt").agg(
        *[F.count_if(item == i).alias(f"{i}_count") for i in ITEMS.values()],
        F.coalesce(F.sum(F.when(item == "success", F.col("amount_minor"))), F.lit(0)).alias(
            "success_amount"
        ),
    )


BILL_METRICS = [f"{i}_count" for i in ITEMS.values()] + ["success_amount"]


def _month() -> Column:
    return F.substring(F.col("dt").cast("string"), 1, 7)


def monthly_bill(daily: DataFrame) -> DataFrame:
    return daily.groupBy("tenant_id", _month().alias("month")).agg(*[F.sum(m).alias(m) for m in BILL_METRICS])


def month_to_date(daily: DataFrame) -> DataFrame:
    """Daily bill with running month totals; a window holds at most 31 rows."""
    w = (
        Window.partitionBy("tenant_id", _month())
        .orderBy("dt")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    return daily.select(
        "tenant_id", "dt", *BILL_METRICS, *[F.sum(m).over(w).alias(f"mtd_{m}") for m in BILL_METRICS]
    )


def bill_trace(lines: DataFrame, billed: DataFrame) -> DataFrame:
    """Usage records behind disputed bill lines (tenant, day, item)."""
    on = ["tenant_id", "dt", "item"]
    return lookup_join(billed, lines.select(*on).distinct(), on, "left_semi", derived=True)


def verify_bill(bill: DataFrame, usage: DataFrame, share_hex: str = "40") -> DataFrame:
    """Recount a hashed sample of tenant-days from raw usage and compare.

    The recount takes distinct billing keys instead of the deduplicated table.
    ``share_hex`` is the upper bound of the first hash byte: ``40`` samples a quarter.
    """
    chosen = F.substring(
        F.md5(F.concat_ws("|", F.col("tenant_id"), F.col("dt").cast("string"))), 1, 2
    ) < F.lit(share_hex)
    raw = usage.withColumn("dt", clock.stat_date(F.col("event_time"))).where(chosen)
    keys = raw.groupBy("tenant_id", "dt", "kind", "event_id").agg(
        F.max("amount_minor").alias("amount_minor")
    )
    again = keys.groupBy("tenant_id", "dt").agg(
        F.count("*").alias("recounted"),
        F.coalesce(
            F.sum(F.when(F.col("kind") == "purchase", F.col("amount_minor"))), F.lit(0)
        ).alias("recounted_amount"),
    )
    total = sum((F.col(f"{i}_count") for i in ITEMS.values()), F.lit(0))
    stated = bill.where(chosen).select(
        "tenant_id", "dt", total.alias("billed"), F.col("success_amount").alias("billed_amount")
    )
    both = stated.unionByName(again, allowMissingColumns=True).groupBy("tenant_id", "dt").agg(
        *[
            F.coalesce(F.sum(c), F.lit(0)).alias(c)
            for c in ("billed", "recounted", "billed_amount", "recounted_amount")
        ]
    )
    agrees = (F.col("billed") == F.col("recounted")) & (
        F.col("billed_amount") == F.col("recounted_amount")
    )
    return both.withColumn("agrees", agrees)


def usage_rates(usage: DataFrame, width_ms: int = clock.MINUTE_MS) -> DataFrame:
    """Calls, paid amount and per-second peak per tenant and window."""
    second = clock.floor_ms(F.col("event_time"), clock.SECOND_MS)
    paid = F.when(F.col("kind") == "purchase", F.col("amount_minor")).otherwise(F.lit(0))
    seconds = usage.groupBy("tenant_id", second.alias("second_ms")).agg(
        F.count("*").alias("calls"), F.sum(paid).alias("amount")
    )
    return seconds.groupBy(
        "tenant_id", clock.floor_ms(F.col("second_ms"), width_ms).alias("window_start")
    ).agg(
        F.sum("calls").alias("calls"),
        F.max("calls").alias("peak_per_second"),
        F.sum("amount").alias("amount"),
    )


def hourly_usage(usage: DataFrame) -> DataFrame:
    hour = clock.floor_ms(F.col("event_time"), clock.HOUR_MS)
    return usage.groupBy("tenant_id", hour.alias("window_start")).agg(
        F.count("*").alias("used")
    )


def with_quota(usage: DataFrame, quota: DataFrame, at: str = "window_start") -> DataFrame:
    """Quota in force at ``at`` as ``quota_per_hour`` and ``quota_version``; none is null."""
    found = asof_lookup(
        usage, quota, ["tenant_id"], at, "effective_time", "_quota", "version"
    )
    return found.select(
        *usage.columns,
        F.col("_quota.quota_per_hour").alias("quota_per_hour"),
        F.col("_quota.version").alias("quota_version"),
    )


def first_crossing(usage: DataFrame, quota: DataFrame) -> DataFrame:
    """Time at which a tenant first went over its hourly quota, per hour."""
    hours = usage.withColumn(
        "window_start", clock.floor_ms(F.col("event_time"), clock.HOUR_MS)
    )
    counts = running(
        hours, ["tenant_id", "window_start"], "event_time", {"used": (F.lit(1), "sum")}
    )
    limited = with_quota(counts, quota)
    return (
        limited.where(F.col("used_upto") > F.col("quota_per_hour"))
        .groupBy("tenant_id", "window_start", "quota_per_hour", "quota_version")
        .agg(F.min("event_time").alias("crossed_at"), F.min("used_upto").alias("used_then"))
    )


def throttle_events(usage: DataFrame, quota: DataFrame) -> DataFrame:
    """One throttle command per tenant and hour above quota, with a stable id."""
    return over_quota(hourly_usage(usage), quota)


def over_quota(counted: DataFrame, quota: DataFrame) -> DataFrame:
    """Throttle commands for hourly counts (tenant, window_start, used)."""
    over = with_quota(counted, quota).where(
        F.col("used") > F.col("quota_per_hour")
    )
    return over.select(
        throttle_id(F.col("tenant_id"), F.col("window_start")).alias("event_id"),
        F.lit("tenant_throttle").alias("event_type"),
        "tenant_id",
        "window_start",
        "used",
        "quota_per_hour",
        "quota_version",
    )


def throttle_id(tenant: Column, start: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit("throttle"), tenant, start), 256)


def bill_lines(bill: DataFrame, items: Sequence[str] = tuple(ITEMS.values())) -> DataFrame:
    """The bill as one row per tenant, day and item."""
    pairs = ", ".join(f"'{i}', {i}_count" for i in items)
    return bill.selectExpr(
        "tenant_id", "dt", f"stack({len(items)}, {pairs}) as (item, quantity)"
    ).where("quantity > 0")
