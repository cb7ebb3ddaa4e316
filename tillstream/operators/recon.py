"""Source-to-target reconciliation by hour and tenant."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream import schemas as S
from tillstream.functions import clock

_COUNTERS = ["pay_count", "pay_amount", "refund_count", "refund_amount", "event_count"]

PENDING, EQUAL, DIFFERS, REPAIRED = 0, 1, 2, 3


def _counters(events: DataFrame, prefix: str) -> DataFrame:
    t, kind = F.col("event_time"), F.col("event_type")
    pay, refund = kind == S.PAY, kind == S.REFUND
    amount = F.abs("amount_minor")
    # Counted by hour number first; the wall clock is rendered on the small result.
    agg = events.groupBy(
        clock.floor_ms(t, clock.HOUR_MS).alias("_hour"), "tenant_id"
    ).agg(
        F.count_if(pay).alias(f"{prefix}_pay_count"),
        F.coalesce(F.sum(F.when(pay, amount)), F.lit(0)).alias(f"{prefix}_pay_amount"),
        F.count_if(refund).alias(f"{prefix}_refund_count"),
        F.coalesce(F.sum(F.when(refund, amount)), F.lit(0)).alias(f"{prefix}_refund_amount"),
        F.count("*").alias(f"{prefix}_event_count"),
    )
    hour = F.col("_hour")
    return agg.select(
        clock.stat_date(hour).alias("recon_date"),
        clock.stat_hour(hour).alias("recon_hour"),
        "tenant_id",
        *[f"{prefix}_{c}" for c in _COUNTERS],
    )


def source_counters(raw: DataFrame) -> DataFrame:
    """Counters of the input, before deduplication."""
    return _counters(raw, "src")


def target_counters(detail: DataFrame) -> DataFrame:
    """The same counters of what was stored (``event_time`` in epoch ms)."""
    return _counters(detail, "dst")


def stored_counters(detail: DataFrame) -> DataFrame:
    """Target counters of a stored detail table, whose times are local wall clock."""
    return target_counters(
        detail.withColumn("event_time", clock.wall_to_ms(F.col("event_time")))
    )


def reconcile(src: DataFrame, dst: DataFrame) -> DataFrame:
    """Both sides per key with differences (source - target), reason and status.

    The sides are stacked and merged by one aggregate, so a key that only one
    side has is kept and no join is needed. A missing source counts as zero, a
    missing target stays null and pending.
    """
    def padded(df: DataFrame, own: str, other: str) -> DataFrame:
        return df.select(
            *S.RECON_KEYS,
            *[F.col(f"{own}_{c}") for c in _COUNTERS],
            *[F.lit(None).cast("bigint").alias(f"{other}_{c}") for c in _COUNTERS],
            F.lit(own).alias("_side"),
        )

    both = padded(src, "src", "dst").unionByName(padded(dst, "dst", "src"))
    merged = both.groupBy(*S.RECON_KEYS).agg(
        *[F.sum(f"{side}_{c}").alias(f"{side}_{c}") for side in ("src", "dst") for c in _COUNTERS],
        F.count_if(F.col("_side") == "src").alias("_src"),
        F.count_if(F.col("_side") == "dst").alias("_dst"),
    )
    half = (F.col("_src") == 0) | (F.col("_dst") == 0)
    unequal = [
        (F.col(f"src_{c}") != F.col(f"dst_{c}"), c)
        for c in ("event_count", "pay_count", "pay_amount", "refund_count", "refund_amount")
    ]
    reason = F.coalesce(
        F.when(F.col("_src") == 0, F.lit("missing_source")),
        F.when(F.col("_dst") == 0, F.lit("missing_target")),
        *[F.when(differs, F.lit(name)) for differs, name in unequal],
    )
    return merged.select(
        *S.RECON_KEYS,
        *[F.coalesce(f"src_{c}", F.lit(0)).alias(f"src_{c}") for c in _COUNTERS],
        *[f"dst_{c}" for c in _COUNTERS],
        (F.coalesce("src_pay_count", F.lit(0)) - F.col("dst_pay_count")).alias("diff_pay_count"),
        (F.coalesce("src_pay_amount", F.lit(0)) - F.col("dst_pay_amount")).alias(
            "diff_pay_amount"
        ),
        reason.alias("diff_reason"),
        F.when(half, F.lit(PENDING))
        .when(reason.isNull(), F.lit(EQUAL))
        .otherwise(F.lit(DIFFERS))
        .alias("recon_status"),
    )


def mark_repaired(recon: DataFrame, again: DataFrame) -> DataFrame:
    """Rows that differed and are equal in a second run get status 3."""
    fixed = again.where(F.col("recon_status") == EQUAL).select(
        *S.RECON_KEYS, F.lit(True).alias("_fixed")
    )
    status = F.when(
        (F.col("recon_status") == DIFFERS) & F.col("_fixed"), F.lit(REPAIRED)
    ).otherwise(F.col("recon_status"))
    return (
        recon.join(fixed, S.RECON_KEYS, "left")
        .withColumn("recon_status", status)
        .select(*recon.columns)
    )


def diff_analysis(count: Column, amount: Column, status: Column) -> Column:
    """Label of a difference."""
    return (
        F.when((count > 0) & (amount > 0), F.lit("data_loss"))
        .when((count < 0) & (amount < 0), F.lit("data_duplicate"))
        .when((count == 0) & (amount != 0), F.lit("amount_mismatch"))
        .when(status == PENDING, F.lit("pending"))
        .otherwise(F.lit("unknown"))
    )


def reconciliation_diff(recon: DataFrame) -> DataFrame:
    """The stored view: rows that differ, with their label."""
    return recon.where(F.col("recon_status") == DIFFERS).select(
        *S.RECON_KEYS,
        "src_pay_count",
        "dst_pay_count",
        "src_pay_amount",
        "dst_pay_amount",
        "diff_pay_count",
        "diff_pay_amount",
        "diff_reason",
        "recon_status",
        diff_analysis(
            F.col("diff_pay_count"), F.col("diff_pay_amount"), F.col("recon_status")
        ).alias("diff_analysis"),
    )
