"""Risk: enrichment, rolling features, rules with evidence, hits and their reading."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstream.functions import clock, money
from tillstream.operators.asof import asof_lookup
from tillstream.operators.ordered import (
    latest_per_key,
    rolling_distinct,
    rolling_sums,
    with_next_block,
)
from tillstream.operators.skew import lookup_join, salted_join
from tillstream.session import stage


@dataclass(frozen=True)
class Rule:
    """One configured risk rule."""

    rule_id: str
    version: int
    window_ms: int
    threshold: int


def enrich_with_logins(
    pay: DataFrame, login: DataFrame, user: str, width_ms: int, device: str = "device_id"
) -> DataFrame:
    """Payments with their logins of the last ``width_ms``: count, last time and device.

    ``degraded`` marks payments without any login in range, so that later rules
    can hold back instead of raising false alarms. Times are compared per
    distinct (user, time), and payments get the answer by a spread join.
    """
    at = "event_time"
    marks = (
        login.select(user, at, device, F.lit(1).alias("_login"), F.lit(0).alias("_pay"))
        .unionByName(
            pay.select(
                user, at, F.lit(None).cast("string").alias(device),
                F.lit(0).alias("_login"), F.lit(1).alias("_pay"),
            )
        )
        .groupBy(user, at)
        .agg(
            F.max(device).alias(device),
            F.sum("_login").alias("_login"),
            F.max("_pay").alias("_pay"),
        )
    )
    # Read twice below with different columns, so it is worth writing once.
    marks = stage(marks, "marks")
    counts = rolling_sums(marks, user, at, width_ms, {"login_count": F.col("_login")})
    upto = (
        Window.partitionBy(user, "_block")
        .orderBy(at)
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    login_row = F.when(
        F.col("_login") > 0, F.struct(F.col(at).alias("at"), F.col(device).alias("device"))
    )
    last = (
        with_next_block(marks, at, width_ms)
        .select(user, at, "_pay", "_own", "_block", F.last(login_row, True).over(upto).alias("_last"))
        .where("_own = _block and _pay = 1")
        .select(user, at, "_last")
    )
    answer = last.join(counts, [user, at]).select(
        user,
        at,
        "login_count",
        F.when(F.col("login_count") > 0, F.col("_last.at")).alias("last_login_time"),
        F.when(F.col("login_count") > 0, F.col("_last.device")).alias("login_device"),
    )
    return salted_join(pay, answer, [user, at]).withColumn(
        "degraded", F.col("login_count") == 0
    )


def flag_list(df: DataFrame, entries: DataFrame, on: str, flag: str = "listed") -> DataFrame:
    """Mark rows whose ``on`` is in an allow or deny list."""
    marks = entries.select(on).distinct().withColumn(flag, F.lit(True))
    marked = lookup_join(df, marks, [on], derived=True)
    return marked.withColumn(flag, F.coalesce(flag, F.lit(False)))


def only_listed(df: DataFrame, entries: DataFrame, on: str, listed: bool = True) -> DataFrame:
    """Keep the rows in (or not in) a list."""
    how = "left_semi" if listed else "left_anti"
    return lookup_join(df, entries.select(on).distinct(), [on], how, derived=True)


def with_config(df: DataFrame, config: DataFrame, key: str, at: str, name: str) -> DataFrame:
    """Configuration row in force at ``at``; ``config`` has ``effective_time`` and ``version``."""
    return asof_lookup(df, config, [key], at, "effective_time", name, "version")


# --- features ----------------------------------------------------------------------


def _by_second(events: DataFrame) -> DataFrame:
    return events.withColumn("second", clock.bucket(F.col("event_time"), clock.SECOND_MS))


def risk_features(events: DataFrame) -> dict[str, DataFrame]:
    """Sliding features at second grain, exact, one frame per entity kind."""
    rows = _by_second(events)
    kind = F.col("kind")
    signups = rolling_sums(
        rows, "device_id", "second", 600,
        {"signups_10m": F.when(kind == "signup", 1).otherwise(0)},
    )
    accounts = rolling_distinct(rows, "device_id", "user_id", "second", 3_600, "accounts_1h")
    ip_hits = rolling_sums(rows, "ip", "second", 3_600, {"hits_1h": F.lit(1)})
    ip_tenants = rolling_distinct(rows, "ip", "tenant_id", "second", 3_600, "tenants_1h")
    history = rolling_sums(
        rows, "user_id", "second", 86_400,
        {
            "payments_24h": F.when(kind == "purchase", 1).otherwise(0),
            "failures_24h": F.when(kind == "error", 1).otherwise(0),
            "amount_24h": F.when(kind == "purchase", F.col("amount_minor")).otherwise(0),
        },
    )
    return {
        "device": signups.join(accounts, ["device_id", "second"]),
        "ip": ip_hits.join(ip_tenants, ["ip", "second"]),
        "user": history,
    }


# --- rules -------------------------------------------------------------------------

HIT_COLUMNS = [
    "hit_id", "rule_id", "rule_version", "risk_type", "entity_type", "entity", "tenant_id",
    "window_start", "value", "threshold", "evidence",
]


def _hits(
    found: DataFrame, rule: Rule, risk_type: str, entity_type: str, entity: Column,
    value: Column, evidence: Sequence[Column],
) -> DataFrame:
    """Hit rows. The id follows from rule, entity and window, so a replay hits once."""
    start = F.col("window_start")
    hit_id = F.sha2(
        F.concat_ws("|", F.lit(rule.rule_id), F.lit(rule.version), entity, start), 256
    )
    return found.select(
        hit_id.alias("hit_id"),
        F.lit(rule.rule_id).alias("rule_id"),
        F.lit(rule.version).alias("rule_version"),
        F.lit(risk_type).alias("risk_type"),
        F.lit(entity_type).alias("entity_type"),
        entity.cast("string").alias("entity"),
        "tenant_id",
        "window_start",
        value.cast("long").alias("value"),
        F.lit(rule.threshold).cast("long").alias("threshold"),
        F.to_json(F.struct(*evidence)).alias("evidence"),
    )


def _windowed(events: DataFrame, rule: Rule) -> DataFrame:
    return events.withColumn(
        "window_start", clock.floor_ms(F.col("event_time"), rule.window_ms)
    )


def frequency_counts(tries: DataFrame, window: Column | str) -> DataFrame:
    """Attempts and failures per user and window, for batch and stream alike."""
    return tries.groupBy("user_id", window).agg(
        F.max("tenant_id").alias("tenant_id"),
        F.count("*").alias("tries"),
        F.count_if(F.col("kind") == "error").alias("failures"),
        F.min("event_time").alias("first_time"),
        F.max("event_time").alias("last_time"),
    )


def frequency_hits(counts: DataFrame, rule: Rule) -> DataFrame:
    return _hits(
        counts.where(F.col("tries") >= rule.threshold), rule, "frequency", "user",
        F.col("user_id"), F.col("tries"),
        [F.col(c) for c in ("tries", "failures", "first_time", "last_time")],
    )


def rule_frequency(events: DataFrame, rule: Rule) -> DataFrame:
    """Many payments and failures of one user in a window."""
    tries = _windowed(events, rule).where(F.col("kind").isin("purchase", "error"))
    return frequency_hits(frequency_counts(tries, "window_start"), rule)


def rule_amount(events: DataFrame, rule: Rule, z_limit: float = 3.0) -> DataFrame:
    """Payments over the threshold, or far above the mean of their tenant.

    Mean and deviation come from exact integer sums, so they do not depend on
    the order of rows.
    """
    pay = events.where(F.col("kind") == "purchase")
    x = F.col("amount_minor").cast("decimal(38,0)")
    stats = pay.groupBy("tenant_id").agg(
        F.count("*").cast("double").alias("_n"),
        F.sum("amount_minor").cast("double").alias("_s"),
        F.sum((x * x).cast("decimal(38,0)")).cast("double").alias("_ss"),
    )
    mean = F.col("_s") / F.col("_n")
    deviation = F.sqrt((F.col("_ss") - F.col("_s") * F.col("_s") / F.col("_n")) / (F.col("_n") - 1))
    placed = lookup_join(pay, stats, ["tenant_id"], derived=True).withColumns(
        {"_mean": mean, "_dev": F.when(F.col("_n") > 1, deviation)}
    )
    high = F.col("amount_minor") >= rule.threshold
    outlier = F.coalesce(
        F.col("amount_minor") > F.col("_mean") + F.lit(z_limit) * F.col("_dev"), F.lit(False)
    )
    found = placed.where(high | outlier).withColumns(
        {
            "window_start": F.col("event_time"),
            "over_threshold": high,
            "outlier": outlier,
            "segment_mean": F.floor("_mean").cast("long"),
        }
    )
    return _hits(
        found, rule, "amount", "event", F.col("event_id"), F.col("amount_minor"),
        [F.col(c) for c in ("user_id", "over_threshold", "outlier", "segment_mean")],
    )


def rule_association(
    events: DataFrame, rule: Rule, entity: str, other: str, entity_type: str
) -> DataFrame:
    """One device with many accounts, one address with many tenants.

    Counts (entity, window, other) first and the distinct others second, so a
    busy entity is merged before each shuffle. Rows marked ``degraded`` by the
    login enrichment do not count.
    """
    rows = _windowed(events, rule)
    if "degraded" in events.columns:
        rows = rows.where(~F.col("degraded"))
    pairs = rows.groupBy(entity, "window_start", other).agg(
        F.count("*").alias("rows"), F.max("tenant_id").alias("_tenant")
    )
    agg = pairs.groupBy(entity, "window_start").agg(
        F.count(other).alias("others"),
        F.sum("rows").alias("events"),
        F.min(F.col(other).cast("string")).alias("first_other"),
        F.max("_tenant").alias("tenant_id"),
    )
    return _hits(
        agg.where(F.col("others") >= rule.threshold), rule, "association", entity_type,
        F.col(entity), F.col("others"),
        [F.col(c) for c in ("others", "events", "first_other")],
    )


def risk_hits(parts: Sequence[DataFrame]) -> DataFrame:
    """All hits; one row per ``hit_id`` however often its input was delivered."""
    hits = parts[0]
    for part in parts[1:]:
        hits = hits.unionByName(part)
    return latest_per_key(hits, ["hit_id"], ["window_start"])


def risk_distribution(hits: DataFrame, grain: str, by: Sequence[str]) -> DataFrame:
    """Hits per ``hour`` or ``day`` and the given dimensions."""
    width = {"hour": clock.HOUR_MS, "day": clock.DAY_MS}[grain]
    start = F.col("window_start")
    if grain == "day":
        bucket = clock.stat_date(start)
    else:
        bucket = clock.wall_clock(clock.floor_ms(start, width))
    return hits.groupBy(bucket.alias(grain), *by).agg(
        F.count("*").alias("hits"), F.max("value").alias("max_value")
    )


def evidence(
    hits: DataFrame, entity_type: str, entity: str, now_ms: int, hours: int = 24
) -> DataFrame:
    """The evidence chain of one user or device over the last ``hours``."""
    return (
        hits.where((F.col("entity_type") == entity_type) & (F.col("entity") == entity))
        .where(clock.since(F.col("window_start"), now_ms, hours))
        .orderBy("window_start", "rule_id", "hit_id")
    )


def explain_spike(
    hits: DataFrame, feed: DataFrame, key: str, dup_ppm: int = 50_000, late_ppm: int = 100_000
) -> DataFrame:
    """Per hour: did hits rise for real, or was the input duplicated or late?

    ``feed`` is the raw input with event and arrival times. Hour rows are few,
    so the comparison with the hour before is one small window.
    """
    hour = clock.floor_ms(F.col("event_time"), clock.HOUR_MS).alias("hour_ms")
    late = (F.col("ingest_time") - F.col("event_time") > 600_000).cast("int")
    per_key = feed.groupBy(hour, key).agg(F.count("*").alias("rows"), F.sum(late).alias("late"))
    quality = per_key.groupBy("hour_ms").agg(
        F.sum("rows").alias("rows"),
        F.sum(F.col("rows") - 1).alias("copies"),
        F.sum("late").alias("late"),
    ).withColumn("hits", F.lit(0).cast("long"))
    counted = hits.groupBy(
        clock.floor_ms(F.col("window_start"), clock.HOUR_MS).alias("hour_ms")
    ).agg(F.count("*").alias("hits"))
    merged = (
        quality.unionByName(counted, allowMissingColumns=True)
        .groupBy("hour_ms")
        .agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("rows", "copies", "late", "hits")])
    )
    # The previous hour by its number: an equi join instead of a global window.
    previous = merged.select(
        (F.col("hour_ms") + clock.HOUR_MS).alias("hour_ms"), F.col("hits").alias("before")
    )
    both = merged.join(previous, "hour_ms", "left")
    before = F.coalesce("before", F.lit(0))
    rose = F.col("hits") >= 2 * F.greatest(before, F.lit(1))
    copies = F.coalesce(money.ppm(F.col("copies"), F.col("rows")), F.lit(0))
    late_share = F.coalesce(money.ppm(F.col("late"), F.col("rows")), F.lit(0))
    label = (
        F.when(~rose, F.lit("steady"))
        .when(copies > dup_ppm, F.lit("duplicated_input"))
        .when(late_share > late_ppm, F.lit("late_input"))
        .otherwise(F.lit("real_rise"))
    )
    return both.select(
        clock.wall_clock(F.col("hour_ms")).alias("hour"),
        "hits",
        before.alias("hits_before"),
        copies.alias("copies_ppm"),
        late_share.alias("late_ppm"),
        label.alias("explanation"),
    )
