"""Queries: data profiles and table checks."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from tillstream import schemas as S
from tillstream.functions import clock
from tillstream.operators import ingest, profile, skew
from tillstream.plans.checkviews import clock as at, day
from tillstream.plans.registry import query
from tillstream.plans.settlement import detail_events, valid_events
from tillstream.sources import adapters as A
from tillstream.sources.tables import split_hot_cold


def _yuan(amount: str) -> str:
    return f"CAST(CAST(CAST({amount} AS DECIMAL(30,0)) / 100 AS DECIMAL(30,2)) AS VARCHAR)"


def _pay(spark, sf_dir):
    return valid_events(spark, sf_dir).where(F.col("event_type") == S.PAY)


_COUNTS = "(SELECT tenant_id, count(*) AS cnt FROM a_events GROUP BY ALL)"


@query(f"""
SELECT tenant_id, cnt, CAST(cnt * 1000000 // (SELECT sum(cnt) FROM {_COUNTS}) AS BIGINT) AS share_ppm
FROM {_COUNTS}""")
def skew_profile(spark, sf_dir):
    return profile.skew_profile(A.a_events(spark, sf_dir), "tenant_id")


@query(f"""
SELECT count(*) AS keys, CAST(sum(cnt) AS BIGINT) AS total,
  CAST(max(cnt) * 1000000 // sum(cnt) AS BIGINT) AS top1_ppm,
  CAST((SELECT sum(cnt) FROM (SELECT cnt FROM {_COUNTS} ORDER BY cnt DESC LIMIT 5)) * 1000000
    // sum(cnt) AS BIGINT) AS top5_ppm
FROM {_COUNTS}""")
def skew_summary(spark, sf_dir):
    return profile.skew_summary(A.a_events(spark, sf_dir), "tenant_id")


@query(f"""
SELECT tenant_id, count(*) AS cnt, {_yuan('sum(amount_minor)')} AS total_yuan
FROM a_valid WHERE event_type = 'pay_success' GROUP BY ALL ORDER BY cnt DESC, tenant_id LIMIT 5""")
def top_tenants(spark, sf_dir):
    return profile.top_k(_pay(spark, sf_dir), "tenant_id", 5, "amount_minor")


@query("""
SELECT tenant_id, count(*) AS events, CAST(sum(amount_minor) AS BIGINT) AS amount,
  CASE WHEN count(*) > 1000 THEN 'salted' ELSE 'direct' END AS path
FROM a_events GROUP BY ALL""")
def isolated_hot_tenants(spark, sf_dir):
    sums = {"events": F.lit(1), "amount": F.col("amount_minor")}
    return skew.isolate_hot(
        A.a_events(spark, sf_dir), "tenant_id", 1000, sums, 16, F.col("idempotency_key")
    )


@query("""
SELECT idempotency_key, count(*) AS cnt FROM a_events GROUP BY ALL HAVING count(*) > 1
ORDER BY cnt DESC, idempotency_key LIMIT 20""")
def duplicate_keys(spark, sf_dir):
    return profile.duplicate_keys(A.a_events(spark, sf_dir), "idempotency_key", 20)


@query("""
SELECT count(*) AS total_rows, count(DISTINCT idempotency_key) AS distinct_keys FROM a_events""")
def key_uniqueness(spark, sf_dir):
    return profile.key_uniqueness(A.a_events(spark, sf_dir), "idempotency_key")


@query("""
SELECT count(*) AS total_rows, count(DISTINCT idempotency_key) AS distinct_keys FROM a_detail""")
def detail_uniqueness(spark, sf_dir):
    return profile.key_uniqueness(detail_events(spark, sf_dir), "idempotency_key")


@query(f"""
SELECT event_type, count(*) AS cnt, {_yuan('sum(amount_minor)')} AS total_yuan
FROM a_detail GROUP BY event_type""")
def type_totals(spark, sf_dir):
    return profile.type_totals(detail_events(spark, sf_dir))


@query(f"SELECT {day('event_time')} AS event_date, count(*) AS cnt FROM a_detail GROUP BY ALL")
def daily_counts(spark, sf_dir):
    return profile.daily_counts(detail_events(spark, sf_dir))


@query(f"""
SELECT 'detail' AS tbl, count(*) AS cnt, {_yuan('sum(amount_minor)')} AS total_yuan,
  {at('min(event_time)')} AS earliest, {at('max(event_time)')} AS latest FROM a_valid
UNION ALL SELECT 'dirty', count(*), NULL, {at('min(ingest_time)')}, {at('max(ingest_time)')}
FROM a_checked WHERE dirty_reason IS NOT NULL""")
def table_health(spark, sf_dir):
    valid, dirty = ingest.split(ingest.validate_events(A.a_events(spark, sf_dir)))
    return profile.table_health(
        {
            "detail": (valid, "event_time", "amount_minor"),
            "dirty": (dirty, "ingest_time", None),
        }
    )


_NOW = A.DAY0_MS + 4 * 86_400_000


@query(f"""
SELECT {at('event_time - event_time % 3600000')} AS hour_bucket, count(*) AS cnt,
  {_yuan('sum(amount_minor)')} AS total_yuan
FROM a_valid WHERE event_time BETWEEN {_NOW} - 6 * 3600000 AND {_NOW} GROUP BY hour_bucket""")
def hourly_distribution(spark, sf_dir):
    return profile.hourly_distribution(valid_events(spark, sf_dir), _NOW, 6)


@query("""
SELECT concat('tp_', event_type) AS topic, count(*) AS events, count(tenant_id) AS keyed
FROM a_events GROUP BY ALL""")
def topic_counts(spark, sf_dir):
    return profile.topic_counts(ingest.to_topic_records(A.a_events(spark, sf_dir)))


_TIER = """CASE WHEN ingest_time - event_time <= 30000 THEN 'le_30s'
  WHEN ingest_time - event_time <= 600000 THEN 'le_10m'
  WHEN ingest_time - event_time <= 21600000 THEN 'le_6h'
  WHEN ingest_time - event_time <= 172800000 THEN 'le_48h' ELSE 'beyond' END"""


@query(f"""
SELECT event_type, psp, {_TIER} AS tier, count(*) AS cnt,
  min(ingest_time - event_time) AS min_delay, max(ingest_time - event_time) AS max_delay
FROM a_events GROUP BY ALL""")
def delay_profile(spark, sf_dir):
    return profile.delay_profile(A.a_events(spark, sf_dir), ["event_type", "psp"])


@query("""
SELECT tenant_id, min(CASE WHEN place >= (total * 50 + 99) // 100 THEN delay END) AS p50,
  min(CASE WHEN place >= (total * 90 + 99) // 100 THEN delay END) AS p90,
  min(CASE WHEN place >= (total * 99 + 99) // 100 THEN delay END) AS p99
FROM (SELECT tenant_id, ingest_time - event_time AS delay,
    row_number() OVER (PARTITION BY tenant_id ORDER BY ingest_time - event_time) AS place,
    count(*) OVER (PARTITION BY tenant_id) AS total FROM a_events)
GROUP BY tenant_id""")
def delay_quantiles(spark, sf_dir):
    return profile.delay_quantiles(A.a_events(spark, sf_dir), ["tenant_id"])


@query("""
SELECT *, CAST(disordered * 1000000 // events AS BIGINT) AS disorder_ppm FROM (
  SELECT tenant_id, count(*) AS events,
    count(*) FILTER (WHERE event_time < before) AS disordered,
    coalesce(max(before - event_time) FILTER (WHERE event_time < before), 0) AS max_lag_ms
  FROM (SELECT tenant_id, event_time, max(event_time) OVER (PARTITION BY tenant_id
      ORDER BY ingest_time RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
    FROM a_events) GROUP BY tenant_id)""")
def disorder_profile(spark, sf_dir):
    return profile.disorder_profile(A.a_events(spark, sf_dir), ["tenant_id"])


@query("""
SELECT tenant_id, channel_id, psp, pay_count, refund_count, chargeback_count,
  CASE WHEN pay_count > 0 THEN CAST(refund_count * 1000000 // pay_count AS BIGINT) ELSE 0 END AS refund_ppm,
  CASE WHEN pay_count > 0 THEN CAST(chargeback_count * 1000000 // pay_count AS BIGINT) ELSE 0 END AS chargeback_ppm,
  CASE WHEN pay_count > 0 THEN refund_count * 1000000 // pay_count ELSE 0 END > 30000 AS above_baseline
FROM (SELECT tenant_id, channel_id, psp,
    count(*) FILTER (WHERE event_type = 'pay_success') AS pay_count,
    count(*) FILTER (WHERE event_type = 'refund_success') AS refund_count,
    count(*) FILTER (WHERE event_type = 'chargeback') AS chargeback_count
  FROM a_detail GROUP BY ALL)""")
def refund_rates(spark, sf_dir):
    return profile.refund_rates(detail_events(spark, sf_dir), ["tenant_id", "channel_id", "psp"])


@query("""
SELECT tenant_id, count(*) AS attempts, count(*) FILTER (WHERE kind = 'error') AS failures,
  CAST(count(*) FILTER (WHERE kind = 'error') * 1000000 // count(*) AS BIGINT) AS failure_ppm
FROM a_usage WHERE kind IN ('purchase', 'error') GROUP BY tenant_id""")
def failure_rates(spark, sf_dir):
    return profile.failure_rates(A.a_usage(spark, sf_dir), ["tenant_id"], "purchase", "error")


_CLASS = f"""CASE WHEN amount_minor = 0 THEN 'zero' WHEN amount_minor < 0 THEN 'negative'
  WHEN amount_minor >= {S.HUGE_AMOUNT} THEN 'huge'
  WHEN amount_minor IN ({', '.join(map(str, S.COMMON_AMOUNTS))}) THEN 'common' ELSE 'custom' END"""


@query(f"""
SELECT {_CLASS} AS amount_class, count(*) AS cnt,
  CAST(count(*) * 1000000 // (SELECT count(*) FROM a_pay) AS BIGINT) AS share_ppm
FROM a_pay GROUP BY amount_class""")
def amount_profile(spark, sf_dir):
    return profile.amount_profile(A.a_pay(spark, sf_dir))


@query("""
SELECT event_type, count(*) AS keys, CAST(sum(r) AS BIGINT) AS total_rows,
  count(*) FILTER (WHERE r > 1) AS repeated_keys, CAST(sum(r - full_rows) AS BIGINT) AS exact_copies,
  CAST(sum(full_rows - contents) AS BIGINT) AS replays,
  CAST(sum(contents - 1) AS BIGINT) AS changed_copies
FROM (SELECT event_type, idempotency_key, count(*) AS r,
    count(DISTINCT concat_ws('|', amount_minor, trace_id, event_time, ingest_time)) AS full_rows,
    count(DISTINCT concat_ws('|', amount_minor, trace_id, event_time)) AS contents
  FROM a_events GROUP BY ALL)
GROUP BY event_type""")
def duplicate_profile(spark, sf_dir):
    return profile.duplicate_profile(
        A.a_events(spark, sf_dir),
        "idempotency_key",
        ["amount_minor", "trace_id", "event_time"],
        "event_type",
    )


@query("""
SELECT order_id AS subject, 'several_successes' AS violation FROM a_events
WHERE event_type = 'pay_success' GROUP BY order_id HAVING count(*) > 1
UNION ALL
SELECT payment_id, unnest(list_filter([
    CASE WHEN first_fix IS NOT NULL AND paid IS NULL THEN 'no_payment' END,
    CASE WHEN refunded > paid THEN 'refund_above_paid' END,
    CASE WHEN first_fix < paid_at THEN 'correction_before_payment' END], lambda x: x IS NOT NULL))
FROM (SELECT payment_id, max(amount_minor) FILTER (WHERE event_type = 'pay_success') AS paid,
    min(event_time) FILTER (WHERE event_type = 'pay_success') AS paid_at,
    sum(-amount_minor) FILTER (WHERE event_type = 'refund_success') AS refunded,
    min(event_time) FILTER (WHERE event_type IN ('refund_success', 'chargeback')) AS first_fix
  FROM a_events WHERE payment_id IS NOT NULL GROUP BY payment_id)""")
def lifecycle_violations(spark, sf_dir):
    return profile.lifecycle_violations(A.a_events(spark, sf_dir))


@query("SELECT idempotency_key, ingest_time FROM a_events")
def arrival_order(spark, sf_dir):
    return profile.in_arrival_order(A.a_events(spark, sf_dir), "idempotency_key").select(
        "idempotency_key", "ingest_time"
    )


@query(f"""
SELECT CASE WHEN {day('event_time')} > '2024-01-01' THEN 'hot' ELSE 'cold' END AS tier, {day('event_time')} AS event_date, count(*) AS cnt
FROM a_valid GROUP BY ALL""")
def hot_cold_split(spark, sf_dir):
    dated = valid_events(spark, sf_dir).select(clock.stat_date(F.col("event_time")).alias("event_date"))
    hot, cold = split_hot_cold(dated, "event_date", 7, date(2024, 1, 8))
    both = hot.withColumn("tier", F.lit("hot")).unionByName(cold.withColumn("tier", F.lit("cold")))
    return both.groupBy("tier", "event_date").agg(F.count("*").alias("cnt"))


@query("SELECT * FROM (SELECT idempotency_key, coalesce(currency, 'CNY') AS currency, coalesce(data_quality_flag, 'normal') AS data_quality_flag FROM a_events)")
def defaults_filled(spark, sf_dir):
    events = A.a_events(spark, sf_dir).withColumns(
        {
            "currency": F.when(F.col("n") % 2 == 0, F.col("currency")),
            "data_quality_flag": F.when(F.col("n") % 3 == 0, F.col("data_quality_flag")),
        }
    )
    return ingest.with_defaults(events).select("idempotency_key", "currency", "data_quality_flag")
