"""Queries: tenant billing and quotas."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillstream.functions import clock
from tillstream.operators import billing
from tillstream.plans.checkviews import clock as at, day
from tillstream.plans.registry import query
from tillstream.session import stage
from tillstream.sources import adapters as A

_ITEM = """CASE kind WHEN 'purchase' THEN 'success' WHEN 'click' THEN 'api' WHEN 'error' THEN 'risk'
  WHEN 'view' THEN 'report' ELSE 'push' END"""

_DAILY = f"""(SELECT tenant_id, {day('event_time')} AS dt,
  count(*) FILTER (WHERE kind = 'purchase') AS success_count,
  count(*) FILTER (WHERE kind = 'click') AS api_count,
  count(*) FILTER (WHERE kind = 'error') AS risk_count,
  count(*) FILTER (WHERE kind = 'view') AS report_count,
  count(*) FILTER (WHERE kind = 'signup') AS push_count,
  CAST(coalesce(sum(amount_minor) FILTER (WHERE kind = 'purchase'), 0) AS BIGINT) AS success_amount
FROM a_usage GROUP BY ALL)"""

_SUMS = ", ".join(f"CAST(sum({m}) AS BIGINT) AS {m}" for m in billing.BILL_METRICS)
_MTD = ", ".join(f"CAST(sum({m}) OVER w AS BIGINT) AS mtd_{m}" for m in billing.BILL_METRICS)


def _feed(spark, sf_dir):
    return A.usage_with_replays(A.a_usage(spark, sf_dir))


def _billed(spark, sf_dir):
    return billing.billable(_feed(spark, sf_dir))


def _daily(spark, sf_dir):
    return billing.tenant_daily_bill(_billed(spark, sf_dir))


@query(f"SELECT * FROM {_DAILY}")
def tenant_daily_bill(spark, sf_dir):
    return _daily(spark, sf_dir)


@query(f"SELECT tenant_id, substring(dt, 1, 7) AS month, {_SUMS} FROM {_DAILY} GROUP BY ALL")
def monthly_bill(spark, sf_dir):
    return billing.monthly_bill(_daily(spark, sf_dir))


@query(f"""
SELECT *, {_MTD} FROM {_DAILY}
WINDOW w AS (PARTITION BY tenant_id, substring(dt, 1, 7) ORDER BY dt)""")
def month_to_date(spark, sf_dir):
    return billing.month_to_date(_daily(spark, sf_dir))


@query(f"""
SELECT event_id, tenant_id, {day('event_time')} AS dt, {_ITEM} AS item, amount_minor FROM a_usage
SEMI JOIN (SELECT tenant_id AS t2, dt AS d2 FROM {_DAILY} WHERE report_count >= 8) b
  ON a_usage.tenant_id = b.t2 AND {day('event_time')} = b.d2 AND kind = 'view'""")
def bill_trace(spark, sf_dir):
    """Usage behind the bill lines with many report queries."""
    billed = stage(_billed(spark, sf_dir), "billed")
    lines = billing.bill_lines(billing.tenant_daily_bill(billed))
    disputed = lines.where((F.col("item") == "report") & (F.col("quantity") >= 8))
    return billing.bill_trace(disputed, billed).select(
        "event_id", "tenant_id", "dt", "item", "amount_minor"
    )


@query(f"""
SELECT tenant_id, dt, success_count + api_count + risk_count + report_count + push_count AS billed,
  success_count + api_count + risk_count + report_count + push_count AS recounted,
  success_amount AS billed_amount, success_amount AS recounted_amount, true AS agrees
FROM {_DAILY} WHERE substring(md5(concat_ws('|', tenant_id, dt)), 1, 2) < '40'""")
def bill_proof(spark, sf_dir):
    """A hashed quarter of the tenant-days, recounted from the raw feed."""
    return billing.verify_bill(_daily(spark, sf_dir), _feed(spark, sf_dir))


@query("""
SELECT tenant_id, m AS window_start, CAST(sum(calls) AS BIGINT) AS calls,
  max(calls) AS peak_per_second, CAST(sum(amount) AS BIGINT) AS amount
FROM (SELECT tenant_id, event_time - event_time % 60000 AS m, event_time // 1000 AS s,
    count(*) AS calls, sum(CASE WHEN kind = 'purchase' THEN amount_minor ELSE 0 END) AS amount
  FROM a_usage GROUP BY ALL) GROUP BY ALL""")
def usage_rates(spark, sf_dir):
    return billing.usage_rates(A.a_usage(spark, sf_dir))


_HOURLY = """(SELECT tenant_id, event_time - event_time % 3600000 AS window_start, count(*) AS used
  FROM a_usage GROUP BY ALL)"""


@query(f"""
SELECT u.tenant_id, window_start, used, coalesce(quota_per_hour, 0) AS quota_per_hour,
  coalesce(version, 0) AS quota_version
FROM {_HOURLY} u ASOF LEFT JOIN a_quotas q
  ON u.tenant_id = q.tenant_id AND u.window_start >= q.effective_time""")
def usage_with_quota(spark, sf_dir):
    hourly = billing.hourly_usage(A.a_usage(spark, sf_dir))
    return billing.with_quota(hourly, A.a_quotas(spark, sf_dir)).na.fill(0)


@query("""
SELECT c.tenant_id, c.window_start, q.quota_per_hour, q.version AS quota_version,
  min(event_time) AS crossed_at, min(used) AS used_then
FROM (SELECT tenant_id, event_time - event_time % 3600000 AS window_start, event_time,
    count(*) OVER (PARTITION BY tenant_id, event_time - event_time % 3600000
      ORDER BY event_time) AS used FROM a_usage) c
ASOF JOIN a_quotas q ON c.tenant_id = q.tenant_id AND c.window_start >= q.effective_time
WHERE used > quota_per_hour GROUP BY ALL""")
def quota_crossings(spark, sf_dir):
    return billing.first_crossing(A.a_usage(spark, sf_dir), A.a_quotas(spark, sf_dir))


THROTTLE_SQL = f"""
SELECT sha256(concat_ws('|', 'throttle', u.tenant_id, window_start)) AS event_id,
  'tenant_throttle' AS event_type, u.tenant_id, window_start, used, quota_per_hour,
  version AS quota_version
FROM {_HOURLY} u ASOF JOIN a_quotas q
  ON u.tenant_id = q.tenant_id AND u.window_start >= q.effective_time
WHERE used > quota_per_hour"""


@query(THROTTLE_SQL)
def throttle_events(spark, sf_dir):
    return billing.throttle_events(A.a_usage(spark, sf_dir), A.a_quotas(spark, sf_dir))


@query(f"""
SELECT {at('event_time - event_time % 3600000')} AS hour, tenant_id, count(*) AS calls
FROM a_usage WHERE event_time BETWEEN {A.DAY0_MS + 5 * 86_400_000} - 48 * 3600000
  AND {A.DAY0_MS + 5 * 86_400_000} GROUP BY ALL""")
def recent_usage(spark, sf_dir):
    """Usage of the last 48 hours before an explicit now."""
    recent = A.a_usage(spark, sf_dir).where(
        clock.since(F.col("event_time"), A.DAY0_MS + 5 * clock.DAY_MS, 48)
    )
    hour = clock.floor_ms(F.col("event_time"), clock.HOUR_MS).alias("_hour")
    return recent.groupBy(hour, "tenant_id").agg(F.count("*").alias("calls")).select(
        clock.wall_clock(F.col("_hour")).alias("hour"), "tenant_id", "calls"
    )
