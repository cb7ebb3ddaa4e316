"""Queries: risk enrichment, features, rules and hits."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillstream.functions import clock
from tillstream.operators import risk
from tillstream.operators.risk import Rule
from tillstream.plans.checkviews import clock as at, day
from tillstream.plans.registry import query
from tillstream.session import stage
from tillstream.sources import adapters as A

SIX_HOURS = 6 * clock.HOUR_MS

FREQUENCY = Rule("R_FREQ", 3, clock.DAY_MS, 4)
AMOUNT = Rule("R_AMOUNT", 1, 0, 20_000)
DEVICE = Rule("R_DEVICE", 2, clock.DAY_MS, 5)
ADDRESS = Rule("R_ADDRESS", 1, clock.HOUR_MS, 3)


def _usage(spark, sf_dir):
    return A.a_usage(spark, sf_dir)


def _kind(spark, sf_dir, kind):
    return _usage(spark, sf_dir).where(F.col("kind") == kind)


@query(f"""
SELECT p.event_id, count(l.event_id) AS login_count,
  coalesce(max(l.event_time), -1) AS last_login_time,
  coalesce(max(struct_pack(t := l.event_time, d := l.device_id)).d, '') AS login_device,
  count(l.event_id) = 0 AS degraded
FROM (SELECT * FROM a_usage WHERE kind = 'purchase') p
LEFT JOIN (SELECT * FROM a_usage WHERE kind = 'click') l ON p.user_id = l.user_id
  AND l.event_time BETWEEN p.event_time - {SIX_HOURS} AND p.event_time
GROUP BY p.event_id""")
def payments_with_logins(spark, sf_dir):
    """Payments with the logins of the same user in the six hours before."""
    joined = risk.enrich_with_logins(
        _kind(spark, sf_dir, "purchase"), _kind(spark, sf_dir, "click"), "user_id", SIX_HOURS
    )
    return joined.select(
        "event_id",
        "login_count",
        F.coalesce("last_login_time", F.lit(-1)).alias("last_login_time"),
        F.coalesce("login_device", F.lit("")).alias("login_device"),
        "degraded",
    )


def _deny_list(spark, sf_dir):
    return _usage(spark, sf_dir).where(F.col("user_id") % 37 == 0).select("user_id")


@query("SELECT event_id, user_id % 37 = 0 AS denied FROM a_usage WHERE kind = 'purchase'")
def denied_payments(spark, sf_dir):
    flagged = risk.flag_list(
        _kind(spark, sf_dir, "purchase"), _deny_list(spark, sf_dir), "user_id", "denied"
    )
    return flagged.select("event_id", "denied")


@query("SELECT event_id, user_id FROM a_usage WHERE kind = 'purchase' AND user_id % 37 <> 0")
def allowed_payments(spark, sf_dir):
    return risk.only_listed(
        _kind(spark, sf_dir, "purchase"), _deny_list(spark, sf_dir), "user_id", listed=False
    ).select("event_id", "user_id")


@query("""
SELECT u.event_id, coalesce(q.version, 0) AS config_version,
  coalesce(q.quota_per_hour, 0) AS limit_value
FROM a_usage u ASOF LEFT JOIN a_quotas q
  ON u.tenant_id = q.tenant_id AND u.event_time >= q.effective_time""")
def events_with_config(spark, sf_dir):
    """Tenant thresholds in force at event time."""
    found = risk.with_config(
        _usage(spark, sf_dir), A.a_quotas(spark, sf_dir), "tenant_id", "event_time", "config"
    )
    return found.select(
        "event_id",
        F.coalesce("config.version", F.lit(0)).alias("config_version"),
        F.coalesce("config.quota_per_hour", F.lit(0)).alias("limit_value"),
    )


_SECONDS = "(SELECT *, event_time // 1000 AS second FROM a_usage)"


@query(f"""
SELECT device_id, second,
  CAST(max(signups) AS BIGINT) AS signups_10m, max(accounts) AS accounts_1h
FROM (SELECT device_id, second,
    count(*) FILTER (WHERE kind = 'signup') OVER (PARTITION BY device_id ORDER BY second
      RANGE BETWEEN 600 PRECEDING AND CURRENT ROW) AS signups,
    count(DISTINCT user_id) OVER (PARTITION BY device_id ORDER BY second
      RANGE BETWEEN 3600 PRECEDING AND CURRENT ROW) AS accounts
  FROM {_SECONDS}) GROUP BY ALL""")
def device_features(spark, sf_dir):
    return risk.risk_features(_usage(spark, sf_dir))["device"]


@query(f"""
SELECT ip, second, max(hits) AS hits_1h, max(tenants) AS tenants_1h
FROM (SELECT ip, second,
    count(*) OVER (PARTITION BY ip ORDER BY second
      RANGE BETWEEN 3600 PRECEDING AND CURRENT ROW) AS hits,
    count(DISTINCT tenant_id) OVER (PARTITION BY ip ORDER BY second
      RANGE BETWEEN 3600 PRECEDING AND CURRENT ROW) AS tenants
  FROM {_SECONDS}) GROUP BY ALL""")
def ip_features(spark, sf_dir):
    return risk.risk_features(_usage(spark, sf_dir))["ip"]


@query(f"""
SELECT user_id, second, max(p) AS payments_24h, max(f) AS failures_24h,
  CAST(max(a) AS BIGINT) AS amount_24h
FROM (SELECT user_id, second,
    count(*) FILTER (WHERE kind = 'purchase') OVER w AS p,
    count(*) FILTER (WHERE kind = 'error') OVER w AS f,
    sum(CASE WHEN kind = 'purchase' THEN amount_minor ELSE 0 END) OVER w AS a
  FROM {_SECONDS}
  WINDOW w AS (PARTITION BY user_id ORDER BY second
    RANGE BETWEEN 86400 PRECEDING AND CURRENT ROW)) GROUP BY ALL""")
def user_features(spark, sf_dir):
    return risk.risk_features(_usage(spark, sf_dir))["user"]


def _id(rule: Rule, entity: str) -> str:
    return (
        f"sha256(concat_ws('|', '{rule.rule_id}', {rule.version}, {entity}, window_start))"
    )


def _hit(rule: Rule, kind: str, entity_type: str, entity: str, value: str, evidence: str) -> str:
    return f"""{_id(rule, entity)} AS hit_id, '{rule.rule_id}' AS rule_id,
  CAST({rule.version} AS BIGINT) AS rule_version, '{kind}' AS risk_type,
  '{entity_type}' AS entity_type, CAST({entity} AS VARCHAR) AS entity, tenant_id, window_start,
  CAST({value} AS BIGINT) AS value, CAST({rule.threshold} AS BIGINT) AS threshold,
  CAST(to_json(struct_pack({evidence})) AS VARCHAR) AS evidence"""


_FREQ = f"""
SELECT {_hit(FREQUENCY, 'frequency', 'user', 'user_id', 'tries',
    'tries := tries, failures := failures, first_time := first_time, last_time := last_time')}
FROM (SELECT user_id, event_time - event_time % {FREQUENCY.window_ms} AS window_start,
    max(tenant_id) AS tenant_id, count(*) AS tries,
    count(*) FILTER (WHERE kind = 'error') AS failures,
    min(event_time) AS first_time, max(event_time) AS last_time
  FROM a_usage WHERE kind IN ('purchase', 'error') GROUP BY ALL)
WHERE tries >= {FREQUENCY.threshold}"""

_AMOUNT = f"""
SELECT {_hit(AMOUNT, 'amount', 'event', 'event_id', 'amount_minor',
    'user_id := user_id, over_threshold := over_threshold, outlier := outlier, segment_mean := segment_mean')}
FROM (SELECT u.*, event_time AS window_start, amount_minor >= {AMOUNT.threshold} AS over_threshold,
    amount_minor > s / n + 3.0::DOUBLE * sqrt((ss - s * s / n) / (n - 1)) AS outlier,
    CAST(floor(s / n) AS BIGINT) AS segment_mean
  FROM a_usage u JOIN (SELECT tenant_id, CAST(count(*) AS DOUBLE) AS n,
      CAST(sum(amount_minor) AS DOUBLE) AS s,
      CAST(sum(CAST(amount_minor AS HUGEINT) * amount_minor) AS DOUBLE) AS ss
    FROM a_usage WHERE kind = 'purchase' GROUP BY tenant_id) USING (tenant_id)
  WHERE kind = 'purchase')
WHERE over_threshold OR outlier"""


def _assoc(rule: Rule, entity: str, other: str, entity_type: str) -> str:
    return f"""
SELECT {_hit(rule, 'association', entity_type, entity, 'others',
    'others := others, events := events, first_other := first_other')}
FROM (SELECT {entity}, event_time - event_time % {rule.window_ms} AS window_start,
    count(DISTINCT {other}) AS others, count(*) AS events,
    min(CAST({other} AS VARCHAR)) AS first_other, max(tenant_id) AS tenant_id
  FROM a_usage GROUP BY ALL)
WHERE others >= {rule.threshold}"""


_DEVICE = _assoc(DEVICE, "device_id", "user_id", "device")
_ADDRESS = _assoc(ADDRESS, "ip", "tenant_id", "ip")
_ALL = f"({_FREQ} UNION ALL {_AMOUNT} UNION ALL {_DEVICE} UNION ALL {_ADDRESS})"


def _parts(usage):
    return [
        risk.rule_frequency(usage, FREQUENCY),
        risk.rule_amount(usage, AMOUNT),
        risk.rule_association(usage, DEVICE, "device_id", "user_id", "device"),
        risk.rule_association(usage, ADDRESS, "ip", "tenant_id", "ip"),
    ]


def all_hits(spark, sf_dir):
    return risk.risk_hits(_parts(stage(_usage(spark, sf_dir), "usage")))


@query(_FREQ)
def frequency_hits(spark, sf_dir):
    return _parts(_usage(spark, sf_dir))[0]


@query(_AMOUNT)
def amount_hits(spark, sf_dir):
    return _parts(_usage(spark, sf_dir))[1]


@query(f"{_DEVICE} UNION ALL {_ADDRESS}")
def association_hits(spark, sf_dir):
    parts = _parts(_usage(spark, sf_dir))
    return parts[2].unionByName(parts[3])


@query(f"SELECT * FROM {_ALL}")
def risk_hits(spark, sf_dir):
    return all_hits(spark, sf_dir)


@query(f"""
SELECT {at('window_start - window_start % 3600000')} AS hour, tenant_id, risk_type,
  count(*) AS hits, max(value) AS max_value
FROM {_ALL} GROUP BY ALL""")
def risk_by_hour(spark, sf_dir):
    return risk.risk_distribution(all_hits(spark, sf_dir), "hour", ["tenant_id", "risk_type"])


@query(f"""
SELECT {day('window_start')} AS day, tenant_id, risk_type, entity_type,
  count(*) AS hits, max(value) AS max_value
FROM {_ALL} GROUP BY ALL""")
def risk_by_day(spark, sf_dir):
    return risk.risk_distribution(
        all_hits(spark, sf_dir), "day", ["tenant_id", "risk_type", "entity_type"]
    )


_NOW = A.DAY0_MS + 10 * clock.DAY_MS


@query(f"""
SELECT * FROM {_ALL} WHERE entity_type = 'ip' AND entity = '10.0.0.3'
  AND window_start BETWEEN {_NOW} - 24 * 3600000 AND {_NOW}""")
def entity_evidence(spark, sf_dir):
    """Everything the rules found on one address in the last 24 hours."""
    return risk.evidence(all_hits(spark, sf_dir), "ip", "10.0.0.3", _NOW)


@query(f"""
WITH quality AS (SELECT event_time - event_time % 3600000 AS hour_ms, count(*) AS r,
    count(*) - count(DISTINCT event_id) AS copies,
    count(*) FILTER (WHERE ingest_time - event_time > 600000) AS late
  FROM a_replayed GROUP BY ALL),
counted AS (SELECT window_start - window_start % 3600000 AS hour_ms, count(*) AS hits
  FROM {_ALL} GROUP BY ALL),
merged AS (SELECT hour_ms, coalesce(r, 0) AS r, coalesce(copies, 0) AS copies,
    coalesce(late, 0) AS late, coalesce(hits, 0) AS hits
  FROM quality FULL OUTER JOIN counted USING (hour_ms)),
rated AS (SELECT a.hour_ms, a.hits, coalesce(b.hits, 0) AS hits_before,
    CASE WHEN a.r > 0 THEN CAST(a.copies * 1000000 // a.r AS BIGINT) ELSE 0 END AS copies_ppm,
    CASE WHEN a.r > 0 THEN CAST(a.late * 1000000 // a.r AS BIGINT) ELSE 0 END AS late_ppm
  FROM merged a LEFT JOIN merged b ON a.hour_ms = b.hour_ms + 3600000)
SELECT {at('hour_ms')} AS hour, hits, hits_before, copies_ppm, late_ppm,
  CASE WHEN hits < 2 * greatest(hits_before, 1) THEN 'steady'
    WHEN copies_ppm > 50000 THEN 'duplicated_input' WHEN late_ppm > 100000 THEN 'late_input'
    ELSE 'real_rise' END AS explanation
FROM rated""")
def spike_explanation(spark, sf_dir):
    feed = A.usage_with_replays(_usage(spark, sf_dir))
    return risk.explain_spike(all_hits(spark, sf_dir), feed, "event_id")
