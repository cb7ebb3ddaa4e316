"""Checking SQL: the adapter views and shared steps, written for a plain SQL engine.

Only column formulas come from the adapters; rows are built here by unions,
joins and window functions, independently of the Spark operators.
"""

from __future__ import annotations

from tillstream import schemas as S
from tillstream.sources import adapters as A


def ts(ms: str) -> str:
    """Epoch ms to local TIMESTAMP."""
    return f"(make_timestamp(({ms}) * 1000) + interval 8 hour)"


def clock(ms: str) -> str:
    return f"strftime({ts(ms)}, '%Y-%m-%d %H:%M:%S.%g')"


def day(ms: str) -> str:
    return f"strftime({ts(ms)}, '%Y-%m-%d')"


def minute(ms: str) -> str:
    return f"strftime(date_trunc('minute', {ts(ms)}), '%Y-%m-%d %H:%M:%S.000')"


def cols(exprs: dict[str, str]) -> str:
    return ", ".join(f"{sql} AS {name}" for name, sql in exprs.items())


METHODS = ", ".join(f"'{m}'" for m in S.PAY_METHODS)


def fee(amount: str, r: str = "") -> str:
    p = f"{r}." if r else ""
    raw = (
        f"(CASE WHEN {p}rate_type = 'fixed' THEN {p}fixed_fee ELSE "
        f"CAST(floor(CAST({amount} AS DOUBLE) * {p}rate_pct + 0.5) AS BIGINT) + {p}fixed_fee END)"
    )
    floored = f"(CASE WHEN {p}floor_amount > 0 AND {raw} < {p}floor_amount THEN {p}floor_amount ELSE {raw} END)"
    return f"CAST(CASE WHEN {p}cap_amount > 0 AND {floored} > {p}cap_amount THEN {p}cap_amount ELSE {floored} END AS BIGINT)"


SETTLE_SUMS = ", ".join(f"CAST(sum({m}) AS BIGINT) AS {m}" for m in S.SETTLEMENT_METRICS)


def counters(prefix: str) -> str:
    return f"""
count(*) FILTER (WHERE event_type = 'pay_success') AS {prefix}_pay_count,
CAST(coalesce(sum(abs(amount_minor)) FILTER (WHERE event_type = 'pay_success'), 0) AS BIGINT) AS {prefix}_pay_amount,
count(*) FILTER (WHERE event_type = 'refund_success') AS {prefix}_refund_count,
CAST(coalesce(sum(abs(amount_minor)) FILTER (WHERE event_type = 'refund_success'), 0) AS BIGINT) AS {prefix}_refund_amount,
count(*) AS {prefix}_event_count"""


VIEWS = {
    "a_base": f"SELECT {cols(A.PAY_BASE)} FROM orders JOIN customer ON o_custkey = c_custkey",
    "a_pay": f"SELECT {cols(A.PAY)} FROM a_base",
    "a_noisy": """SELECT * REPLACE (
        CASE WHEN n % 500 = 4 THEN event_time + 28800000 ELSE event_time END AS event_time,
        CASE WHEN n % 500 = 4 THEN 'suspect' ELSE data_quality_flag END AS data_quality_flag)
        FROM a_pay""",
    "a_refund_parts": """
        SELECT *, 1 AS part FROM a_pay WHERE amount_minor > 0 AND n % 40 = 3
        UNION ALL
        SELECT *, 2 AS part FROM a_pay WHERE amount_minor > 0 AND n % 40 = 3 AND n % 80 <> 3""",
    "a_refund": f"""
        SELECT * EXCLUDE (part, event_type, idempotency_key, amount_minor, event_time, ingest_time),
          'refund_success' AS event_type,
          concat('REF', n, CASE part WHEN 2 THEN '_2' ELSE '' END) AS refund_id,
          concat('REF_REF', n, CASE part WHEN 2 THEN '_2' ELSE '' END) AS idempotency_key,
          CASE WHEN n % 80 = 3 THEN -amount_minor
               WHEN part = 1 THEN -CAST(floor(amount_minor / 2.0) AS BIGINT)
               ELSE -(amount_minor - CAST(floor(amount_minor / 2.0) AS BIGINT)) END AS amount_minor,
          event_time + 60000 + (n * 104729) % 259140000 + (part - 1) * 1800000 AS event_time,
          event_time + 60000 + (n * 104729) % 259140000 + (part - 1) * 1800000
            + {A.delay('n + 17')} AS ingest_time,
          'user_request' AS refund_reason
        FROM a_refund_parts""",
    "a_chargeback": f"""
        SELECT * REPLACE ('chargeback' AS event_type, concat('CB_CB', n) AS idempotency_key,
          -amount_minor AS amount_minor,
          event_time + 3600000 + (n * 104729) % 601200000 AS event_time,
          event_time + 3600000 + (n * 104729) % 601200000 + {A.delay('n + 29')} AS ingest_time),
          concat('CB', n) AS chargeback_id
        FROM a_pay WHERE amount_minor > 0 AND n % 1000 = 9""",
    "a_adjust": f"""
        SELECT * EXCLUDE (order_id, payment_id, channel_id, pay_method, psp, region)
          REPLACE ('settlement_adjust' AS event_type, concat('ADJ_ADJ', n) AS idempotency_key,
            (n % 3 - 1) * (100 + n % 50000) AS amount_minor,
            event_time + {A.delay('n + 5')} AS ingest_time),
          concat('ADJ', n) AS adjust_id, 'none' AS ref_type,
          'manual_adjustment' AS adjust_reason
        FROM a_pay WHERE amount_minor > 0 AND n % 500 = 13 AND n % 3 <> 1""",
    "a_orphan": f"""
        SELECT * REPLACE ('refund_success' AS event_type, concat('REF_REFX', n) AS idempotency_key,
          concat('PAY_MISSING_', n) AS payment_id, -amount_minor AS amount_minor,
          event_time + 60000 + (n * 104729) % 259140000 AS event_time,
          event_time + 60000 + (n * 104729) % 259140000 + {A.delay('n + 17')} AS ingest_time),
          concat('REFX', n) AS refund_id, 'user_request' AS refund_reason
        FROM a_pay WHERE amount_minor > 0 AND n % 4000 = 21""",
    "a_events": """
        SELECT * FROM a_pay
        UNION ALL BY NAME SELECT * FROM a_refund
        UNION ALL BY NAME SELECT * FROM a_chargeback
        UNION ALL BY NAME SELECT * FROM a_adjust
        UNION ALL BY NAME SELECT * FROM a_orphan
        UNION ALL BY NAME SELECT * FROM a_pay WHERE n % 200 = 7
        UNION ALL BY NAME SELECT * REPLACE (concat('TRX', n) AS trace_id,
            ingest_time + 2500 AS ingest_time) FROM a_pay WHERE n % 300 = 11
        UNION ALL BY NAME SELECT * REPLACE (ingest_time + 600000 AS ingest_time)
            FROM a_pay WHERE n % 500 = 2""",
    "a_checked": f"""
        SELECT *, CASE
          WHEN event_type IN ('refund_success', 'chargeback') THEN
            CASE WHEN amount_minor >= 0 THEN concat('amount_ge_zero:', amount_minor) END
          WHEN event_type = 'settlement_adjust' THEN NULL
          WHEN amount_minor <= 0 THEN concat('amount_le_zero:', amount_minor)
          WHEN pay_method <> '' AND pay_method NOT IN ({METHODS})
            THEN concat('invalid_pay_method:', pay_method) END AS dirty_reason
        FROM a_events""",
    "a_valid": "SELECT * EXCLUDE (dirty_reason) FROM a_checked WHERE dirty_reason IS NULL",
    "a_detail": """
        SELECT * FROM a_valid QUALIFY row_number() OVER (
          PARTITION BY idempotency_key ORDER BY ingest_time DESC, trace_id DESC) = 1""",
    "a_gmv": """
        SELECT * REPLACE (coalesce(nullif(trim(channel_id), ''), 'unknown_channel') AS channel_id,
          coalesce(nullif(trim(pay_method), ''), 'unknown_pay_method') AS pay_method)
        FROM a_pay WHERE amount_minor > 0""",
    "c_minute_gmv": f"""
        SELECT {day('event_time')} AS stat_date, {minute('event_time')} AS stat_minute,
          tenant_id, app_id, channel_id, pay_method, count(*) AS pay_count,
          CAST(sum(amount_minor) AS BIGINT) AS pay_amount,
          CAST(sum(amount_minor) AS BIGINT) AS net_amount
        FROM a_gmv GROUP BY ALL""",
    "a_versions": """
        SELECT CAST(n_nationkey + 1 AS BIGINT) AS t, CAST(v AS BIGINT) AS v
        FROM nation, range(1, 4) AS r(v)
        WHERE (n_nationkey + 1) % 5 <> 0 AND NOT ((n_nationkey + 1) % 7 = 0 AND v = 1)""",
    "a_rules": f"""
        SELECT *, effective_time - 300000 + (t % 3) * 600000 AS ingest_time
        FROM (SELECT {cols(A.RULE_BASE)} FROM a_versions)""",
    "a_changes_base": f"""
        SELECT *, effective_time - (k * 131071) % 3600000 AS event_time
        FROM (SELECT {cols(A.CHANGE)} FROM supplier)""",
    "a_changes": """
        SELECT *, CASE WHEN k % 10 < 3 THEN effective_time + (k * 791900) % 1800000
          ELSE event_time + (k * 37) % 30000 END AS ingest_time
        FROM a_changes_base""",
    # Rule of every valid payment, by the latest effective time not after it.
    "c_ruled": """
        SELECT p.*, coalesce(r.rule_version, f.rule_version, 0) AS rule_version,
          coalesce(r.rate_type, f.rate_type, 'percent') AS rate_type,
          coalesce(r.rate_pct, f.rate_pct, 0.03) AS rate_pct,
          coalesce(r.fixed_fee, f.fixed_fee, 0) AS fixed_fee,
          coalesce(r.floor_amount, f.floor_amount, 0) AS floor_amount,
          coalesce(r.cap_amount, f.cap_amount, 500000) AS cap_amount
        FROM a_detail p
        ASOF LEFT JOIN a_rules r
          ON p.tenant_id = r.tenant_id AND p.event_time >= r.effective_time
        LEFT JOIN (SELECT * FROM a_rules QUALIFY row_number() OVER (
          PARTITION BY tenant_id ORDER BY effective_time, rule_version DESC) = 1) f
          ON p.tenant_id = f.tenant_id
        WHERE p.event_type = 'pay_success'""",
    "c_priced": f"""
        SELECT *, rule_version AS take_rate_rule_version, rate_pct AS take_rate_pct,
          {fee('amount_minor')} AS take_rate_amount,
          amount_minor - {fee('amount_minor')} AS settlement_amount
        FROM c_ruled""",
    "c_fixes": f"""
        SELECT d.*, p.payment_id IS NOT NULL AS has_payment, p.event_time AS paid_time,
          p.amount_minor AS paid_amount,
          p.rule_version AS take_rate_rule_version, p.rate_pct AS take_rate_pct,
          CASE WHEN p.payment_id IS NULL THEN 0 ELSE -{fee('abs(d.amount_minor)', 'p')} END
            AS take_rate_amount,
          CASE WHEN p.payment_id IS NULL THEN d.amount_minor
            ELSE -(abs(d.amount_minor) - {fee('abs(d.amount_minor)', 'p')}) END AS settlement_amount
        FROM a_detail d LEFT JOIN c_ruled p ON d.payment_id = p.payment_id
        WHERE d.event_type IN ('refund_success', 'chargeback')""",
    "c_settled": """
        SELECT * EXCLUDE (rule_version, rate_type, rate_pct, fixed_fee, floor_amount, cap_amount)
        FROM c_priced
        UNION ALL BY NAME SELECT * EXCLUDE (has_payment, paid_time, paid_amount) FROM c_fixes
        UNION ALL BY NAME SELECT *, 0 AS take_rate_amount, amount_minor AS settlement_amount
        FROM a_detail WHERE event_type = 'settlement_adjust'""",
    "c_minute": f"""
        SELECT {day('event_time')} AS stat_date, {minute('event_time')} AS stat_minute,
          tenant_id, app_id,
          coalesce(nullif(trim(channel_id), ''), 'unknown_channel') AS channel_id,
          coalesce(nullif(trim(pay_method), ''), 'unknown_pay_method') AS pay_method,
          count(*) FILTER (WHERE event_type = 'pay_success') AS pay_count,
          CAST(coalesce(sum(amount_minor) FILTER (WHERE event_type = 'pay_success'), 0) AS BIGINT) AS pay_amount,
          count(*) FILTER (WHERE event_type = 'refund_success') AS refund_count,
          CAST(coalesce(sum(abs(amount_minor)) FILTER (WHERE event_type = 'refund_success'), 0) AS BIGINT) AS refund_amount,
          count(*) FILTER (WHERE event_type = 'chargeback') AS chargeback_count,
          CAST(coalesce(sum(abs(amount_minor)) FILTER (WHERE event_type = 'chargeback'), 0) AS BIGINT) AS chargeback_amount,
          count(*) FILTER (WHERE event_type = 'settlement_adjust') AS adjust_count,
          CAST(coalesce(sum(amount_minor) FILTER (WHERE event_type = 'settlement_adjust'), 0) AS BIGINT) AS adjust_amount,
          CAST(sum(amount_minor) AS BIGINT) AS net_amount,
          CAST(sum(take_rate_amount) AS BIGINT) AS take_rate_total,
          CAST(sum(settlement_amount) AS BIGINT) AS settlement_total
        FROM c_settled GROUP BY ALL""",
    "c_ledger": f"""
        SELECT tenant_id, app_id, order_id, payment_id, event_type, event_time,
          {day('event_time')} AS date,
          coalesce(take_rate_rule_version, 0) AS rule_version,
          coalesce(take_rate_pct, 0) AS rate_pct,
          CASE WHEN event_type IN ('refund_success', 'chargeback') THEN -amount_minor
            ELSE amount_minor END AS amount_minor,
          CASE WHEN event_type IN ('refund_success', 'chargeback') THEN -take_rate_amount
            ELSE take_rate_amount END AS platform_fee,
          CASE WHEN event_type IN ('refund_success', 'chargeback') THEN -settlement_amount
            ELSE settlement_amount END AS settlement_amount
        FROM c_settled""",
    "c_ledger_legs": """
        SELECT tenant_id, date,
          count(*) FILTER (WHERE event_type = 'pay_success') AS pay_count,
          CAST(coalesce(sum(amount_minor) FILTER (WHERE event_type = 'pay_success'), 0) AS BIGINT) AS gmv,
          count(*) FILTER (WHERE event_type = 'refund_success') AS refund_count,
          CAST(coalesce(sum(amount_minor) FILTER (WHERE event_type = 'refund_success'), 0) AS BIGINT) AS refund_amount,
          count(*) FILTER (WHERE event_type = 'chargeback') AS chargeback_count,
          CAST(coalesce(sum(amount_minor) FILTER (WHERE event_type = 'chargeback'), 0) AS BIGINT) AS chargeback_amount,
          count(*) FILTER (WHERE event_type = 'settlement_adjust') AS adjust_count,
          CAST(coalesce(sum(amount_minor) FILTER (WHERE event_type = 'settlement_adjust'), 0) AS BIGINT) AS adjust_amount,
          CAST(coalesce(sum(platform_fee) FILTER (WHERE event_type = 'pay_success'), 0) AS BIGINT) AS platform_fee,
          CAST(coalesce(sum(platform_fee) FILTER (WHERE event_type = 'refund_success'), 0) AS BIGINT) AS platform_fee_refund,
          CAST(coalesce(sum(platform_fee) FILTER (WHERE event_type = 'chargeback'), 0) AS BIGINT) AS platform_fee_chargeback
        FROM c_ledger GROUP BY ALL""",
    "c_summary": """
        SELECT *, gmv - refund_amount - chargeback_amount + adjust_amount AS net_in,
          platform_fee - platform_fee_refund - platform_fee_chargeback AS total_platform_fee,
          gmv - refund_amount - chargeback_amount + adjust_amount
            - (platform_fee - platform_fee_refund - platform_fee_chargeback) AS tenant_settle
        FROM c_ledger_legs""",
    "c_src": f"""
        SELECT {day('event_time')} AS recon_date,
          CAST(date_part('hour', {ts('event_time')}) AS BIGINT) AS recon_hour, tenant_id,
          {counters('src')}
        FROM a_events GROUP BY ALL""",
    "c_dst": f"""
        SELECT {day('event_time')} AS recon_date,
          CAST(date_part('hour', {ts('event_time')}) AS BIGINT) AS recon_hour, tenant_id,
          {counters('dst')}
        FROM a_detail GROUP BY ALL""",
    "c_joined": """
        SELECT recon_date, recon_hour, tenant_id,
          s.recon_date IS NOT NULL AS has_src, d.recon_date IS NOT NULL AS has_dst,
          coalesce(src_pay_count, 0) AS src_pay_count,
          coalesce(src_pay_amount, 0) AS src_pay_amount,
          coalesce(src_refund_count, 0) AS src_refund_count,
          coalesce(src_refund_amount, 0) AS src_refund_amount,
          coalesce(src_event_count, 0) AS src_event_count,
          dst_pay_count, dst_pay_amount, dst_refund_count, dst_refund_amount, dst_event_count
        FROM c_src s FULL OUTER JOIN c_dst d USING (recon_date, recon_hour, tenant_id)""",
    "c_recon": """
        SELECT * EXCLUDE (has_src, has_dst),
          src_pay_count - dst_pay_count AS diff_pay_count,
          src_pay_amount - dst_pay_amount AS diff_pay_amount,
          CASE WHEN NOT has_src THEN 'missing_source' WHEN NOT has_dst THEN 'missing_target'
            WHEN src_event_count <> dst_event_count THEN 'event_count'
            WHEN src_pay_count <> dst_pay_count THEN 'pay_count'
            WHEN src_pay_amount <> dst_pay_amount THEN 'pay_amount'
            WHEN src_refund_count <> dst_refund_count THEN 'refund_count'
            WHEN src_refund_amount <> dst_refund_amount THEN 'refund_amount' END AS diff_reason,
          CAST(CASE WHEN NOT has_src OR NOT has_dst THEN 0
            WHEN src_event_count = dst_event_count AND src_pay_count = dst_pay_count
              AND src_pay_amount = dst_pay_amount AND src_refund_count = dst_refund_count
              AND src_refund_amount = dst_refund_amount THEN 1 ELSE 2 END AS BIGINT) AS recon_status
        FROM c_joined""",
    "a_usage_base": f"""
        SELECT {cols(A.USAGE)}, concat('D', json_extract_string(props, '$.k')) AS device_id,
          epoch_us(ts) // 1000 AS event_time FROM events""",
    "a_usage": f"SELECT *, event_time + {A.delay('event_id')} AS ingest_time FROM a_usage_base",
    "a_replayed": """
        SELECT *, 0 AS delivery FROM a_usage
        UNION ALL SELECT *, 1 AS delivery FROM a_usage WHERE event_id % 50 = 3""",
    "a_quotas": f"SELECT {cols(A.QUOTA)} FROM supplier",
}
