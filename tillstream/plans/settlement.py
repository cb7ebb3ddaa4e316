"""Queries: ingest, minute metrics, rules, settlement, ledger, reconciliation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream import schemas as S
from tillstream.functions import clock, money
from tillstream.operators import ingest, ledger, ordered, profile, recon, rules, settlement
from tillstream.plans.checkviews import SETTLE_SUMS, clock as at, cols, day, fee, ts
from tillstream.plans.registry import query
from tillstream.session import stage
from tillstream.sources import adapters as A

NOW_MS = 1_704_400_000_000


def valid_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.split(ingest.validate_events(A.a_events(spark, sf_dir)))[0]


def detail_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid events, one per idempotency key: the last to arrive."""
    return ordered.latest_per_key(
        valid_events(spark, sf_dir), ["idempotency_key"], ["ingest_time", "trace_id"]
    )


def stored_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The detail as a stored table, for work that reads it in several branches."""
    return stage(detail_events(spark, sf_dir), "detail")


def settled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.settled_events(stored_detail(spark, sf_dir), A.a_rules(spark, sf_dir))


def minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return settlement.minute_settlement(settled(spark, sf_dir))


def gmv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return settlement.minute_gmv(ingest.valid_for_gmv(A.a_pay(spark, sf_dir)))


# --- minute GMV ------------------------------------------------------------------


@query("SELECT * FROM c_minute_gmv")
def minute_gmv(spark, sf_dir):
    return gmv(spark, sf_dir)


@query("SELECT * FROM c_minute_gmv")
def minute_gmv_salted(spark, sf_dir):
    return settlement.minute_gmv(ingest.valid_for_gmv(A.a_pay(spark, sf_dir)), salt=16)


@query("""
SELECT stat_minute, CAST(sum(net_amount) AS BIGINT) AS net_amount,
  CAST(sum(pay_amount) AS BIGINT) AS pay_amount, CAST(sum(pay_count) AS BIGINT) AS pay_count
FROM c_minute_gmv WHERE stat_date = '2024-01-02' GROUP BY ALL ORDER BY stat_minute DESC LIMIT 30""")
def recent_minutes(spark, sf_dir):
    return settlement.recent_minutes(gmv(spark, sf_dir), "2024-01-02", 30)


@query("""
SELECT * FROM c_minute_gmv WHERE stat_date = '2024-01-02'
ORDER BY stat_minute DESC, tenant_id, app_id, channel_id, pay_method LIMIT 50""")
def recent_lines(spark, sf_dir):
    return settlement.recent_lines(gmv(spark, sf_dir), "2024-01-02", 50)


@query(f"SELECT *, {at(str(NOW_MS))} AS update_time FROM c_minute_gmv")
def minute_table(spark, sf_dir):
    return settlement.to_minute_table(gmv(spark, sf_dir), NOW_MS)


@query(f"""
SELECT *, {at(str(NOW_MS))} AS update_time FROM c_minute_gmv WHERE stat_date = '2024-01-02'
ORDER BY stat_minute, tenant_id, app_id, channel_id, pay_method LIMIT 100""")
def recent_updates(spark, sf_dir):
    """The last hundred lines by update time; of equal times the earliest minutes."""
    table = settlement.to_minute_table(gmv(spark, sf_dir), NOW_MS)
    return settlement.recent_lines(table, "2024-01-02", 100, by="update_time")


# --- ingest ----------------------------------------------------------------------


def _pay_feed(spark, sf_dir):
    return A.a_events(spark, sf_dir).where(F.col("event_type") == S.PAY)


@query(f"""
SELECT {day('event_time')} AS event_date, idempotency_key, tenant_id, app_id, order_id, payment_id,
  user_id, event_type, amount_minor, currency, channel_id, coalesce(pay_method, '') AS pay_method,
  psp, region, trace_id, {at('event_time')} AS event_time, {at('ingest_time')} AS ingest_time,
  data_quality_flag
FROM a_detail WHERE event_type = 'pay_success'""")
def payment_detail(spark, sf_dir):
    """JSON text to validated detail rows, one per key: the whole ingest path."""
    raw = ingest.to_wire(_pay_feed(spark, sf_dir)).select("value")
    valid, _ = ingest.split(ingest.validate_pay(ingest.parse_events(raw)))
    latest = ordered.latest_per_key(valid, ["idempotency_key"], ["ingest_time", "trace_id"])
    return ingest.to_detail(latest, NOW_MS).drop(
        "process_time", "take_rate_rule_version", "take_rate_pct", "take_rate_amount",
        "settlement_amount",
    )


@query(f"""
SELECT {day(str(NOW_MS))} AS event_date, {at(str(NOW_MS))} AS receive_time, dirty_reason, event_type,
  tenant_id, idempotency_key
FROM a_checked WHERE dirty_reason IS NOT NULL""")
def dirty_events(spark, sf_dir):
    raw = ingest.to_wire(_pay_feed(spark, sf_dir)).select("value")
    _, dirty = ingest.split(ingest.validate_pay(ingest.parse_events(raw)))
    rows = ingest.dirty_rows(dirty, NOW_MS, "idempotency_key")
    return rows.drop("raw_payload")


@query("SELECT dirty_reason, count(*) AS cnt FROM a_checked WHERE dirty_reason IS NOT NULL GROUP BY ALL")
def dirty_summary(spark, sf_dir):
    checked = ingest.validate_events(A.a_events(spark, sf_dir))
    return profile.dirty_summary(ingest.split(checked)[1])


@query(f"""
SELECT payment_id AS event_id, event_type, {at('event_time - event_time % 1000')} AS event_time,
  tenant_id, app_id, coalesce(nullif(trim(channel_id), ''), 'unknown') AS channel_id,
  coalesce(nullif(trim(pay_method), ''), 'unknown') AS pay_method, amount_minor
FROM a_events WHERE event_type = 'pay_success'""")
def recovery_detail(spark, sf_dir):
    rows = ingest.to_recovery_detail(_pay_feed(spark, sf_dir), NOW_MS)
    return rows.drop("ingest_time", "update_time")


_PARSED = [c for c in A.EVENT_COLUMNS if c != "n"]


@query(f"SELECT {', '.join(_PARSED)} FROM a_events")
def parsed_events(spark, sf_dir):
    """Typed event columns after a round trip through JSON text."""
    raw = ingest.to_wire(A.a_events(spark, sf_dir)).select("value")
    return ingest.parse_events(raw).select(*_PARSED)


@query("""
SELECT payment_id, list_aggregate(list_filter([
    CASE WHEN amount_minor = 0 THEN 'zero_amount' END,
    CASE WHEN amount_minor < 0 THEN 'negative_amount' END,
    CASE WHEN amount_minor >= 99999999 THEN 'huge_amount' END,
    CASE WHEN channel_id IS NULL THEN 'missing_channel' END,
    CASE WHEN region IS NULL THEN 'missing_region' END,
    CASE WHEN pay_method = 'unknown' THEN 'unknown_method' END,
    CASE WHEN data_quality_flag = 'suspect' OR event_time - ingest_time > 25200000
      THEN 'clock_shift' END], lambda x: x IS NOT NULL), 'string_agg', ',') AS issues
FROM a_noisy
WHERE amount_minor <= 0 OR amount_minor >= 99999999 OR channel_id IS NULL OR region IS NULL
  OR pay_method = 'unknown' OR data_quality_flag = 'suspect'
  OR event_time - ingest_time > 25200000""")
def quality_flags(spark, sf_dir):
    flagged = ingest.quality_flags(A.noisy(A.a_pay(spark, sf_dir)))
    return flagged.where(F.size("quality_issues") > 0).select(
        "payment_id", F.concat_ws(",", "quality_issues").alias("issues")
    )


@query("""
SELECT a.payment_id, a.event_time AS corrected_time, a.event_time = b.event_time AS repaired
FROM a_pay a JOIN a_noisy b USING (payment_id)
WHERE b.data_quality_flag = 'suspect' OR b.event_time - b.ingest_time > 25200000""")
def corrected_time(spark, sf_dir):
    shifted = A.noisy(A.a_pay(spark, sf_dir))
    when = [F.col(c) for c in ("event_time", "ingest_time", "data_quality_flag")]
    fixed = clock.corrected_time(*when)
    return shifted.where(clock.is_shifted(*when)).select(
        "payment_id",
        fixed.alias("corrected_time"),
        (fixed == F.col("event_time")).alias("repaired"),
    )


@query("""
SELECT concat('tp_', CASE event_type WHEN 'take_rate_rule_change' THEN 'take_rate_rule_change'
    WHEN 'refund_success' THEN 'refund_success' WHEN 'chargeback' THEN 'chargeback'
    WHEN 'settlement_adjust' THEN 'settlement_adjust' ELSE 'pay_success' END) AS topic,
  CASE WHEN order_id IS NOT NULL THEN concat(tenant_id, '|', order_id) ELSE tenant_id END AS key,
  idempotency_key
FROM a_events""")
def topic_records(spark, sf_dir):
    routed = ingest.to_topic_records(A.a_events(spark, sf_dir))
    return routed.select(
        "topic", "key", F.get_json_object("value", "$.idempotency_key").alias("idempotency_key")
    )


# --- rules -----------------------------------------------------------------------

_FLAT = [
    "tenant_id", "rule_id", "rule_version", "effective_time", "event_time", "ingest_time",
    "rate_type", "rate_pct", "fixed_fee", "cap_amount", "floor_amount", "pay_method", "channel_id",
]


def _change_events(spark, sf_dir):
    return A.rule_change_events(A.table(spark, sf_dir, "supplier"))


@query(f"SELECT {', '.join(_FLAT)} FROM a_changes")
def rule_changes(spark, sf_dir):
    return ingest.flatten_rule(_change_events(spark, sf_dir)).select(*_FLAT)


@query(f"""
SELECT tenant_id, rule_version, rule_id, {at('effective_time')} AS effective_time, pay_method,
  channel_id, rate_type, CAST(CAST(rate_pct AS DECIMAL(10,6)) AS VARCHAR) AS rate_pct, fixed_fee,
  cap_amount, floor_amount, {at('event_time')} AS publish_time, CAST(NULL AS VARCHAR) AS operator,
  {at('ingest_time')} AS create_time
FROM a_changes""")
def rule_dim(spark, sf_dir):
    return ingest.to_rule_dim(ingest.flatten_rule(_change_events(spark, sf_dir)))


@query("""
SELECT tenant_id, pay_method, channel_id, rule_version, effective_time AS valid_from,
  CAST(lead(effective_time) OVER (PARTITION BY tenant_id, pay_method, channel_id
    ORDER BY effective_time) AS VARCHAR) AS valid_to
FROM (SELECT * FROM a_changes QUALIFY row_number() OVER (
  PARTITION BY tenant_id, pay_method, channel_id, effective_time
  ORDER BY rule_version DESC) = 1)""")
def rule_intervals(spark, sf_dir):
    return rules.rule_intervals(A.a_changes(spark, sf_dir)).select(
        "tenant_id", "pay_method", "channel_id", "rule_version", "valid_from",
        F.col("valid_to").cast("string"),
    )


@query("""
SELECT payment_id, rule_version, take_rate_amount, settlement_amount
FROM c_priced""")
def priced_payments(spark, sf_dir):
    pay = detail_events(spark, sf_dir).where(F.col("event_type") == S.PAY)
    priced = rules.priced(rules.with_rule(pay, A.a_rules(spark, sf_dir)))
    return priced.select(
        "payment_id",
        F.col("take_rate_rule_version").alias("rule_version"),
        "take_rate_amount",
        "settlement_amount",
    )


_RANKED = """
SELECT p.payment_id, p.amount_minor, r.*, row_number() OVER (PARTITION BY p.payment_id ORDER BY
  CASE WHEN r.pay_method <> '*' THEN 2 ELSE 0 END
    + CASE WHEN r.channel_id <> '*' THEN 1 ELSE 0 END DESC,
  r.effective_time DESC, r.rule_version DESC) AS place
FROM a_pay p JOIN a_changes r ON p.tenant_id = r.tenant_id AND r.effective_time <= p.event_time
  AND r.pay_method IN ('*', p.pay_method) AND r.channel_id IN ('*', p.channel_id)"""


@query(f"""
SELECT p.payment_id, coalesce(b.rule_version, f.rule_version, 0) AS rule_version,
  CASE WHEN b.rule_version IS NOT NULL THEN {fee('p.amount_minor', 'b')}
    WHEN f.rule_version IS NOT NULL THEN {fee('p.amount_minor', 'f')}
    ELSE CAST(least(CAST(floor(p.amount_minor * 0.03::DOUBLE + 0.5) AS BIGINT), 500000) AS BIGINT)
  END AS take_rate_amount
FROM a_pay p
LEFT JOIN (SELECT * FROM ({_RANKED}) WHERE place = 1) b ON p.payment_id = b.payment_id
LEFT JOIN (SELECT * FROM a_changes WHERE pay_method = '*' AND channel_id = '*'
  QUALIFY row_number() OVER (PARTITION BY tenant_id ORDER BY effective_time, rule_version DESC) = 1) f
  ON p.tenant_id = f.tenant_id""")
def priced_by_dimension(spark, sf_dir):
    """Rules for a method or channel win over general ones."""
    pay = rules.with_rule(A.a_pay(spark, sf_dir), A.a_changes(spark, sf_dir), by_dimension=True)
    return rules.priced(pay).select(
        "payment_id",
        F.col("take_rate_rule_version").alias("rule_version"),
        "take_rate_amount",
    )


_KNOWN = """
SELECT p.payment_id, coalesce(k.rule_version,
    CASE WHEN f.effective_time > p.event_time AND f.ingest_time <= p.ingest_time
      THEN f.rule_version END, 0) AS known_version,
  coalesce(i.rule_version, f.rule_version, 0) AS rule_version
FROM a_pay p
LEFT JOIN (SELECT payment_id, max(struct_pack(e := effective_time, v := r.rule_version)).v
    AS rule_version FROM a_pay p JOIN a_changes r ON p.tenant_id = r.tenant_id
    AND r.effective_time <= p.event_time AND r.ingest_time <= p.ingest_time
  GROUP BY payment_id) k ON p.payment_id = k.payment_id
LEFT JOIN (SELECT payment_id, max(struct_pack(e := effective_time, v := r.rule_version)).v
    AS rule_version FROM a_pay p JOIN a_changes r ON p.tenant_id = r.tenant_id
    AND r.effective_time <= p.event_time GROUP BY payment_id) i ON p.payment_id = i.payment_id
LEFT JOIN (SELECT * FROM a_changes QUALIFY row_number() OVER (
  PARTITION BY tenant_id ORDER BY effective_time, rule_version DESC) = 1) f
  ON p.tenant_id = f.tenant_id"""


@query(f"SELECT payment_id, known_version AS rule_version FROM ({_KNOWN})")
def priced_as_known(spark, sf_dir):
    """Only rules that had arrived when the payment did."""
    pay = rules.with_rule(
        A.a_pay(spark, sf_dir), A.a_changes(spark, sf_dir), known_at="ingest_time"
    )
    return pay.select("payment_id", F.col("rule.rule_version").alias("rule_version"))


@query(f"""
SELECT payment_id, known_version, rule_version FROM ({_KNOWN})
WHERE known_version <> rule_version""")
def rule_backfill(spark, sf_dir):
    late = rules.rule_backfill(A.a_pay(spark, sf_dir), A.a_changes(spark, sf_dir))
    return late.select(
        "payment_id",
        F.col("known_rule.rule_version").alias("known_version"),
        F.col("rule.rule_version").alias("rule_version"),
    )


# --- corrections -----------------------------------------------------------------


def _fixes_and_pay(spark, sf_dir):
    detail = stored_detail(spark, sf_dir)
    kind = F.col("event_type")
    return detail.where(kind.isin(S.REFUND, S.CHARGEBACK)), detail.where(kind == S.PAY)


@query("""
SELECT idempotency_key, payment_id, amount_minor, coalesce(paid_time, -1) AS paid_time,
  coalesce(paid_amount, -1) AS paid_amount FROM c_fixes""")
def corrections_with_payment(spark, sf_dir):
    fixes, pay = _fixes_and_pay(spark, sf_dir)
    return rules.attach_payment(fixes, pay).select(
        "idempotency_key",
        "payment_id",
        "amount_minor",
        F.coalesce("paid.event_time", F.lit(-1)).alias("paid_time"),
        F.coalesce("paid.amount_minor", F.lit(-1)).alias("paid_amount"),
    )


@query("""
SELECT idempotency_key, amount_minor, coalesce(take_rate_rule_version, -1) AS take_rate_rule_version,
  take_rate_amount, settlement_amount
FROM c_fixes""")
def correction_legs(spark, sf_dir):
    fixes, pay = _fixes_and_pay(spark, sf_dir)
    priced = rules.with_rule(pay, A.a_rules(spark, sf_dir))
    return rules.priced_corrections(rules.attach_payment(fixes, priced)).select(
        "idempotency_key",
        "amount_minor",
        "take_rate_rule_version",
        "take_rate_amount",
        "settlement_amount",
    ).na.fill(-1)


@query("SELECT idempotency_key, payment_id, amount_minor FROM c_fixes WHERE NOT has_payment")
def orphan_corrections(spark, sf_dir):
    fixes, pay = _fixes_and_pay(spark, sf_dir)
    return rules.orphans(fixes, pay).select("idempotency_key", "payment_id", "amount_minor")


_FIX = "event_type <> 'pay_success'"


@query(f"""
SELECT payment_id,
  coalesce(max(take_rate_rule_version) FILTER (WHERE event_type = 'pay_success'), -1) AS rule_version,
  CAST(coalesce(sum(amount_minor) FILTER (WHERE event_type = 'pay_success'), -1) AS BIGINT) AS pay_amount,
  CAST(coalesce(sum(take_rate_amount) FILTER (WHERE event_type = 'pay_success'), -1) AS BIGINT) AS fee_amount,
  CAST(coalesce(sum(settlement_amount) FILTER (WHERE event_type = 'pay_success'), -1) AS BIGINT) AS settlement_amount,
  count(*) FILTER (WHERE event_type = 'refund_success') AS refund_count,
  CAST(coalesce(sum(-amount_minor) FILTER (WHERE event_type = 'refund_success'), 0) AS BIGINT) AS refund_amount,
  count(*) FILTER (WHERE event_type = 'chargeback') AS chargeback_count,
  CAST(coalesce(sum(-amount_minor) FILTER (WHERE event_type = 'chargeback'), 0) AS BIGINT) AS chargeback_amount,
  CAST(sum(take_rate_amount) AS BIGINT) AS fee_after,
  CAST(sum(settlement_amount) AS BIGINT) AS settlement_after,
  coalesce(min(event_time) FILTER (WHERE {_FIX}), -1) AS first_fix_time,
  coalesce(max(event_time) FILTER (WHERE {_FIX}), -1) AS last_fix_time
FROM c_settled WHERE payment_id IS NOT NULL GROUP BY payment_id""")
def payment_chain(spark, sf_dir):
    return rules.payment_chain(settled(spark, sf_dir)).na.fill(-1)


@query("""
SELECT payment_id, event_time, events,
  CAST(sum(events) OVER w AS BIGINT) AS step, change,
  CAST(sum(change) OVER w AS BIGINT) AS balance,
  CAST(sum(settled) OVER w AS BIGINT) AS settlement_balance
FROM (SELECT payment_id, event_time, count(*) AS events, CAST(sum(amount_minor) AS BIGINT) AS change,
    sum(settlement_amount) AS settled
  FROM c_settled WHERE payment_id IS NOT NULL GROUP BY ALL)
WINDOW w AS (PARTITION BY payment_id ORDER BY event_time)""")
def payment_steps(spark, sf_dir):
    return rules.payment_steps(settled(spark, sf_dir))


_AUDIT = """
SELECT payment_id FROM c_settled WHERE event_type = 'pay_success'
ORDER BY md5(payment_id), payment_id LIMIT 100"""


@query(f"""
SELECT s.payment_id, s.idempotency_key, s.amount_minor, s.take_rate_rule_version,
  s.take_rate_amount, s.settlement_amount
FROM c_settled s SEMI JOIN ({_AUDIT}) a ON s.payment_id = a.payment_id""")
def audit_sample(spark, sf_dir):
    """A fixed random hundred payments with rule, fee and correction chain."""
    rows = stage(settled(spark, sf_dir), "settled")
    chosen = profile.audit_sample(rows.where(F.col("event_type") == S.PAY), "payment_id", 100)
    return rows.join(F.broadcast(chosen), "payment_id", "left_semi").select(
        "payment_id", "idempotency_key", "amount_minor", "take_rate_rule_version",
        "take_rate_amount", "settlement_amount",
    )


# --- settlement cube -------------------------------------------------------------


@query("SELECT * FROM c_minute")
def minute_settlement(spark, sf_dir):
    return minutes(spark, sf_dir)


@query(f"""
SELECT stat_date, CAST(substring(stat_minute, 12, 2) AS BIGINT) AS stat_hour, tenant_id, app_id,
  {SETTLE_SUMS}
FROM c_minute GROUP BY ALL""")
def hour_settlement(spark, sf_dir):
    return settlement.hour_settlement(minutes(spark, sf_dir))


@query(f"SELECT stat_date, tenant_id, {SETTLE_SUMS} FROM c_minute GROUP BY ALL")
def tenant_daily_summary(spark, sf_dir):
    return settlement.tenant_daily_summary(minutes(spark, sf_dir))


@query("""
SELECT stat_minute, CAST(sum(net_amount) AS BIGINT) AS net_amount,
  CAST(sum(pay_amount) AS BIGINT) AS pay_amount, CAST(sum(pay_count) AS BIGINT) AS pay_count
FROM c_minute WHERE stat_date = '2024-01-03' GROUP BY ALL ORDER BY stat_minute DESC LIMIT 30""")
def net_income_trend(spark, sf_dir):
    return settlement.recent_minutes(minutes(spark, sf_dir), "2024-01-03", 30)


@query("SELECT * FROM c_minute WHERE stat_date IN ('2024-01-02', '2024-01-04')")
def rebuilt_minutes(spark, sf_dir):
    return settlement.rebuild_minutes(settled(spark, sf_dir), ["2024-01-02", "2024-01-04"])


@query(f"""
SELECT event_type, {day('event_time')} AS stat_date, count(*) AS events,
  CAST(sum(CASE event_type WHEN 'pay_success' THEN amount_minor ELSE 0 END) AS BIGINT) AS pay_amount,
  CAST(sum(CASE event_type WHEN 'refund_success' THEN -amount_minor ELSE 0 END) AS BIGINT) AS refund_amount,
  CAST(sum(CASE event_type WHEN 'chargeback' THEN -amount_minor ELSE 0 END) AS BIGINT) AS chargeback_amount,
  CAST(sum(CASE event_type WHEN 'settlement_adjust' THEN amount_minor ELSE 0 END) AS BIGINT) AS adjust_amount,
  CAST(sum(amount_minor) AS BIGINT) AS net_amount
FROM a_valid GROUP BY ALL""")
def event_increments(spark, sf_dir):
    """The increment vector of each event type, summed by day."""
    events = valid_events(spark, sf_dir)
    made = settlement.increments(F.col("event_type"), F.col("amount_minor"))
    shown = ["pay_amount", "refund_amount", "chargeback_amount", "adjust_amount", "net_amount"]
    return events.groupBy(
        "event_type", clock.stat_date(F.col("event_time")).alias("stat_date")
    ).agg(F.count("*").alias("events"), *[F.sum(made[c]).alias(c) for c in shown])


# --- ledger ----------------------------------------------------------------------


@query("SELECT * FROM c_ledger")
def ledger_detail(spark, sf_dir):
    return ledger.to_ledger(settled(spark, sf_dir))


@query("SELECT * FROM c_summary")
def ledger_summary(spark, sf_dir):
    return ledger.ledger_summary(ledger.to_ledger(settled(spark, sf_dir)))


_TOTALS = {
    "gmv": "gmv", "refund": "refund_amount", "chargeback": "chargeback_amount",
    "adjust": "adjust_amount", "platform_fee": "total_platform_fee", "net_in": "net_in",
}


@query(
    "SELECT "
    + ", ".join(f"CAST(sum({c}) AS BIGINT) AS total_{n}" for n, c in _TOTALS.items())
    + ", "
    + ", ".join(
        f"CAST(CAST(CAST(sum({c}) AS DECIMAL(30,0)) / 100 AS DECIMAL(30,2)) AS VARCHAR)"
        f" AS total_{n}_yuan"
        for n, c in _TOTALS.items()
    )
    + " FROM c_summary"
)
def ledger_totals(spark, sf_dir):
    return ledger.ledger_totals(
        ledger.ledger_summary(ledger.to_ledger(settled(spark, sf_dir)))
    )


def _legs(kind: str, name: str) -> str:
    own = f"FILTER (WHERE event_type = '{kind}')"
    sign = "" if kind in ("pay_success", "settlement_adjust") else "-"
    count, amount = ("pay_count", "gmv") if name == "pay" else (f"{name}_count", f"{name}_amount")
    return f"count(*) {own} AS {count}, CAST(coalesce(sum({sign}amount_minor) {own}, 0) AS BIGINT) AS {amount}"


_GOT = f"""
SELECT *, gmv - refund_amount - chargeback_amount + adjust_amount AS net_in,
  CAST(0 AS BIGINT) AS platform_fee, CAST(0 AS BIGINT) AS platform_fee_refund,
  CAST(0 AS BIGINT) AS platform_fee_chargeback, CAST(0 AS BIGINT) AS total_platform_fee,
  gmv - refund_amount - chargeback_amount + adjust_amount AS tenant_settle
FROM (SELECT tenant_id, {day('event_time')} AS date, {_legs('pay_success', 'pay')},
    {_legs('refund_success', 'refund')}, {_legs('chargeback', 'chargeback')},
    {_legs('settlement_adjust', 'adjust')}
  FROM a_valid WHERE tenant_id <> 'T0002' GROUP BY ALL)"""

_PAIRS = ", ".join(
    f"struct_pack(metric := '{m}', expected := CAST(t.{m} AS BIGINT), actual := CAST(g.{m} AS BIGINT))"
    for m in ledger.METRICS
)


@query(f"""
SELECT tenant_id, date, m.metric, m.expected, m.actual,
  coalesce(m.expected, 0) - coalesce(m.actual, 0) AS difference
FROM (SELECT coalesce(t.tenant_id, g.tenant_id) AS tenant_id, coalesce(t.date, g.date) AS date,
    unnest([{_PAIRS}]) AS m
  FROM (SELECT * FROM c_summary WHERE tenant_id <> 'T0003') t
  FULL JOIN ({_GOT}) g ON t.tenant_id = g.tenant_id AND t.date = g.date)
WHERE m.expected IS DISTINCT FROM m.actual""")
def ledger_check(spark, sf_dir):
    """A ledger without one tenant against a computation that forgot to deduplicate, to price and
    another tenant: the check must find every metric of every tenant-day that differs."""
    truth = ledger.ledger_summary(ledger.to_ledger(settled(spark, sf_dir)))
    careless = valid_events(spark, sf_dir).withColumns(
        {
            "take_rate_rule_version": F.lit(None).cast("int"),
            "take_rate_pct": F.lit(None).cast("double"),
            "take_rate_amount": F.lit(0).cast("bigint"),
            "settlement_amount": F.col("amount_minor"),
        }
    )
    got = ledger.ledger_summary(ledger.to_ledger(careless.where("tenant_id <> 'T0002'")))
    return ledger.verify_ledger(truth.where("tenant_id <> 'T0003'"), got)


# --- reconciliation --------------------------------------------------------------


@query("SELECT * FROM c_src")
def source_counters(spark, sf_dir):
    return recon.source_counters(A.a_events(spark, sf_dir))


@query("SELECT * FROM c_dst")
def target_counters(spark, sf_dir):
    return recon.target_counters(detail_events(spark, sf_dir))


def _recon(spark, sf_dir):
    return recon.reconcile(
        recon.source_counters(A.a_events(spark, sf_dir)),
        recon.target_counters(detail_events(spark, sf_dir)),
    )


@query("SELECT * FROM c_recon")
def reconciliation(spark, sf_dir):
    return _recon(spark, sf_dir)


@query("""
SELECT recon_date, recon_hour, tenant_id, src_pay_count, dst_pay_count, src_pay_amount,
  dst_pay_amount, diff_pay_count, diff_pay_amount, diff_reason, recon_status,
  CASE WHEN diff_pay_count > 0 AND diff_pay_amount > 0 THEN 'data_loss'
    WHEN diff_pay_count < 0 AND diff_pay_amount < 0 THEN 'data_duplicate'
    WHEN diff_pay_count = 0 AND diff_pay_amount <> 0 THEN 'amount_mismatch'
    WHEN recon_status = 0 THEN 'pending' ELSE 'unknown' END AS diff_analysis
FROM c_recon WHERE recon_status = 2""")
def reconciliation_diff(spark, sf_dir):
    return recon.reconciliation_diff(_recon(spark, sf_dir))


@query("""
SELECT * EXCLUDE (event_type, n) FROM a_events QUALIFY row_number() OVER (
  PARTITION BY idempotency_key ORDER BY ingest_time DESC, trace_id DESC) = 1""")
def latest_per_key(spark, sf_dir):
    return ordered.latest_per_key(
        A.a_events(spark, sf_dir).drop("event_type", "n"),
        ["idempotency_key"],
        ["ingest_time", "trace_id"],
    )
