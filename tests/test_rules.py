"""Rule lookup and pricing against brute force; corrections and settlement invariants."""

import random

import pytest
from pyspark.sql import functions as F

from tillstream import schemas as S
from tillstream.operators import ledger, profile, recon, rules, settlement
from tillstream.operators.ordered import latest_per_key

RULE_COLS = (
    "tenant_id string, rule_version int, effective_time long, ingest_time long, pay_method string, "
    "channel_id string, rate_type string, rate_pct double, fixed_fee long, floor_amount long, "
    "cap_amount long"
)


def make_rules(n=40, wild=True, seed=3):
    r = random.Random(seed)
    out = []
    for v in range(1, n + 1):
        t = r.randrange(0, 60)
        out.append(
            (
                "hot" if v % 3 else f"t{r.randrange(3)}", v, t, t + r.randrange(-10, 30),
                r.choice(["*", "wx"]) if wild else "*", r.choice(["*", "c1"]) if wild else "*",
                "percent", 0.01 * v, 0, 0, 500_000,
            )
        )
    return out


def make_pay(n=200, seed=4):
    r = random.Random(seed)
    out = []
    for i in range(n):
        t = r.randrange(-5, 80)
        out.append(
            (i, "hot" if i % 3 else f"t{r.randrange(4)}", r.choice(["wx", "card"]),
             r.choice(["c1", "c2", None]), t, t + r.randrange(0, 25), 1000 * (i + 1))
        )
    return out


PAY_COLS = (
    "i int, tenant_id string, pay_method string, channel_id string, event_time long, "
    "ingest_time long, amount_minor long"
)


def test_rule_before_first_and_default(spark):
    dim = make_rules(wild=False)
    pay = spark.createDataFrame(make_pay(), PAY_COLS)
    got = rules.with_rule(pay, spark.createDataFrame(dim, RULE_COLS)).collect()
    assert len(got) == 200
    for p in got:
        own = [d for d in dim if d[0] == p.tenant_id]
        past = [d for d in own if d[2] <= p.event_time]
        if past:
            want = max(past, key=lambda d: (d[2], d[1]))[1]
        elif own:
            first = min(d[2] for d in own)
            want = max(d[1] for d in own if d[2] == first)
        else:
            want = 0
        assert p.rule.rule_version == want


def test_rules_by_dimension(spark):
    dim = make_rules()
    pay = spark.createDataFrame(make_pay(), PAY_COLS)
    got = rules.with_rule(pay, spark.createDataFrame(dim, RULE_COLS), by_dimension=True).collect()
    assert len(got) == 200
    for p in got:
        fits = [
            d for d in dim
            if d[0] == p.tenant_id and d[2] <= p.event_time
            and d[4] in ("*", p.pay_method) and d[5] in ("*", p.channel_id)
        ]
        general = [d for d in dim if d[0] == p.tenant_id and d[4] == d[5] == "*"]
        if fits:
            want = max(fits, key=lambda d: (2 * (d[4] != "*") + (d[5] != "*"), d[2], d[1]))[1]
        elif general:
            first = min(d[2] for d in general)
            want = max(d[1] for d in general if d[2] == first)
        else:
            want = 0
        assert p.rule.rule_version == want, p


def known(dim, p):
    own = [d for d in dim if d[0] == p.tenant_id]
    fits = [d for d in own if d[2] <= p.event_time and d[3] <= p.ingest_time]
    if fits:
        return max(fits, key=lambda d: (d[2], d[1]))[1]
    if own and not [d for d in own if d[2] <= p.event_time]:
        start = min(d[2] for d in own)
        first = max((d for d in own if d[2] == start), key=lambda d: d[1])
        if first[3] <= p.ingest_time:
            return first[1]
    return 0


@pytest.mark.parametrize("seed", [3, 8])
def test_rules_as_known(spark, seed):
    dim = make_rules(60, wild=False, seed=seed)
    pay = spark.createDataFrame(make_pay(seed=seed), PAY_COLS)
    frame = spark.createDataFrame(dim, RULE_COLS)
    got = rules.with_rule(pay, frame, known_at="ingest_time").collect()
    assert len(got) == 200
    for p in got:
        assert p.rule.rule_version == known(dim, p), p
    late = rules.rule_backfill(pay, frame).collect()
    assert late
    assert all(p.known_rule.rule_version == known(dim, p) != p.rule.rule_version for p in late)


MONEY = (
    "event_type string, tenant_id string, app_id string, order_id string, payment_id string, "
    "user_id string, idempotency_key string, amount_minor long, channel_id string, "
    "pay_method string, event_time long, ingest_time long, trace_id string"
)


def event(kind, key, amount, t, pay="P1", order="O1", **more):
    base = dict(
        event_type=kind, tenant_id="T1", app_id="A", order_id=order, payment_id=pay, user_id="U",
        idempotency_key=key, amount_minor=amount, channel_id="c", pay_method="wx", event_time=t,
        ingest_time=t + 10, trace_id="x",
    )
    return tuple((base | more).values())


@pytest.fixture
def one_rule(spark):
    return spark.createDataFrame(
        [("T1", 1, 0, 0, "*", "*", "percent", 0.03, 0, 0, 500_000),
         ("T1", 2, 100_000, 0, "*", "*", "percent", 0.10, 0, 0, 500_000)], RULE_COLS
    )


def test_corrections_inherit_the_rule_of_the_payment(spark, one_rule):
    rows = [
        event(S.PAY, "a", 1000, 5_000),
        event(S.REFUND, "r1", -400, 200_000),
        event(S.REFUND, "r2", -600, 300_000),
        event(S.PAY, "b", 2000, 150_000, "P2", "O2"),
        event(S.CHARGEBACK, "c", -2000, 400_000, "P2", "O2"),
        event(S.REFUND, "o", -50, 5_000, "GONE", "O3"),
        event(S.ADJUST, "j", -7, 61_000, None, None, channel_id=None, pay_method=None),
    ]
    settled = rules.settled_events(spark.createDataFrame(rows, MONEY), one_rule)
    got = {
        r.idempotency_key: (r.take_rate_rule_version, r.take_rate_amount, r.settlement_amount)
        for r in settled.collect()
    }
    assert got == {
        "a": (1, 30, 970), "r1": (1, -12, -388), "r2": (1, -18, -582), "b": (2, 200, 1800),
        "c": (2, -200, -1800), "o": (None, 0, -50), "j": (None, 0, -7),
    }
    chain = {r.payment_id: r for r in rules.payment_chain(settled).collect()}
    assert (chain["P1"].refund_count, chain["P1"].refund_amount) == (2, 1000)
    assert chain["P1"].settlement_after == 0
    steps = rules.payment_steps(settled).where("payment_id = 'P1'").orderBy("event_time").collect()
    assert [(s.step, s.balance) for s in steps] == [(1, 1000), (2, 600), (3, 0)]
    summary = ledger.ledger_summary(ledger.to_ledger(settled)).first()
    assert (summary.gmv, summary.refund_amount, summary.chargeback_amount) == (3000, 1050, 2000)
    assert (summary.adjust_amount, summary.net_in) == (-7, -57)
    assert summary.total_platform_fee == 230 - 30 - 200
    assert summary.tenant_settle == -57
    minute = settlement.minute_settlement(settled)
    day = settlement.tenant_daily_summary(minute).first()
    assert (day.net_amount, day.settlement_total) == (-57, -57)
    assert {r.stat_minute.minute for r in minute.collect()} == {0, 1, 2, 3, 5, 6}


def test_duplicates_do_not_double(spark, one_rule):
    rows = [event(S.PAY, "a", 1000, 5_000), event(S.REFUND, "r", -400, 200_000)]
    copies = rows + rows + [event(S.PAY, "a", 1000, 5_000, ingest_time=99_999, trace_id="y")]

    def total(data):
        once = latest_per_key(
            spark.createDataFrame(data, MONEY), ["idempotency_key"], ["ingest_time", "trace_id"]
        )
        return settlement.minute_settlement(rules.settled_events(once, one_rule)).collect()

    assert sorted(total(copies)) == sorted(total(rows))


def test_lifecycle(spark):
    rows = [
        event(S.PAY, "a", 1000, 5_000),
        event(S.REFUND, "r1", -700, 4_000),
        event(S.REFUND, "r2", -700, 9_000),
        event(S.PAY, "b", 10, 5_000, "P2", "O2"),
        event(S.PAY, "c", 10, 6_000, "P3", "O2"),
        event(S.CHARGEBACK, "d", -10, 7_000, "GONE", "O9"),
    ]
    got = profile.lifecycle_violations(spark.createDataFrame(rows, MONEY)).collect()
    assert sorted(map(tuple, got)) == [
        ("GONE", "no_payment"), ("O2", "several_payments"), ("O2", "several_successes"),
        ("P1", "correction_before_payment"), ("P1", "refund_above_paid"),
    ]


def test_reconciliation(spark):
    hour = 3_600_000
    src = [event(S.PAY, "a", 5, 0), event(S.PAY, "b", 5, hour), event(S.PAY, "c", 5, 2 * hour),
           event(S.PAY, "c", 5, 2 * hour)]
    dst = [event(S.PAY, "a", 5, 0), event(S.PAY, "c", 5, 2 * hour), event(S.PAY, "d", 5, 3 * hour)]
    frame = recon.reconcile(
        recon.source_counters(spark.createDataFrame(src, MONEY)),
        recon.target_counters(spark.createDataFrame(dst, MONEY)),
    )
    got = {r.recon_hour: (r.recon_status, r.diff_reason, r.diff_pay_count) for r in frame.collect()}
    assert got == {
        8: (1, None, 0), 9: (0, "missing_target", None), 10: (2, "event_count", 1),
        11: (0, "missing_source", -1),
    }
    diff = recon.reconciliation_diff(frame).collect()
    assert [(r.recon_hour, r.diff_analysis) for r in diff] == [(10, "data_loss")]
    again = frame.withColumn("recon_status", F.lit(recon.EQUAL))
    fixed = {r.recon_hour: r.recon_status for r in recon.mark_repaired(frame, again).collect()}
    assert fixed == {8: 1, 9: 0, 10: 3, 11: 0}


def test_verify_ledger(spark, one_rule):
    rows = [event(S.PAY, "a", 1000, 5_000)]
    truth = ledger.ledger_summary(
        ledger.to_ledger(rules.settled_events(spark.createDataFrame(rows, MONEY), one_rule))
    )
    assert ledger.verify_ledger(truth, truth).count() == 0
    wrong = truth.withColumn("gmv", F.col("gmv") + 5)
    diff = ledger.verify_ledger(truth, wrong).collect()
    assert [(r.metric, r.difference) for r in diff] == [("gmv", -5)]
    none = ledger.verify_ledger(truth, truth.where("false"))
    assert none.count() == len(ledger.METRICS)
