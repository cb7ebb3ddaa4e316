"""Signed increments against the batch settlement: any order, repeated and changed deliveries, replays, pruning."""

import random
import re

import pytest
from pyspark.sql import functions as F
from test_streams import DAY, HOUR, MIN, T0, Topic, pay, refund

from tillstream import schemas as S
from tillstream.functions import clock
from tillstream.operators import rules, settlement
from tillstream.operators.ordered import latest_per_key
from tillstream.operators import ingest
from tillstream.streaming import increments, jobs

RULES = (
    "tenant_id string, pay_method string, channel_id string, effective_time long, rule_version int, rate_type string, "
    "rate_pct double, fixed_fee long, floor_amount long, cap_amount long"
)
TWO_RULES = [
    ("T1", "*", "*", T0 - DAY, 1, "percent", 0.1, 0, 0, 10**9),
    ("T1", "*", "*", T0 + HOUR, 2, "percent", 0.2, 0, 0, 10**9),
]


def valid(parsed):
    return ingest.validate_events(parsed).where("dirty_reason is null")


def rules_of(spark):
    return spark.createDataFrame(TWO_RULES, RULES)


def events_of(spark, docs):
    rows = [tuple(d.get(f.name) for f in increments._EVENT) for d in docs]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in increments._EVENT)
    events = spark.createDataFrame(rows, schema)
    return events.withColumn("event_date", clock.stat_date(F.col("event_time")))


def batch_answer(spark, docs):
    once = latest_per_key(events_of(spark, docs), ["idempotency_key"], increments.ORDER)
    settled = rules.settled_events(once, rules_of(spark))
    return sorted(settlement.minute_settlement(settled).collect())


def answer(spark, folder, days=None):
    return sorted(increments.read_minutes(spark, folder, days).collect())


def test_streamed_corrections_before_their_payment(spark, folder, tmp_path):
    docs = [
        [refund("rb", 3 * HOUR, 100) | {"payment_id": "Pb"}, pay("a", 0, 1000, late=5)],
        [refund("ra", 2 * DAY, 500) | {"payment_id": "Pa"}, refund("orphan", 2 * DAY + MIN, 70)],
        [pay("a", 0, 1000), pay("b", 2 * HOUR, 1000)],
    ]
    topic = Topic(str(tmp_path))
    for some in docs:
        topic.add(*some)
    run = jobs.Run(f"{folder}/checkpoint", {"availableNow": True})
    increments.settlement_stream(topic.read(spark), folder, run, valid, rules_of, 4).awaitTermination()
    got = increments.read_minutes(spark, folder).orderBy("stat_minute").collect()
    assert [(r.take_rate_total, r.settlement_total) for r in got] == [(100, 900), (200, 800), (-20, -80), (-50, -450), (0, -70)]


def some_events(seed):
    """Payments, corrections on other days, adjustments, and deliveries with another amount, payment, minute or kind."""
    r = random.Random(seed)
    docs = []
    for i in range(40):
        t = r.randrange(0, 3) * DAY + r.randrange(0, 5) * MIN
        docs.append(pay(f"k{i}", t, r.randrange(100, 5000)))
        if r.random() < 0.6:
            kind = r.choice([S.REFUND, S.CHARGEBACK])
            target = r.choice([f"Pk{r.randrange(40)}", "Pnone", None])
            docs.append(pay(f"c{i}", t + r.randrange(0, 2) * DAY, -r.randrange(1, 90), event_type=kind, payment_id=target))
        if r.random() < 0.2:
            docs.append(pay(f"d{i}", t, r.choice([-50, 70]), event_type=S.ADJUST))
    for d in r.sample(docs, 30):
        again = dict(d)
        if d["event_type"] != S.ADJUST:
            again |= r.choice([{}, {"amount_minor": d["amount_minor"] * 2}, {"payment_id": f"Pk{r.randrange(40)}"}, {"event_time": d["event_time"] + 7 * MIN}])
        again["ingest_time"] = d["ingest_time"] + r.choice([-5, 0, 5])
        docs.append(again)
    docs.append(pay("none", 0, 10, payment_id=None))
    docs.append(pay("none", 0, 20, late=9, payment_id=None))
    r.shuffle(docs)
    return docs


@pytest.mark.parametrize("seed", [1, 2])
def test_any_order_replays_and_folding(spark, folder, seed):
    docs = some_events(seed)
    cut = [docs[i::3] for i in range(3)]
    for n, some in enumerate(cut):
        increments.apply(spark, folder, events_of(spark, some), n, rules_of(spark), 4)
        if n == 1:  # the same batch again
            increments.apply(spark, folder, events_of(spark, some), n, rules_of(spark), 4)
            increments.fold(spark, folder, range(4))
        assert answer(spark, folder) == batch_answer(spark, [d for s in cut[: n + 1] for d in s])
    day = str(answer(spark, folder)[0].stat_date)
    assert answer(spark, folder, [day]) == [r for r in answer(spark, folder) if str(r.stat_date) == day]


def test_a_repeated_delivery_writes_nothing(spark, folder):
    docs = [pay("a", 0, 1000), refund("r", HOUR, 100) | {"payment_id": "Pa"}]
    increments.apply(spark, folder, events_of(spark, docs), 0, rules_of(spark), 4)
    increments.apply(spark, folder, events_of(spark, docs), 1, rules_of(spark), 4)
    for name in ("keys", "payments", "increments"):
        assert {r[0] for r in spark.read.parquet(f"{folder}/{name}").select("batch_id").distinct().collect()} == {0}


def test_a_batch_reads_its_buckets_only(spark, folder):
    docs = [pay(f"k{i}", 0, 1000) for i in range(60)]
    for n in range(2):
        increments.apply(spark, folder, events_of(spark, docs[n::2]), n, rules_of(spark), 16)
    one = increments._stored(spark, f"{folder}/payments", increments.PAYMENT_TABLE, [3], 2)
    plan = one._jdf.queryExecution().toString()
    filters = re.search(r"PartitionFilters: \[([^\]]*)\]", plan)[1]
    assert "bucket" in filters and "batch_id" in filters
    assert {r[0] for r in one.select("bucket").distinct().collect()} == {3}
    files = {r[0] for r in one.select(F.input_file_name()).distinct().collect()}
    assert files and all("bucket=3/" in f for f in files)


def test_empty_batch(spark, folder):
    increments.apply(spark, folder, events_of(spark, [pay("a", 0)]).limit(0), 0, rules_of(spark), 4)
    assert answer(spark, folder) == []
