"""What a stream costs: rows are computed once, only wanted fields are read, state lies outside the heap."""

import json

from pyspark.sql import functions as F
from test_increments import answer, batch_answer, events_of, rules_of
from test_streams import HOUR, MIN, Topic, pay

from tillstream.operators import ingest, ordered
from tillstream.plans import streams
from tillstream.streaming import increments, jobs


def test_topic_rows_are_computed_once(spark, folder):
    made = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def at(i):
        made.add(1)
        return i * 7 % 1_200

    rows = spark.range(1_200).select(at("id").alias("at"))
    sample = spark.range(0, 1_200, 10).select(F.col("id").alias("at"))
    stream = streams.as_topic(rows, "at", "topic", 1_200, sample=sample)
    assert made.value == 1_200
    seen = []
    keep = lambda batch, i: seen.append(sorted(r[0] for r in batch.collect()))
    jobs.start(stream, keep, jobs.Run(f"{folder}/c", streams.ONCE)).awaitTermination()
    assert len(seen) == streams.TOPIC_BATCHES and sum(seen, []) == list(range(1_200))


def test_only_wanted_fields_are_read(spark):
    texts = [
        {"tenant_id": "T1", "amount_minor": 5, "region": "R"},
        {"tenant_id": "T2", "amount_minor": "7", "region": {"a": 1}},
        {"tenant_id": 3, "amount_minor": 1.5, "rule_version": "x"},
    ]
    raw = spark.createDataFrame([(json.dumps(t),) for t in texts] + [('{"tenant_id": "T1"',), ("",)], "value string")
    some = ingest.parse_events(raw, lenient=True, fields=["tenant_id", "amount_minor"])
    assert some.columns == ["raw_payload", "parse_error", "tenant_id", "amount_minor"]
    every = ingest.parse_events(raw, lenient=True).select(*some.columns)
    assert sorted(map(str, some.collect())) == sorted(map(str, every.collect()))


def test_index_rows_of_other_keys_are_not_dealt_out(spark, folder):
    events = [pay(f"k{i}", i * MIN, 1000) for i in range(50)]
    again = [pay("k3", 3 * MIN, 2000, late=9), pay("new", MIN, 10)]
    for n, docs in enumerate([events, again]):
        increments.apply(spark, folder, events_of(spark, docs), n, rules_of(spark), 4)
    stored = increments._stored(spark, f"{folder}/payments", increments.PAYMENT_TABLE, range(4), 9)
    found = increments._matching(stored, spark.createDataFrame([("Pk3",)], "link string"), "link", "t")
    assert sorted((r.amount_minor, r.batch_id) for r in found.collect()) == [(1000, 0), (2000, 1)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    assert answer(spark, folder) == batch_answer(spark, events + again)


def test_keys_are_kept_outside_the_heap(spark, folder, tmp_path):
    topic = Topic(str(tmp_path))
    topic.add(pay("a", 0), pay("a", 0), pay("b", MIN))
    topic.add(pay("a", 0, late=5), pay("c", MIN))
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    query = jobs.dedup_stream(topic.read(spark), f"{folder}/d", jobs.Run(f"{folder}/c", streams.ONCE))
    query.awaitTermination()
    state = [s for p in query.recentProgress for s in p["stateOperators"]]
    assert state and all(any(m.startswith("rocksdb") for m in s["customMetrics"]) for s in state)
    got = jobs.read_deduplicated(spark, f"{folder}/d").collect()
    assert sorted(r.idempotency_key for r in got) == ["a", "b", "c"]
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) == before


def test_only_repeated_deliveries_are_sorted_in_a_repair(spark):
    docs = [pay(f"k{i}", i * MIN, 100 + i) for i in range(30)]
    docs += [pay("k3", 3 * MIN, 900, late=5), pay("k3", 3 * MIN, 800), pay("k4", 4 * MIN, 104, late=HOUR)]
    events = events_of(spark, docs)
    once, again = ordered.repeated_keys(events, ["idempotency_key"])
    assert sorted({r.idempotency_key for r in again.collect()}) == ["k3", "k4"] and again.count() == 5
    assert once.count() == 28 and not {"k3", "k4"} & {r.idempotency_key for r in once.collect()}
    rows = jobs.rebuilt_settlement(events)
    last = {f"k{i}": 100 + i for i in range(30)} | {"k3": 900, "k4": 104}
    assert rows.agg(F.sum("pay_amount"), F.sum("pay_count")).first() == (sum(last.values()), 30)
