"""Streams over files in arrival order: restart, replay, lateness, deduplication."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tillstream import schemas as S
from tillstream.operators import ingest, settlement
from tillstream.operators.ordered import latest_per_key
from tillstream.sources import topics
from tillstream.streaming import health, jobs

T0 = 1_704_038_400_000
MIN, HOUR, DAY = 60_000, 3_600_000, 86_400_000
ONE_BY_ONE = {"maxFilesPerTrigger": "1"}


def pay(key, t, amount=100, late=0, **more):
    doc = {
        "event_type": S.PAY, "tenant_id": "T1", "app_id": "A", "order_id": f"O{key}",
        "payment_id": f"P{key}", "user_id": "U", "idempotency_key": key, "amount_minor": amount,
        "channel_id": "c", "pay_method": "wx", "event_time": T0 + t, "ingest_time": T0 + t + late,
        "trace_id": "x",
    }
    return doc | more


def refund(key, t, amount, late=0):
    return pay(key, t, -amount, late, event_type=S.REFUND, refund_id=key)


class Topic:
    """Topic files written one by one with rising modification times."""

    def __init__(self, path, name="tp_pay_success"):
        self.path, self.name, self.count = path, name, 0
        os.makedirs(f"{path}/{name}")

    def add(self, *docs):
        file = f"{self.path}/{self.name}/part-{self.count:04d}.json"
        with open(f"{file}.tmp", "w") as out:
            for i, doc in enumerate(docs):
                value = doc if isinstance(doc, str) else json.dumps(doc)
                at = doc.get("ingest_time", T0) if isinstance(doc, dict) else T0
                stamp = f"{_iso(at)}"
                out.write(json.dumps({"key": "k", "value": value, "topic": self.name,
                                      "partition": 0, "offset": i, "timestamp": stamp}) + "\n")
        os.rename(f"{file}.tmp", file)
        os.utime(file, (1_700_000_000 + self.count, 1_700_000_000 + self.count))
        self.count += 1

    def read(self, spark, names=None):
        return topics.read_topic(
            spark, names or [self.name], fmt="files", path=self.path, options=ONE_BY_ONE
        )


def _iso(ms):
    from datetime import datetime, timezone

    return datetime.fromtimestamp(ms / 1000, timezone.utc).isoformat(timespec="milliseconds")


@pytest.fixture
def topic(folder):
    return Topic(f"{folder}/topics")


def finish(query):
    query.awaitTermination()
    return query


def run(folder, name="q"):
    return jobs.Run(f"{folder}/{name}.checkpoint", {"availableNow": True}, None)


def test_ingest_restart_and_replay(spark, folder, topic):
    detail, dirty = f"{folder}/detail", f"{folder}/dirty"

    def go():
        finish(jobs.ingest_stream(topic.read(spark), detail, dirty, run(folder)))

    topic.add(pay("a", 0), pay("b", MIN, 0), "not json")
    topic.add(pay("a", 0, late=5, trace_id="later"), pay("c", DAY))
    go()
    topic.add(pay("d", 2 * MIN), pay("c", DAY))
    go()
    go()
    rows = {r.idempotency_key: r.trace_id for r in jobs.read_detail(spark, detail).collect()}
    assert rows == {"a": "later", "c": "x", "d": "x"}
    assert jobs.read_detail(spark, detail, ["2024-01-02"]).count() == 1
    reasons = sorted(r.dirty_reason for r in jobs.read_dirty(spark, dirty).collect())
    assert reasons == ["amount_le_zero:0", "json_parse_error"]
    # Crash between write and commit: the last batch runs again after a restart.
    commits = f"{folder}/q.checkpoint/commits"
    os.remove(f"{commits}/2")
    if os.path.exists(f"{commits}/.2.crc"):
        os.remove(f"{commits}/.2.crc")
    go()
    assert jobs.read_detail(spark, detail).count() == 3
    assert jobs.read_dirty(spark, dirty).count() == 2


def test_minute_gmv_drops_late_rows_and_matches_batch(spark, folder, topic):
    topic.add(pay("a", 0), pay("b", 59_999), pay("c", MIN))
    topic.add(pay("d", 10 * MIN))
    topic.add(pay("e", 10 * MIN + 1))
    topic.add(pay("late", 1))
    topic.add(pay("f", 30 * MIN))
    topic.add(pay("end", DAY))
    query = finish(jobs.minute_gmv_stream(topic.read(spark), f"{folder}/m", run(folder)))
    got = jobs.read_minutes(spark, f"{folder}/m", jobs.gmv_table()).collect()
    assert sorted((r.stat_minute.minute, r.pay_count) for r in got) == [
        (0, 2), (1, 1), (10, 2), (30, 1)
    ]
    progress = health.progress_frame(spark, query)
    total = progress.agg(F.sum("dropped_late"), F.sum("input_rows")).first()
    assert total[0] == 1 and total[1] == 8


def _batch_minutes(spark, docs):
    df = spark.createDataFrame([(json.dumps(d),) for d in docs], "value string")
    valid, _ = ingest.split(ingest.validate_events(ingest.parse_events(df)))
    once = latest_per_key(valid, ["idempotency_key"], ["ingest_time", "trace_id"])
    return settlement.minute_settlement(once)


def test_late_refund_replaces_its_minute(spark, folder, topic):
    docs = [pay("a", 0, 100), refund("r", 30_000, 40), pay("b", 5 * MIN, 70), pay("z", 4 * HOUR, 1)]
    topic.add(docs[0])
    topic.add(docs[0], docs[2])
    topic.add(docs[3])
    topic.add(docs[1], docs[0])
    path = f"{folder}/m"
    finish(jobs.minute_settlement_stream(topic.read(spark), path, run(folder)))
    got = jobs.read_minutes(spark, path, jobs.settlement_table())
    assert sorted(got.collect()) == sorted(_batch_minutes(spark, docs).collect())
    # Beyond the limit the row is dropped by the stream and brought in by the repair.
    topic.add(pay("y", 30 * HOUR, 1))
    topic.add(pay("x", 30 * HOUR + 1, 1))
    too_late = refund("r2", 31_000, 10)
    topic.add(too_late)
    query = finish(jobs.minute_settlement_stream(topic.read(spark), path, run(folder)))
    first = got.where("minute(stat_minute) = 0 and hour(stat_minute) = 0")
    assert first.first().refund_amount == 40
    assert health.progress_frame(spark, query).agg(F.sum("dropped_late")).first()[0] == 1
    events = spark.createDataFrame(
        [(json.dumps(d),) for d in [*docs, too_late]], "value string"
    )
    valid, _ = ingest.split(ingest.validate_events(ingest.parse_events(events)))
    jobs.repair_days(spark, valid, path, ["2024-01-01"], 1000)
    repaired = jobs.read_minutes(spark, path, jobs.settlement_table(), ["2024-01-01"])
    assert sorted(repaired.collect()) == sorted(_batch_minutes(spark, [*docs, too_late]).collect())


@pytest.mark.parametrize("clock_by", ["event", "arrival"])
def test_dedup_survives_restart(spark, folder, topic, clock_by):
    path = f"{folder}/d"

    def go():
        finish(jobs.dedup_stream(topic.read(spark), path, run(folder), clock_by=clock_by))

    topic.add(pay("a", 0), pay("a", 0), pay("b", MIN))
    go()
    topic.add(pay("a", 0, late=HOUR, trace_id="again"), pay("c", 2 * MIN))
    topic.add(pay("b", MIN))
    go()
    got = jobs.read_deduplicated(spark, path).collect()
    assert sorted(r.idempotency_key for r in got) == ["a", "b", "c"]


def test_minute_parts_replay(spark, folder, topic):
    topic.add(pay("a", 0, 5), pay("b", 1, 6))
    topic.add(pay("c", 2, 7), pay("d", 2 * MIN, 8))
    path = f"{folder}/m"
    finish(jobs.minute_parts_stream(topic.read(spark), path, run(folder), salt=4))
    # The same records under a fresh checkpoint get the same batch numbers again.
    finish(jobs.minute_parts_stream(topic.read(spark), path, run(folder, "q2"), salt=4))
    got = jobs.read_minute_parts(spark, path).collect()
    assert sorted((r.stat_minute.minute, r.pay_count, r.pay_amount) for r in got) == [
        (0, 3, 18), (2, 1, 8)
    ]


def test_several_topics_under_one_watermark(spark, folder):
    base = f"{folder}/topics"
    pays, refunds = Topic(base, "tp_pay_success"), Topic(base, "tp_refund_success")
    docs = [pay("a", 0, 100), refund("r", 10_000, 30)]
    pays.add(docs[0])
    refunds.add(docs[1])
    both = pays.read(spark, ["tp_pay_success", "tp_refund_success"])
    finish(jobs.minute_settlement_stream(both, f"{folder}/m", run(folder)))
    got = jobs.read_minutes(spark, f"{folder}/m", jobs.settlement_table()).collect()
    assert got == _batch_minutes(spark, docs).collect()
    assert got[0].net_amount == 70


def test_recovery_stream(spark, folder, topic):
    topic.add(pay("a", 0, -5), pay("a", 0, -5), pay("b", MIN, event_id="E"))
    finish(jobs.recovery_stream(topic.read(spark), f"{folder}/r", run(folder)))
    got = jobs.read_recovery(spark, f"{folder}/r").collect()
    assert sorted((r.event_id, r.amount_minor) for r in got) == [("E", 100), ("Pa", -5)]


def test_logins_join_and_degrade(spark, folder):
    schema = "event_id string, user_id string, device_id string, event_time long"
    write = lambda name, i, rows: spark.createDataFrame(rows, schema).coalesce(1).write.json(
        f"{folder}/{name}/{i}"
    )
    write("pay", 0, [("p1", "u", None, T0 + 20 * MIN), ("p2", "v", None, T0 + 21 * MIN)])
    write("login", 0, [("l1", "u", "D1", T0 + 15 * MIN), ("l2", "v", "D2", T0 + 5 * MIN)])
    for name in ("pay", "login"):
        write(name, 1, [("far", "w", None, T0 + DAY)])
        write(name, 2, [("far2", "w2", None, T0 + DAY + 1)])
    side = lambda name: (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(f"{folder}/{name}/*")
    )
    out = f"{folder}/out"

    def keep(batch, batch_id):
        batch.select("event_id", "login_device", "degraded").write.mode("overwrite").parquet(
            f"{out}/{batch_id}"
        )

    joined = jobs.logins_joined(side("pay"), side("login"))
    finish(jobs.start(joined, keep, run(folder)))
    rows = spark.read.parquet(f"{out}/*").where("event_id in ('p1', 'p2')").collect()
    assert sorted(map(tuple, rows)) == [("p1", "D1", False), ("p2", None, True)]


def test_throttle_once_per_window(spark, folder):
    schema = "tenant_id string, kind string, event_time long"
    for i in range(3):
        spark.createDataFrame(
            [("T1", "click", T0 + i * MIN), ("T1", "click", T0 + i * MIN + 1)], schema
        ).coalesce(1).write.json(f"{folder}/in/{i}")
    usage = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(f"{folder}/in/*")
    quota = lambda s: s.createDataFrame(
        [("T1", 1, T0 - DAY, 3)], "tenant_id string, version int, effective_time long, quota_per_hour long"
    )
    sent = f"{folder}/topics"
    finish(
        jobs.throttle_stream(
            usage, quota, f"{folder}/t", run(folder),
            publish=lambda df, i: topics.publish(df, S.THROTTLE_TOPIC, ["tenant_id"], "files", sent, i),
        )
    )
    got = jobs.read_throttle(spark, f"{folder}/t").collect()
    assert [(r.tenant_id, r.used, r.quota_per_hour) for r in got] == [("T1", 6, 3)]
    ids = spark.read.json(f"{sent}/{S.THROTTLE_TOPIC}/*").select(
        F.get_json_object("value", "$.event_id").alias("id")
    )
    assert [r.id for r in ids.collect()] == [got[0].event_id]


def test_sliding_association(spark, folder):
    schema = "ip string, user_id long, event_time long"
    spark.createDataFrame(
        [("i", u, T0 + u * MIN) for u in range(8)] + [("i", 0, T0 + 30)], schema
    ).coalesce(1).write.json(f"{folder}/in/0")
    usage = spark.readStream.schema(schema).json(f"{folder}/in/*")
    finish(jobs.association_stream(usage, "ip", "user_id", f"{folder}/a", run(folder)))
    top = spark.read.parquet(f"{folder}/a").agg(F.max("others"), F.max("events")).first()
    assert tuple(top) == (8, 9)


@pytest.mark.parametrize("order", [[0, 1, 2, 3, 4, 5, 6], [6, 3, 0, 5, 1, 4, 2]])
def test_stream_with_repair_is_exact(spark, folder, topic, order):
    docs = [
        [pay(f"p{i}", i * 20 * HOUR, 100 + i), refund(f"r{i}", i * 20 * HOUR + 9 * HOUR, 10, late=30 * HOUR)]
        for i in range(6)
    ] + [[pay("p0", 0, 100, late=DAY), pay("p3", 60 * HOUR, 103)]]
    for i in order:
        topic.add(*docs[i])
    path, store = f"{folder}/m", f"{folder}/s"
    finish(jobs.minute_settlement_stream(topic.read(spark), path, run(folder)))
    valid = lambda df: ingest.validate_events(df).where("dirty_reason is null")
    finish(jobs.event_store_stream(topic.read(spark), store, run(folder, "s"), 6 * HOUR, valid))
    days = jobs.repair_late(spark, store, path, 1 << 40, jobs.rebuilt_settlement)
    got = jobs.read_minutes(spark, path, jobs.settlement_table()).collect()
    assert sorted(got) == sorted(_batch_minutes(spark, [d for some in docs for d in some]).collect())
    assert days
