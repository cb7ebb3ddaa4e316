"""Derived events go out once, over replays, growing windows and old days."""

import datetime

from pyspark.sql import functions as F

from tillstream import schemas as S
from tillstream.operators.risk import Rule
from tillstream.sources import topics
from tillstream.streaming import jobs, outbox

SHAPE = "id string, day date, value long"
D1, D2, D3 = (datetime.date(2024, 1, d) for d in (1, 2, 3))
T0 = 1_704_038_400_000


def sender(spark, folder):
    sent = {}

    def send(batch_id, *rows):
        df = spark.createDataFrame(list(rows), SHAPE)
        outbox.send(df, f"{folder}/box", "day", "id", batch_id, lambda out, i: sent.update({i: out.collect()}))
        return sorted((r.id, r.value) for r in sent.get(batch_id, []))

    return send


def test_only_new_events_go_out(spark, folder):
    send = sender(spark, folder)
    assert send(0, ("a", D1, 1), ("b", D1, 1)) == [("a", 1), ("b", 1)]
    assert send(1, ("b", D1, 2), ("c", D1, 2), ("a", D2, 2)) == [("a", 2), ("c", 2)]
    assert send(2, ("c", D1, 3)) == []


def test_a_replay_sends_the_same_again(spark, folder):
    send = sender(spark, folder)
    send(0, ("a", D1, 1))
    first = send(1, ("a", D1, 2), ("b", D2, 2))
    assert send(1, ("a", D1, 2), ("b", D2, 2)) == first == [("b", 2)]
    assert send(2, ("b", D2, 3), ("d", D2, 3)) == [("d", 3)]


def test_rows_without_day_or_id_and_copies(spark, folder):
    send = sender(spark, folder)
    assert send(0, (None, D1, 1), ("a", None, 1), ("b", D1, 1), ("b", D1, 1)) == [("b", 1)]
    assert send(1) == []


def test_only_the_days_of_the_events_are_read(spark, folder):
    send = sender(spark, folder)
    for i, day in enumerate((D1, D2, D3)):
        send(i, ("a", day, i))
    shape = spark.createDataFrame([], SHAPE)
    read = outbox.stored(spark, f"{folder}/box", shape, "day", [D2, datetime.date(2025, 1, 1)])
    assert {f.split("day=")[1].split("/")[0] for f in read.inputFiles()} == {"2024-01-02"}
    assert [(r.id, r.day, r.batch_id) for r in read.collect()] == [("a", D2, 1)]


def test_a_hit_is_published_once_as_its_window_grows(spark, folder):
    schema = "user_id long, tenant_id string, kind string, event_time long"
    for i in range(3):
        rows = [(1, "T1", "purchase", T0 + i * 1000 + k) for k in range(2)] + [(2 + i, "T1", "error", T0 + i)]
        spark.createDataFrame(rows, schema).coalesce(1).write.json(f"{folder}/in/{i}")
    usage = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(f"{folder}/in/*")
    sent = f"{folder}/topics"
    jobs.frequency_stream(
        usage, Rule("R", 1, 86_400_000, 2), f"{folder}/hits", jobs.Run(f"{folder}/c", {"availableNow": True}),
        publish=lambda df, i: topics.publish(df, S.RISK_TOPIC, ["entity"], "files", sent, i),
    ).awaitTermination()
    hits = jobs.read_hits(spark, f"{folder}/hits").collect()
    out = spark.read.json(f"{sent}/{S.RISK_TOPIC}/*").select(
        F.get_json_object("value", "$.hit_id").alias("id"), F.get_json_object("value", "$.value").alias("value")
    )
    assert [(r.entity, r.value) for r in hits] == [("1", 6)]
    assert [(r.id, r.value) for r in out.collect()] == [(hits[0].hit_id, "2")]
