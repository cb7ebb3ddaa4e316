"""Stored tables: replay, unique keys, compaction, retention, tiers."""

import json
import os
from datetime import date

from pyspark.sql import functions as F

from tillstream import schemas as S
from tillstream.operators import ledger
from tillstream.sources import tables, topics

SCHEMA = S.columns("day date, k string, seq bigint, v bigint")


def rows(spark, *data):
    return spark.createDataFrame([(date(2024, 1, d), k, s, v) for d, k, s, v in data], SCHEMA)


def read(spark, path, **kw):
    got = tables.read_latest(spark, path, SCHEMA, ["day", "k"], "day", **kw)
    return sorted((r.day.day, r.k, r.v) for r in got.collect())


def test_upsert_and_replay(spark, folder):
    path = f"{folder}/t"
    put = lambda batch, *data: tables.upsert(
        rows(spark, *data), path, ["day", "k"], ["seq"], "day", batch
    )
    put(0, (1, "a", 1, 10), (1, "a", 2, 11), (2, "b", 1, 20))
    assert read(spark, path) == [(1, "a", 11), (2, "b", 20)]
    put(1, (1, "a", 1, 12), (1, "c", 1, 30))
    assert read(spark, path) == [(1, "a", 12), (1, "c", 30), (2, "b", 20)]
    # the sequence column keeps older business data from winning
    assert read(spark, path, order_by=["seq"]) == [(1, "a", 11), (1, "c", 30), (2, "b", 20)]
    put(1, (1, "a", 1, 12), (1, "c", 1, 30))
    assert read(spark, path) == [(1, "a", 12), (1, "c", 30), (2, "b", 20)]
    assert read(spark, path, days=["2024-01-02"]) == [(2, "b", 20)]
    tables.compact(spark, path, SCHEMA, ["day", "k"], "day", ["2024-01-01"])
    assert read(spark, path) == [(1, "a", 12), (1, "c", 30), (2, "b", 20)]
    assert os.listdir(f"{path}/day=2024-01-01") == ["batch_id=1"]


def test_day_predicate_prunes_partitions(spark, folder):
    path = f"{folder}/t"
    tables.upsert(rows(spark, (1, "a", 1, 1), (2, "b", 1, 2)), path, ["day", "k"], ["seq"], "day", 0)
    df = tables.load_table(spark, path, SCHEMA, "day", ["2024-01-02"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "day" in plan.split("PartitionFilters: [")[1][:80]


def test_append_keeps_duplicates_but_not_replays(spark, folder):
    path = f"{folder}/t"
    data = rows(spark, (1, "a", 1, 1), (1, "a", 1, 1))
    tables.append(data, path, "day", 0)
    tables.append(data, path, "day", 1)
    tables.append(data, path, "day", 1)
    assert tables.load_table(spark, path, SCHEMA, "day").count() == 4


def test_replace_days(spark, folder):
    path = f"{folder}/t"
    tables.append(rows(spark, (1, "a", 1, 1), (1, "gone", 1, 1), (2, "b", 1, 2)), path, "day", 0)
    tables.replace_days(spark, rows(spark, (1, "a", 1, 9)), path, "day", ["2024-01-01"], 5)
    assert read(spark, path) == [(1, "a", 9), (2, "b", 2)]


def test_retention(spark, folder):
    path = f"{folder}/t"
    tables.append(rows(spark, (1, "a", 1, 1), (5, "b", 1, 2), (6, "c", 1, 3)), path, "day", 0)
    assert tables.apply_retention(spark, path, "day", 2, date(2024, 1, 7)) == ["2024-01-01"]
    assert read(spark, path) == [(5, "b", 2), (6, "c", 3)]


def test_hot_and_cold(spark, folder):
    df = rows(spark, (1, "a", 1, 1), (5, "b", 1, 2), (9, "c", 1, 3))
    hot, cold = tables.split_hot_cold(df, "day", 7, date(2024, 1, 10))
    assert [r.k for r in cold.collect()] == ["a"]
    assert sorted(r.k for r in hot.collect()) == ["b", "c"]
    tables.write_cold(cold, f"{folder}/cold", "day")
    assert spark.read.parquet(f"{folder}/cold").count() == 1


def test_ledger_files(spark, folder):
    detail = spark.range(2).select(F.col("id").alias("amount_minor"))
    tables.write_ledger(detail, detail.agg(F.sum("amount_minor").alias("gmv")), folder)
    assert spark.read.json(f"{folder}/ground_truth_detail").count() == 2
    assert spark.read.json(f"{folder}/ground_truth_summary").first().gmv == 1
    assert len(ledger.METRICS) == 14


def test_source_options():
    back = topics.lookback("2 minutes")
    assert topics.source_options("kafka", ["a", "b"], back, 1_000_000) == {
        "subscribe": "a,b", "startingTimestamp": "880000",
    }
    assert topics.source_options("kafka", ["a"], "earliest") == {
        "subscribe": "a", "startingOffsets": "earliest",
    }
    assert topics.source_options("files", ["a"], back, 1_000_000)["modifiedAfter"] == (
        "1970-01-01T00:14:40"
    )


def test_publish_and_read_topics(spark, folder):
    df = spark.createDataFrame([("T1", 5, None)], "tenant_id string, used long, note string")
    topics.publish(df, "tp_a", ["tenant_id"], "files", folder, batch_id=3)
    topics.publish(df, "tp_a", ["tenant_id"], "files", folder, batch_id=3)
    topics.publish(df, "tp_b", ["tenant_id"], "files", folder, batch_id=0)
    got = spark.read.schema(S.TOPIC_RECORD).json(f"{folder}/tp_a/*").collect()
    assert [(r.key, json.loads(r.value)) for r in got] == [("T1", {"tenant_id": "T1", "used": 5})]
    both = spark.read.schema(S.TOPIC_RECORD).json(f"{folder}/{{tp_a,tp_b}}/*")
    assert sorted(r.topic for r in both.collect()) == ["tp_a", "tp_b"]
