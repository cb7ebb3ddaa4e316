"""Nothing is cut: many hot keys, long dirty records, long-running queries."""

import json

from pyspark.sql import functions as F

from tillstream.operators import ingest, skew
from tillstream.sources import tables
from tillstream.streaming import health, jobs


def test_thousands_of_hot_keys(spark):
    rows = spark.range(2_500 * 4).select((F.col("id") % 2_500).alias("k"), F.col("id").alias("v"))
    rows = rows.unionByName(spark.range(10_000, 10_100).selectExpr("id as k", "id as v"))
    got = skew.isolate_hot(rows, "k", 2, {"n": F.lit(1), "total": F.col("v")}, 4, F.col("v"))
    paths = {r.path: r.keys for r in got.groupBy("path").agg(F.count("*").alias("keys")).collect()}
    assert paths == {"salted": 2_500, "direct": 100}
    assert got.agg(F.sum("n")).first()[0] == 10_100


def test_many_hot_buckets(spark):
    left = spark.range(3_000 * 3).select((F.col("id") % 3_000).alias("k"), "id")
    right = spark.range(3_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    joined = skew.salted_join(left, right, ["k"], "inner", hot_rows=1, salts=3)
    assert joined.count() == 9_000 and joined.where("w <> 2 * k").count() == 0


def test_long_dirty_record_stays_whole(spark):
    doc = {"event_type": "pay_success", "note": "x" * 9_000, "tenant_id": "T1", "idempotency_key": "k9"}
    raw = spark.createDataFrame([(json.dumps(doc),)], "value string")
    _, dirty = ingest.split(ingest.validate_pay(ingest.parse_events(raw)))
    row = ingest.dirty_rows(dirty, 1_704_038_400_000, "idempotency_key").first()
    assert json.loads(row.raw_payload) == doc and row.idempotency_key == "k9"


def test_files_follow_the_size_of_a_day(spark, folder, monkeypatch):
    monkeypatch.setattr(tables, "FILE_ROWS", 100)
    days = F.expr("case when id < 1000 then date'2024-01-01' else date'2024-01-02' end")
    rows = spark.range(1_050).select("id", days.alias("day"))
    tables.write_batch(rows, folder, "day", 1, ["id"])
    files = spark.read.parquet(folder).select("day", F.input_file_name().alias("f")).distinct()
    counts = {str(r.day): r["count"] for r in files.groupBy("day").count().collect()}
    assert counts["2024-01-01"] >= 5 and counts["2024-01-02"] <= 10
    assert spark.read.parquet(folder).count() == 1_050


def test_progress_of_every_batch_is_logged(spark, folder):
    for i in range(4):
        spark.range(5).coalesce(1).write.json(f"{folder}/in/{i}")
    stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).json(f"{folder}/in/*")
    run = jobs.Run(f"{folder}/c", {"availableNow": True}, "logged")
    health.log_progress(jobs.start(stream, lambda batch, i: batch.count(), run), f"{folder}/log", 0.2)
    rows = health.read_progress(spark, f"{folder}/log").where("input_rows > 0").collect()
    assert sorted(r.batch_id for r in rows) == [0, 1, 2, 3]
