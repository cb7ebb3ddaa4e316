"""Streams of the registered queries at any size: batches of many files, rows computed once."""

from pyspark.sql import functions as F

from tillstream.plans import streams
from tillstream.sources import tables
from tillstream.streaming import jobs


def test_batches_of_a_larger_topic_have_more_files(spark, folder, monkeypatch):
    monkeypatch.setattr(streams, "TOPIC_ROWS", 50)
    rows = spark.range(1_200).select((F.col("id") * 7 % 1_200).alias("at"))
    shape = lambda df: df.select("at", (F.col("at") * 2).alias("twice"))
    seen = []

    def keep(batch, batch_id):
        got = batch.agg(
            F.min("at"), F.max("at"), F.count("*"), F.count_distinct("file"), F.sum("twice")
        )
        seen.append(tuple(got.first()))

    stream = streams.as_topic(rows, "at", "topic", 1_200, shape)
    stream = stream.withColumn("file", F.input_file_name())
    jobs.start(stream, keep, jobs.Run(f"{folder}/c", streams.ONCE)).awaitTermination()
    assert len(seen) == streams.TOPIC_BATCHES
    assert all(files == 4 for *_, files, _ in seen)
    assert all(a[1] < b[0] for a, b in zip(seen, seen[1:]))
    assert sum(s[2] for s in seen) == 1_200 and sum(s[4] for s in seen) == 1_200 * 1_199


def test_upsert_computes_its_rows_once(spark, folder):
    made = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def key(i):
        made.add(1)
        return f"k{i}"

    day = F.lit("2024-01-01").cast("date").alias("day")
    rows = spark.range(100).select(day, key("id").alias("k"), "id")
    tables.upsert(rows, f"{folder}/t", ["day", "k"], ["id"], "day", 0)
    assert spark.read.parquet(f"{folder}/t").count() == 100
    assert made.value == 100
