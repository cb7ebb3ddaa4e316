"""Health of running queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

PROGRESS = (
    "name string, batch_id bigint, at string, input_rows bigint, rows_per_second double, "
    "batch_ms bigint, state_rows bigint, state_bytes bigint, dropped_late bigint"
)


def _row(p: dict) -> tuple:
    state = p.get("stateOperators") or []
    return (
        p.get("name"),
        p["batchId"],
        p["timestamp"],
        p["numInputRows"],
        float(p.get("processedRowsPerSecond") or 0.0),
        (p.get("durationMs") or {}).get("triggerExecution", 0),
        sum(s.get("numRowsTotal", 0) for s in state),
        sum(s.get("memoryUsedBytes", 0) for s in state),
        sum(s.get("numRowsDroppedByWatermark", 0) for s in state),
    )


def log_progress(query: StreamingQuery, path: str, every_s: float = 10.0) -> None:
    """Follow a query to its end and write the progress of every micro-batch below ``path``.

    Spark holds the last hundred entries; as long as fewer micro-batches end in ``every_s`` seconds, none
    gets lost, however long the query runs. A repeated entry replaces itself.
    """
    spark, last, over = SparkSession.active(), -1, False
    while not over:
        over = query.awaitTermination(every_s)
        new = [dict(p) for p in query.recentProgress if p["batchId"] > last]
        for p in new:
            row = spark.createDataFrame([_row(p)], PROGRESS)
            row.coalesce(1).write.mode("overwrite").json(f"{path}/run={p['runId']}/batch={p['batchId']}")
            last = max(last, p["batchId"])


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """All logged entries."""
    return spark.read.schema(PROGRESS).json(f"{path}/run=*/batch=*")


def progress_frame(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """The latest progress of a query as Spark holds it, for a look at a running one."""
    return spark.createDataFrame([_row(dict(p)) for p in query.recentProgress], PROGRESS)
