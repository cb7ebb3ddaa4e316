"""Topic records as a source and sink.

A record has the columns ``key, value, topic, partition, offset, timestamp``.
``fmt="kafka"`` needs the Kafka connector on the class path; ``fmt="files"``
reads the same records from JSON lines in ``<path>/<topic>/``.
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream import schemas as S

_UNITS = {"second": 1, "minute": 60, "hour": 3_600, "day": 86_400}


@dataclass(frozen=True)
class Lookback:
    """Start this many seconds before now; only a query without a checkpoint obeys it."""

    seconds: int

    def start_ms(self, now_ms: int | None = None) -> int:
        now = int(time.time() * 1000) if now_ms is None else now_ms
        return now - self.seconds * 1000


def lookback(text: str) -> Lookback:
    found = re.fullmatch(r"\s*(\d+)\s+(second|minute|hour|day)s?\s*", text)
    if not found:
        raise ValueError(f"not a duration: {text!r}")
    return Lookback(int(found[1]) * _UNITS[found[2]])


def source_options(
    fmt: str, topics: Sequence[str], starting: str | Lookback, now_ms: int | None = None
) -> dict[str, str]:
    """Reader options for a start position; the checkpoint of a query goes before them."""
    if fmt == "kafka":
        start = (
            {"startingTimestamp": str(starting.start_ms(now_ms))}
            if isinstance(starting, Lookback)
            else {"startingOffsets": starting}
        )
        return {"subscribe": ",".join(topics), **start}
    if isinstance(starting, Lookback):
        at = datetime.fromtimestamp(starting.start_ms(now_ms) / 1000, timezone.utc)
        return {"modifiedAfter": at.strftime("%Y-%m-%dT%H:%M:%S"), "timeZone": "UTC"}
    return {}


def read_topic(
    spark: SparkSession,
    topics: Sequence[str],
    starting: str | Lookback = "earliest",
    streaming: bool = True,
    fmt: str = "kafka",
    path: str | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Records of one or several topics, value as UTF-8 text."""
    reader = spark.readStream if streaming else spark.read
    reader = reader.options(**source_options(fmt, topics, starting), **(options or {}))
    if fmt == "kafka":
        raw = reader.format("kafka").load()
        return raw.select(
            F.col("key").cast("string"),
            F.col("value").cast("string"),
            "topic",
            "partition",
            "offset",
            "timestamp",
        )
    names = "{" + ",".join(topics) + "}" if len(topics) > 1 else topics[0]
    return reader.schema(S.TOPIC_RECORD).json(f"{path}/{names}")


def to_records(df: DataFrame, topic: str, key_cols: Sequence[str]) -> DataFrame:
    """Rows as topic records: JSON value without nulls, key from ``key_cols``."""
    return df.select(
        F.concat_ws("|", *key_cols).alias("key"),
        F.to_json(F.struct(*df.columns), {"ignoreNullFields": "true"}).alias("value"),
        F.lit(topic).alias("topic"),
    )


def publish(
    df: DataFrame,
    topic: str,
    key_cols: Sequence[str],
    fmt: str = "kafka",
    path: str | None = None,
    batch_id: int | None = None,
    options: dict[str, str] | None = None,
) -> None:
    """Publish derived events of one (micro-)batch.

    File batches land in their own folder, so a replayed batch replaces itself.
    On Kafka a replay can repeat records; their ids are stable for the reader.
    """
    records = to_records(df, topic, key_cols)
    if fmt == "kafka":
        records.write.format("kafka").options(**(options or {})).save()
        return
    folder = f"{path}/{topic}"
    if batch_id is not None:
        folder = f"{folder}/batch-{batch_id:012d}"
    records.write.mode("overwrite").json(folder)


def write_in_order(
    df: DataFrame, path: str, order_col: str, batches: int, files: int = 1,
    shape: Callable[[DataFrame], DataFrame] | None = None, sample: DataFrame | None = None,
) -> None:
    """Rows as Parquet files with ascending modification times: ``batches`` ranges of ``order_col``, ``files`` for each.

    A file stream takes files by modification time, so it meets the ranges in this order when it takes ``files`` at a time.
    The files are written by one distributed job, one task each; rows of a range are dealt over its files by their place in the
    order, and ascend in each. ``sample`` has rows by which the ranges are cut (all of them, if left out): as in a range
    partitioning, it decides how large ranges are and never what is written, but finding it need not compute all rows twice.
    ``shape`` makes what is written of rows in order.
    """
    spark = df.sparkSession
    at = F.col(order_col).cast("double")
    shares = [F.lit(i / batches) for i in range(1, batches)]
    some = df if sample is None else sample
    cuts = some.agg(F.percentile_approx(at, F.array(*shares), 10_000)).first()[0] if shares else None
    batch = sum((F.coalesce(at > cut, F.lit(False)).cast("int") for cut in cuts or []), F.lit(0))
    place = F.pmod(F.xxhash64(order_col), F.lit(files)).cast("int")
    rows = df.repartitionById(batches * files, batch * files + place).sortWithinPartitions(order_col)
    (shape(rows) if shape else rows).write.parquet(path)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    names = sorted(s.getPath().getName() for s in fs.listStatus(folder) if s.isFile())
    first = fs.getFileStatus(folder).getModificationTime() - 1000 * len(names)
    for i, name in enumerate(n for n in names if n.startswith("part-")):
        fs.setTimes(spark._jvm.org.apache.hadoop.fs.Path(folder, name), first + 1000 * i, -1)
