"""Stored tables: day-partitioned Parquet with unique keys resolved on read.

A micro-batch only ever writes its own files, ``<day>=D/batch_id=B``, and a
replay of the same batch replaces exactly those. A reader keeps the latest row
of each key. So a batch costs what it holds, not what the table holds, a late
row does not rewrite an old day, and a crash between two writes cannot count
anything twice. ``compact`` folds the batches of closed days into one.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstream.operators.ordered import latest_per_key
from tillstream.session import stage

BATCH = "batch_id"


#: Rows of one day that one task writes.
FILE_ROWS = 1_000_000


def _spread(df: DataFrame, day_col: str, columns: Sequence[str]) -> DataFrame:
    """Rows dealt by day and, within the day, over one task for each ``FILE_ROWS`` of its rows."""
    days = df.groupBy(day_col).agg(F.count("*").alias("rows"))
    most, total = days.agg(F.max("rows"), F.sum("rows")).first()
    parts = -(-(most or 1) // FILE_ROWS)
    tasks = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-(total or 1) // FILE_ROWS))
    return df.repartition(tasks, F.col(day_col), F.pmod(F.xxhash64(*columns), F.lit(parts)))


def write_batch(
    df: DataFrame, path: str, day_col: str, batch_id: int, buckets: Sequence[str] | None = None,
) -> None:
    """Append one batch; writing the same ``batch_id`` again replaces it.

    ``buckets`` names columns by which the rows of a day are spread over as many tasks as its
    size asks for, so that a big day does not end in one file nor a small one in many.
    """
    rows = df.withColumn(BATCH, F.lit(batch_id).cast("bigint"))
    if not buckets:
        _write(rows, path, day_col)
        return
    rows = rows.persist()  # counted, then written
    try:
        _write(_spread(rows, day_col, buckets), path, day_col)
    finally:
        rows.unpersist()


def _write(rows: DataFrame, path: str, day_col: str) -> None:
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(day_col, BATCH)
        .parquet(path)
    )


def append(df: DataFrame, path: str, day_col: str, batch_id: int) -> None:
    """Append-only archive: duplicates stay, a replayed batch does not."""
    write_batch(df, path, day_col, batch_id)


def upsert(
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    order_by: Sequence[str],
    day_col: str,
    batch_id: int,
) -> None:
    """Add one batch to a unique-key table; within it only the latest row per key stays."""
    latest = latest_per_key(df, list(keys), list(order_by))
    write_batch(latest, path, day_col, batch_id, buckets=keys)


def load_table(
    spark: SparkSession, path: str, schema: T.StructType, day_col: str,
    days: Iterable[date | str] | None = None,
) -> DataFrame:
    """All stored rows with their ``batch_id``; ``days`` prunes partitions."""
    stored = T.StructType(
        [f for f in schema if f.name != day_col]
        + [T.StructField(day_col, schema[day_col].dataType), T.StructField(BATCH, T.LongType())]
    )
    if not is_folder(spark, path):
        df = spark.createDataFrame([], stored)
    else:
        df = spark.read.schema(stored).parquet(path)
    if days is not None:
        kind = schema[day_col].dataType
        df = df.where(F.col(day_col).isin([F.lit(str(d)).cast(kind) for d in days]))
    return df.select(*[f.name for f in schema], BATCH)


def read_latest(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    keys: Sequence[str],
    day_col: str,
    order_by: Sequence[str] = (),
    days: Iterable[date | str] | None = None,
) -> DataFrame:
    """The table under its unique key: the last write wins.

    ``order_by`` names a sequence column that goes before the batch number, so
    that older business data cannot replace newer.
    """
    rows = load_table(spark, path, schema, day_col, days)
    return latest_per_key(rows, list(keys), [*order_by, BATCH]).drop(BATCH)


def compact(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    keys: Sequence[str],
    day_col: str,
    days: Sequence[date | str],
    order_by: Sequence[str] = (),
) -> None:
    """Fold all batches of closed days into their newest one.

    The result goes to a staging folder first and replaces the newest batch;
    older batch folders go last. A crash in between leaves copies of equal
    rows, which the unique key absorbs.
    """
    stored = load_table(spark, path, schema, day_col, days)
    newest = {
        r[0]: r[1] for r in stored.groupBy(day_col).agg(F.max(BATCH)).collect()
    }
    if not newest:
        return
    latest = latest_per_key(stored, list(keys), [*order_by, BATCH]).drop(BATCH)
    staged = stage(latest, "compact")
    for day, batch in newest.items():
        rows = staged.where(F.col(day_col) == F.lit(day))
        write_batch(rows, path, day_col, batch, keys)
        for folder in _folders(spark, f"{path}/{day_col}={day}"):
            if folder.split("=")[-1] != str(batch):
                _delete(spark, f"{path}/{day_col}={day}/{folder}")


def replace_days(
    spark: SparkSession, df: DataFrame, path: str, day_col: str, days: Sequence[str], batch_id: int
) -> None:
    """Make ``df`` the whole content of ``days``: write it as one batch, then drop the others."""
    write_batch(df, path, day_col, batch_id)
    for day in days:
        folder = f"{path}/{day_col}={day}"
        for name in _folders(spark, folder):
            if name != f"{BATCH}={batch_id}":
                _delete(spark, f"{folder}/{name}")


def apply_retention(
    spark: SparkSession, path: str, day_col: str, days_back: int, today: date
) -> list[str]:
    """Drop day partitions older than ``days_back``; returns the dropped days."""
    first = today - timedelta(days=days_back)
    dropped = []
    for folder in _folders(spark, path):
        name, _, day = folder.partition("=")
        if name == day_col and day and date.fromisoformat(day) < first:
            _delete(spark, f"{path}/{folder}")
            dropped.append(day)
    return sorted(dropped)


def split_hot_cold(
    df: DataFrame, day_col: str, days: int, today: date
) -> tuple[DataFrame, DataFrame]:
    """(recent, older) rows by day."""
    first = F.lit(today - timedelta(days=days))
    return df.where(F.col(day_col) > first), df.where(F.col(day_col) <= first)


def write_cold(df: DataFrame, path: str, day_col: str) -> None:
    """Older days in few, larger files."""
    (
        _spread(df, day_col, df.columns)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(day_col)
        .parquet(path)
    )


def write_ledger(detail: DataFrame, summary: DataFrame, path: str) -> None:
    """Ledger detail and summary as JSON lines."""
    detail.write.mode("overwrite").json(f"{path}/ground_truth_detail")
    summary.write.mode("overwrite").json(f"{path}/ground_truth_summary")


def _fs(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def _folders(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]


def _delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def is_folder(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p) and fs.getFileStatus(p).isDirectory()
