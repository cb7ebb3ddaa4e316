"""Derived events that go out once: an outbox table between a micro-batch and its topic.

A micro-batch first stores the events that no earlier one has stored, then publishes what it stored. A replay finds the same
earlier batches, replaces its own part with the same rows and publishes them again under the same batch; a batch that
failed between the two steps is finished by :func:`resend`. What went out before is looked up in the days of the new events only,
so the cost of a batch does not grow with the history.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.sources import tables

Publish = Callable[[DataFrame, int], None]


def stored(spark: SparkSession, path: str, shape: DataFrame, day_col: str, days: list) -> DataFrame:
    """Events of ``days`` with their ``batch_id``, in the columns of ``shape``; folders of other days are not even listed."""
    folders = [f"{path}/{day_col}={day}" for day in days]
    folders = [f for f in folders if tables.is_folder(spark, f)]
    columns = [*shape.columns, tables.BATCH]
    schema = shape.withColumn(tables.BATCH, F.lit(0).cast("bigint")).schema
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*folders).select(*columns)


def send(events: DataFrame, path: str, day_col: str, id_col: str, batch_id: int, publish: Publish) -> None:
    """Publish the events whose ``(day, id)`` no earlier batch has stored, one row for each id.

    ``events`` is read twice. Of several rows with one id any goes out; rows without day or id are not
    events and do not.
    """
    spark, keys = events.sparkSession, [day_col, id_col]
    days = sorted(r[0] for r in events.where(F.col(day_col).isNotNull()).select(day_col).distinct().collect())
    if not days:
        return
    earlier = stored(spark, path, events, day_col, days).where(F.col(tables.BATCH) < batch_id)
    rows = events.where(F.col(day_col).isNotNull() & F.col(id_col).isNotNull()).dropDuplicates(keys)
    tables.write_batch(rows.join(earlier.select(*keys), keys, "left_anti").select(*events.columns), path, day_col, batch_id)
    resend(spark, path, events, day_col, days, batch_id, publish)


def resend(
    spark: SparkSession, path: str, shape: DataFrame, day_col: str, days: list, batch_id: int, publish: Publish
) -> None:
    """Publish what a batch has stored for ``days``, exactly these rows however often."""
    rows = stored(spark, path, shape, day_col, days).where(F.col(tables.BATCH) == batch_id)
    publish(rows.drop(day_col, tables.BATCH), batch_id)
