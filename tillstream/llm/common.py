"""Small helpers that several text operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream import session


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns an operator reads, under fixed names; a null text counts as empty."""
    return docs.select(
        F.col(f"`{id_col}`").cast("bigint").alias("doc_id"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
    )


def remainder(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id falls into part -1."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % parts, F.lit(-1))


#: Rows that go to Python at a time: texts are long, and their buffers lie beside the heap.
ARROW_ROWS = 1_000
_ARROW = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs started in here send texts to Python in batches of ``ARROW_ROWS``."""
    before = spark.conf.get(_ARROW)
    spark.conf.set(_ARROW, str(min(ARROW_ROWS, int(before)) if int(before) > 0 else ARROW_ROWS))
    try:
        yield
    finally:
        spark.conf.set(_ARROW, before)


#: Row groups of written texts wait in the heap of each task.
ROW_GROUP_BYTES = 32 << 20


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write once into the shared folder and read back; later reads survive lost executors."""
    spark = df.sparkSession
    path = session.work_dir(spark, f"llm-{label}")
    with small_batches(spark):
        df.write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


_KEPT: dict[Any, Any] = {}


def kept(key: Any, make: Callable[[], Any]) -> Any:
    """What ``make()`` gives, once for each worker process; kept between its tasks until :func:`let_go`."""
    if key not in _KEPT:
        _KEPT[key] = make()
    return _KEPT[key]


def let_go() -> None:
    """Free what tasks of other work left in this worker process, which Spark uses for one stage after the other.

    Idle workers count in the memory of their executor like busy ones.
    """
    if _KEPT:
        _KEPT.clear()
        pa.default_memory_pool().release_unused()


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The column as Python strings; null counts as empty."""
    return [t or "" for t in batch.column(batch.schema.names.index(name)).to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], name: str, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``most_bytes`` of text, or of one row where a text is longer."""
    for batch in batches:
        column = batch.column(batch.schema.names.index(name))
        ends = [0 if n is None else n for n in pc.binary_length(column).to_pylist()]
        begin = size = 0
        for i, n in enumerate(ends):
            if size and size + n > most_bytes:
                yield batch.slice(begin, i - begin)
                begin, size = i, 0
            size += n
        if begin < batch.num_rows:
            yield batch.slice(begin)


def numbered(docs: DataFrame, label: str) -> DataFrame:
    """The documents, written once with a row number that repeated rows do not share.

    The columns sit in one struct, so no name of theirs can clash with one of ours.
    """
    return stage(
        docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
        .withColumn("row", F.monotonically_increasing_id()),
        label,
    )


def chunks_of(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The pieces between the six ASCII white spaces of all texts in a row, and how many each text has.

    Two separators in a row have an empty piece between them, and an empty text is one empty piece.
    """
    for other in "\t\n\x0b\x0c\r":
        texts = pc.replace_substring(texts, other, " ")
    lists = pc.split_pattern(texts, " ")
    return lists.flatten().dictionary_encode(), pc.list_value_length(lists).to_numpy()
