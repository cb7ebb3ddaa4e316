"""Token counts by source, language and tokenizer version, kept up to date by signed deltas.

A store is a folder with three tables, each with one part for each batch. ``deltas`` says by how much a batch
changes the documents and tokens of each document it touches, ``rollups`` adds that up by
source, language and tokenizer, and ``commits`` names the batches that are complete. A batch reads
only batches with smaller numbers and overwrites only its own parts, so a repeated batch changes nothing and
one that broke off is simply applied again. Totals are the sum of all committed rollups.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.llm import common, tokens

INSERT, REVISE, DELETE = "insert", "revise", "delete"

#: Tokenizer versions: words between ASCII white space, and a public vocabulary.
WORDS = "words_1"
VERSIONS = (WORDS, "word_bpe_49k")

BLOCK_BYTES = 4 << 20

_DELTAS = "doc_id bigint, source string, lang string, tokenizer string, docs bigint, tokens bigint"
_ROLLUPS = "source string, lang string, tokenizer string, docs bigint, tokens bigint"


def _counted(path: str):
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokens.encoder(path).encode
        for batch in common.slices(batches, "text", BLOCK_BYTES):
            texts = batch.column(batch.schema.names.index("text")).fill_null("")
            chunks, counts = common.chunks_of(texts)
            ends = np.cumsum(counts)
            filled = np.array([bool(c) for c in chunks.dictionary.to_pylist()], bool)[chunks.indices.to_numpy()]
            words = np.diff(np.concatenate(([0], np.cumsum(filled)))[np.concatenate(([0], ends))])
            both = np.stack([words, encode(texts)[1]], axis=1)
            kept = [i for i, c in enumerate(batch.schema.names) if c != "text"]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in kept], pa.array(list(both), pa.list_(pa.int64()))],
                [*[batch.schema.names[i] for i in kept], "counts"],
            )

    return counted


def _last(changes: DataFrame, path: str) -> DataFrame:
    """The change that counts for each document: the last by ``seq``, of equal ones the one that sorts last."""
    names = changes.columns
    rows = changes.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        (F.col("seq") if "seq" in names else F.lit(0)).cast("bigint").alias("seq"),
        "op",
        F.col("source").cast("string").alias("source"),
        F.col("lang").cast("string").alias("lang"),
        "text",
    ).withColumn("hash", F.xxhash64("text"))
    counted = rows.mapInArrow(
        _counted(path),
        "doc_id bigint, seq bigint, op string, source string, lang string, hash bigint, counts array<bigint>",
    )
    return (
        counted.groupBy("doc_id")
        .agg(F.max(F.struct("seq", "op", "hash", "source", "lang", "counts")).alias("last"))
        .select("doc_id", "last.op", "last.source", "last.lang", "last.counts")
    )


def _read(spark: SparkSession, store: str, name: str, schema: str) -> DataFrame:
    """All parts of a table; empty before the first batch."""
    spark.createDataFrame([], f"{schema}, batch bigint").write.mode("append").partitionBy("batch").parquet(f"{store}/{name}")
    return spark.read.schema(f"{schema}, batch bigint").parquet(f"{store}/{name}")


def apply(spark: SparkSession, store: str, batch: int, changes: DataFrame, path: str | None = None) -> None:
    """Commit ``changes(op, doc_id, source, lang, text[, seq])`` as batch number ``batch``.

    ``insert`` and ``revise`` set a document to its new source, language and text, whether it was there or
    not; ``delete`` takes it out, and does nothing if it was not there. A document that is changed several
    times in a batch ends as its last change says. Null sources and languages are groups of their own, a null text
    has no tokens, and a null id is one document. Batches are applied in the order of their numbers.
    """
    last = common.stage(_last(changes, path or tokens.path()), "changes")
    known = _read(spark, store, "deltas", _DELTAS).filter(F.col("batch") < batch)
    live = (
        known.join(last.select(F.col("doc_id").alias("of")), F.col("doc_id").eqNullSafe(F.col("of")), "left_semi")
        .groupBy("doc_id", "source", "lang", "tokenizer")
        .agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        .filter("docs <> 0 or tokens <> 0")
        .select("doc_id", "source", "lang", "tokenizer", (-F.col("docs")).alias("docs"), (-F.col("tokens")).alias("tokens"))
    )
    new = (
        last.filter(F.col("op") != DELETE)
        .select("doc_id", "source", "lang", F.posexplode("counts").alias("at", "tokens"))
        .select(
            "doc_id",
            "source",
            "lang",
            F.element_at(F.array(*[F.lit(v) for v in VERSIONS]), F.col("at") + 1).alias("tokenizer"),
            F.lit(1).cast("bigint").alias("docs"),
            "tokens",
        )
    )
    part = f"batch={batch}"
    live.unionByName(new).write.mode("overwrite").parquet(f"{store}/deltas/{part}")
    (
        spark.read.schema(_DELTAS)
        .parquet(f"{store}/deltas/{part}")
        .groupBy("source", "lang", "tokenizer")
        .agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        .write.mode("overwrite")
        .parquet(f"{store}/rollups/{part}")
    )
    spark.range(1).write.mode("overwrite").parquet(f"{store}/commits/{part}")


def totals(spark: SparkSession, store: str) -> DataFrame:
    """``source, lang, tokenizer, docs, tokens`` of all committed batches; groups without documents are left out."""
    done = _read(spark, store, "commits", "id bigint").select("batch").distinct()
    return (
        _read(spark, store, "rollups", _ROLLUPS)
        .join(done, "batch", "left_semi")
        .groupBy("source", "lang", "tokenizer")
        .agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        .filter("docs <> 0")
    )
