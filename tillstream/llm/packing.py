"""Harmonic packing of token sequences.

Class j holds pieces of exactly ``capacity // j`` tokens and fills each of its sequences with j of
them. Documents are cut greedily into pieces of the largest class that fits, so a document gives
whole sequences and about three more pieces, and a full sequence of class j is short of its capacity by less than
j tokens. Workers cut and number pieces by themselves; the place of a piece follows from its rank in the class by
arithmetic, where the ranks of a worker start behind those of the workers before it. What is left in each
class, fewer than j pieces, is bounded by the capacity alone; it is packed by first fit decreasing.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillstream.llm import common, tokens

CAPACITY = 2048
END_ID = 1

#: Texts tokenized at a time.
SLICE_BYTES = 4 << 20

_PIECES = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "part int, class int, rank bigint"
)


def classes(capacity: int) -> np.ndarray:
    """For each length up to the capacity: the j of the largest class piece that is not longer.

    Lengths that several j share go to the largest j, which fills a sequence best.
    """
    j = np.arange(1, capacity + 1)
    best = np.zeros(capacity + 1, np.int64)
    best[capacity // j] = j  # the last of equal lengths is the largest j
    for length in range(1, capacity + 1):
        best[length] = best[length] or best[length - 1]
    return best


def cuts(length: int, capacity: int, best: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """``start, length, class`` of the pieces of a document."""
    start = 0
    while start < length:
        j = int(best[min(capacity, length - start)])
        yield start, capacity // j, j
        start += capacity // j


def _pieces(path: str, capacity: int, end: int, with_ids: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, best, encode = TaskContext.get().partitionId(), classes(capacity), tokens.encoder(path).encode
        ranks = [0] * (capacity + 1)
        for batch in common.slices(batches, "text", SLICE_BYTES):
            ids, lengths = tokens.with_end(*encode(batch.column(batch.schema.names.index("text"))), end)
            raw = memoryview(ids.astype("<u4").tobytes())
            rows, base = [], 0
            for doc_id, n in zip(batch.column(0).to_pylist(), lengths.tolist(), strict=True):
                for start, size, j in cuts(n, capacity, best):
                    piece = raw[4 * (base + start) : 4 * (base + start + size)]
                    row = (doc_id, start, size, zlib.crc32(piece), n, part, j, ranks[j])
                    rows.append((*row, bytes(piece)) if with_ids else row)
                    ranks[j] += 1
                base += n
            schema = pa.schema(
                [(c, pa.int64()) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")]
                + [("part", pa.int32()), ("class", pa.int32()), ("rank", pa.int64())]
                + [("ids", pa.binary())] * with_ids
            )
            columns = list(zip(*rows, strict=True)) or [()] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return cut


def _first_fit(left: list[tuple[int, int]], capacity: int) -> list[tuple[int, int, int, int]]:
    """``class, rank, bin, offset`` of the pieces left over, longest first into the first bin with room."""
    room: list[int] = []
    out = []
    for j, rank in sorted(left):
        size = capacity // j
        at = next((b for b, free in enumerate(room) if free >= size), len(room))
        if at == len(room):
            room.append(capacity)
        out.append((j, rank, at, capacity - room[at]))
        room[at] -= size
    return out


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    path: str | None = None,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """One row for each piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``
    and, if asked for, ``ids`` as little-endian 32-bit integers.

    A null or empty text is the end id alone. Repeated rows and null ids are packed like any other.
    An empty table gives no rows. Sequences are numbered from 0 without gaps and filled from offset 0 without gaps.
    """
    spark = docs.sparkSession
    cut = _pieces(path or tokens.path(), capacity, end_id, with_ids)
    pieces = common.stage(
        common.id_text(docs, id_col, text_col).mapInArrow(cut, _PIECES + ", ids binary" * with_ids), "pieces"
    )
    counts = pieces.groupBy("part", "class").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("class").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = common.stage(counts.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0))), "piece-counts")
    # at most one row for each class, and for each class fewer left-over pieces than its number
    totals = sorted((r[0], r[1]) for r in counts.groupBy("class").agg(F.sum("n")).collect())
    base, sequences, left = [], 0, []
    for j, n in totals:
        base.append((j, sequences, n // j * j))
        sequences += n // j
        left += [(j, rank) for rank in range(n // j * j, n)]
    bases = spark.createDataFrame(base, "class int, base bigint, whole bigint")
    tail = spark.createDataFrame(
        [(j, rank, sequences + b, at) for j, rank, b, at in _first_fit(left, capacity)],
        "tail_class int, tail_rank bigint, tail_sequence bigint, tail_offset bigint",
    )
    ranked = (
        pieces.join(counts.select("part", "class", "first"), ["part", "class"])
        .withColumn("rank", F.col("rank") + F.col("first"))
        .join(F.broadcast(bases), "class")
        .join(F.broadcast(tail), (F.col("class") == F.col("tail_class")) & (F.col("rank") == F.col("tail_rank")), "left")
    )
    in_class = F.col("base") + F.floor(F.col("rank") / F.col("class"))
    return ranked.select(
        "doc_id",
        "start",
        "length",
        "ids_crc32",
        "doc_tokens",
        F.coalesce("tail_sequence", in_class).cast("bigint").alias("sequence_id"),
        F.coalesce("tail_offset", (F.col("rank") % F.col("class")) * F.col("length")).cast("bigint").alias("offset"),
        *["ids"] * with_ids,
    )


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, length, ids`` from pieces that carry their ids; unpadded."""
    return (
        packed.groupBy("sequence_id")
        .agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"), F.sum("length").alias("length"))
        .select(
            "sequence_id",
            "length",
            F.aggregate("parts", F.lit(b""), lambda out, p: F.concat(out, p["ids"])).alias("ids"),
        )
    )
