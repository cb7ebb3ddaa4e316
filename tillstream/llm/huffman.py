"""Token ids in a compact file format: canonical, length-limited Huffman codes.

A file set is a folder with two tables. ``codebook`` holds the code length of each id that occurs; the
codes follow from the lengths. ``blocks`` holds one row for each block: whole documents in ascending
id order with their token counts, the codes as one bit string, and the bit offset of every
``STRIDE``-th token. A block is decoded by itself, and in it the runs between checkpoints are
decoded side by side, each step by one lookup in a table of all ``MAX_BITS``-bit prefixes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillstream.llm import common, tokens

END_ID = 2
MAX_BITS = 18
STRIDE = 256

#: Bytes of text after which a block ends, at the end of a document.
BLOCK_BYTES = 4 << 20

#: Ids whose counts travel together.
ID_RANGE = 1 << 12

_BLOCKS = (
    "part int, block int, start bigint, doc_ids array<bigint>, doc_tokens array<bigint>, "
    "checkpoints binary, payload binary"
)


def code_lengths(counts: np.ndarray, most: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``most`` bits by package-merge; 0 for a count of 0."""
    ids = np.flatnonzero(counts)
    out = np.zeros(len(counts), np.int64)
    if len(ids) <= 1:
        out[ids] = 1
        return out
    if len(ids) > 1 << most:
        raise ValueError(f"{len(ids)} ids need more than {most} bits")
    ids = ids[np.argsort(counts[ids], kind="stable")]
    weights = counts[ids].astype(np.float64)
    # per level: sorted weights, and for each item the symbol or, behind the symbols, the package
    levels, packages = [], np.zeros(0)
    for _ in range(most):
        merged = np.concatenate([weights, packages])
        order = np.argsort(merged, kind="stable")
        levels.append(order)
        merged = merged[order]
        packages = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(axis=1)
    take = 2 * len(ids) - 2
    for order in reversed(levels):
        chosen = order[:take]
        symbols = chosen[chosen < len(ids)]
        out[ids[symbols]] += 1
        take = 2 * (len(chosen) - len(symbols))
    return out


def canonical(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of length, then id."""
    codes = np.zeros(len(lengths), np.uint64)
    ids = np.flatnonzero(lengths)
    ids = ids[np.lexsort((ids, lengths[ids]))]
    # a code starts where the codes before it end, in units of the longest code
    widths = np.uint64(1) << (MAX_BITS - lengths[ids]).astype(np.uint64)
    begins = np.cumsum(widths) - widths
    codes[ids] = begins >> (MAX_BITS - lengths[ids]).astype(np.uint64)
    return codes


def encode_bits(ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, bytes]:
    """Bit offset of each token, and the bit string."""
    width = lengths[ids]
    ends = np.cumsum(width)
    offsets = ends - width
    total = int(ends[-1]) if len(ends) else 0
    words = np.zeros(total // 64 + 2, np.uint64)
    if len(ids):
        code, at = codes[ids], offsets >> 6
        right = 64 - (offsets & 63) - width
        spill = np.flatnonzero(right < 0)
        own = code << np.maximum(right, 0).astype(np.uint64)
        own[spill] = code[spill] >> (-right[spill]).astype(np.uint64)
        first = np.flatnonzero(np.diff(at, prepend=-1))
        words[at[first]] = np.bitwise_or.reduceat(own, first)
        words[at[spill] + 1] |= code[spill] << (64 + right[spill]).astype(np.uint64)
    return offsets, words.astype(">u8").tobytes()[: (total + 7) // 8]


def decode_table(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Id and code length for each prefix of ``MAX_BITS`` bits."""
    ids = np.flatnonzero(lengths)
    ids = ids[np.lexsort((ids, lengths[ids]))]
    width = 1 << (MAX_BITS - lengths[ids])
    symbol, length = np.zeros(1 << MAX_BITS, np.uint32), np.zeros(1 << MAX_BITS, np.int64)
    filled = int(width.sum())
    symbol[:filled], length[:filled] = np.repeat(ids, width), np.repeat(lengths[ids], width)
    return symbol, length


def decode_bits(payload: bytes, checkpoints: np.ndarray, n: int, table: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The ``n`` tokens of a block; the runs between checkpoints advance together."""
    symbol, length = table
    raw = np.frombuffer(payload + bytes(4), np.uint8).astype(np.uint32)
    window = (raw[:-3] << 24) | (raw[1:-2] << 16) | (raw[2:-1] << 8) | raw[3:]
    out = np.zeros((len(checkpoints), STRIDE), np.uint32)
    at = checkpoints.astype(np.int64)
    last = n - (len(checkpoints) - 1) * STRIDE
    for step in range(min(STRIDE, n)):
        if step == last:
            at = at[:-1]
        prefix = (window[at >> 3] << (at & 7).astype(np.uint32)) >> np.uint32(32 - MAX_BITS)
        out[: len(at), step] = symbol[prefix]
        at = at + length[prefix]
    return out.ravel()[:n]


#: Tokenized documents between the passes: a row for each block to be, and for each part a row with the
#: counts of each range of ids that occurs in it.
_TOKENIZED = (
    "part int, block int, start bigint, doc_ids array<bigint>, doc_tokens array<bigint>, ids binary, "
    "id_range int, counts binary"
)


def _squeeze(ids: np.ndarray) -> bytes:
    """The ids by byte planes, compressed."""
    return pa.compress(np.ascontiguousarray(ids.astype("<u4").view(np.uint8).reshape(-1, 4).T), "zstd", asbytes=True)


def _unsqueeze(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, 4 * n, "zstd"), np.uint8).reshape(4, n)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def _tokenizer(path: str, end: int):
    def tokenized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, start = tokens.encoder(path), TaskContext.get().partitionId(), 0
        occurs = np.zeros(max(encoder.vocabulary, end + 1), np.int64)
        schema = pa.schema(
            [("part", pa.int32()), ("block", pa.int32()), ("start", pa.int64())]
            + [(c, pa.list_(pa.int64())) for c in ("doc_ids", "doc_tokens")]
            + [("ids", pa.binary()), ("id_range", pa.int32()), ("counts", pa.binary())]
        )
        for block, batch in enumerate(common.slices(batches, "text", BLOCK_BYTES)):
            ids, lengths = tokens.with_end(*encoder.encode(batch.column(1)), end)
            occurs += np.bincount(ids, minlength=len(occurs))
            row = [part, block, start, batch.column(0).to_pylist(), lengths, _squeeze(ids), None, None]
            yield pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip(row, schema, strict=True)], schema=schema)
            start += len(ids)
        for at in range(0, len(occurs), ID_RANGE):
            some = occurs[at : at + ID_RANGE]
            if some.any():
                row = [part, None, None, None, None, None, at // ID_RANGE, some.astype("<i8").tobytes()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([c], f.type) for c, f in zip(row, schema, strict=True)], schema=schema
                )

    return tokenized


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for at, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            sums[at] = sums.get(at, 0) + np.frombuffer(packed, "<i8")
    for at, total in sums.items():
        yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([total.tobytes()])], ["id_range", "counts"])


def _global_counts(tokenized: DataFrame, end: int) -> np.ndarray:
    """How often each id occurs in all documents; what is collected has the size of the vocabulary."""
    rows = (
        tokenized.filter("id_range is not null")
        .select("id_range", "counts")
        .repartition(common.shuffle_partitions(tokenized.sparkSession), "id_range")
        .mapInArrow(_added, "id_range int, counts binary")
        .collect()
    )
    found = {r.id_range: np.frombuffer(r.counts, "<i8") for r in rows}
    counts = np.zeros(max([end + 1, *(at * ID_RANGE + len(c) for at, c in found.items())]), np.int64)
    for at, some in found.items():
        counts[at * ID_RANGE : at * ID_RANGE + len(some)] = some
    return counts


def _encoder(lengths: np.ndarray):
    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = canonical(lengths)
        for batch in batches:
            names = batch.schema.names[:-1]
            for row in range(batch.num_rows):
                one = batch.slice(row, 1)
                n = int(np.sum(one.column(names.index("doc_tokens"))[0].values.to_numpy()))
                offsets, payload = encode_bits(_unsqueeze(one.column(len(names))[0].as_py(), n), lengths, codes)
                checkpoints = offsets[::STRIDE].astype("<u8").tobytes()
                yield pa.RecordBatch.from_arrays(
                    [*one.columns[:-1], pa.array([checkpoints], pa.binary()), pa.array([payload], pa.binary())],
                    [*names, "checkpoints", "payload"],
                )

    return encoded


def write(
    docs: DataFrame,
    folder: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    path: str | None = None,
    end_id: int = END_ID,
) -> None:
    """Write all documents below ``folder``, ascending by id.

    A null or empty text is the end id alone. Null ids come first; repeated ids follow each other
    in the order of their texts. An empty table gives tables without rows.
    """
    spark, path = docs.sparkSession, path or tokens.path()
    docs = common.id_text(docs, id_col, text_col)
    n = common.shuffle_partitions(spark)
    tokenized = common.stage(
        docs.repartitionByRange(n, "doc_id")
        .sortWithinPartitions("doc_id", "text")
        .mapInArrow(_tokenizer(path, end_id), _TOKENIZED),
        "tokenized",
    )
    lengths = code_lengths(_global_counts(tokenized, end_id))
    spark.createDataFrame(
        [(int(i), int(lengths[i])) for i in np.flatnonzero(lengths)], "id bigint, bits int"
    ).coalesce(1).write.parquet(f"{folder}/codebook")
    (
        tokenized.filter("block is not null")
        .select("part", "block", "start", "doc_ids", "doc_tokens", "ids")
        .mapInArrow(_encoder(lengths), _BLOCKS)
        .write.parquet(f"{folder}/blocks")
    )


def read(spark: SparkSession, folder: str, with_ids: bool = True) -> DataFrame:
    """One row for each document: ``doc_id, start, n_tokens, ids_crc32`` and, if asked for, ``ids``
    as little-endian 32-bit integers, all from the files."""
    book = spark.read.schema("id bigint, bits int").parquet(f"{folder}/codebook").collect()
    lengths = np.zeros(max([0, *(r.id for r in book)]) + 1, np.int64)
    for r in book:
        lengths[r.id] = r.bits
    blocks = spark.read.schema(StructType.fromDDL(_BLOCKS)).parquet(f"{folder}/blocks")
    totals = blocks.select(
        "part", F.aggregate("doc_tokens", F.lit(0).cast("bigint"), lambda a, b: a + b).alias("n")
    ).groupBy("part").agg(F.sum("n").alias("n"))
    # one row for each file of the folder
    before, base = 0, {}
    for part, n in sorted(map(tuple, totals.collect())):
        base[part] = before
        before += n

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = decode_table(lengths)
        for batch in batches:
            for row in range(batch.num_rows):
                one = {c: batch.column(i)[row] for i, c in enumerate(batch.schema.names)}
                counts = one["doc_tokens"].values.to_numpy()
                ends = np.cumsum(counts)
                ids = decode_bits(
                    one["payload"].as_py(), np.frombuffer(one["checkpoints"].as_py(), "<u8"), int(ends[-1]), table
                )
                raw = memoryview(ids.astype("<u4").tobytes())
                docs = [raw[4 * (e - n) : 4 * e] for n, e in zip(counts.tolist(), ends.tolist(), strict=True)]
                columns = [
                    one["doc_ids"].values,
                    pa.array(base[one["part"].as_py()] + one["start"].as_py() + ends - counts),
                    pa.array(counts),
                    pa.array([zlib.crc32(d) for d in docs], pa.int64()),
                ]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    columns.append(pa.array([bytes(d) for d in docs], pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids binary" * with_ids
    return blocks.mapInArrow(decoded, schema)
