"""Exact deduplication by an exchange of Golomb-coded fingerprints.

Each input partition sends the sorted distinct fingerprints of its texts to the owners of the
fingerprint ranges, as Golomb-Rice codes of their differences. An owner answers each list with a
bitmap: which of these more than one row has. Such rows are suspects; only their texts are shuffled
and compared byte for byte.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstream.llm import common
from tillstream.llm.exchange import exchange

#: Bits of a fingerprint. A chance match only makes a row a suspect that the byte comparison clears.
FINGERPRINT_BITS = 48
#: Rows for each owner of a fingerprint range, at most.
OWNER_ROWS = 4_000_000

#: Rows looked up at a time.
USED_ROWS = 1_000


def golomb_encode(values: np.ndarray, span: int) -> bytes:
    """Sorted distinct integers in [0, span) as Golomb-Rice codes of their gaps.

    Layout: count (8 bytes), remainder width (1), length of the unary part (8), unary quotients
    (ones ended by a zero), remainders of fixed width.
    """
    n = len(values)
    if not n:
        return bytes(17)
    width = max(0, int(np.log2(max(1.0, span / n) * np.log(2))))
    gaps = np.diff(values.astype(np.int64), prepend=-1) - 1
    quotients, rest = gaps >> width, gaps & ((1 << width) - 1)
    unary = np.ones(int(quotients.sum()) + n, np.uint8)
    unary[np.cumsum(quotients + 1) - 1] = 0
    unary_bytes = np.packbits(unary).tobytes()
    bits = (rest[:, None] >> np.arange(width - 1, -1, -1)) & 1
    head = n.to_bytes(8, "little") + bytes([width]) + len(unary).to_bytes(8, "little")
    return head + unary_bytes + np.packbits(bits.astype(np.uint8).ravel()).tobytes()


def golomb_decode(data: bytes) -> np.ndarray:
    n, width, ones = int.from_bytes(data[:8], "little"), data[8], int.from_bytes(data[9:17], "little")
    if not n:
        return np.zeros(0, np.int64)
    cut = 17 + (ones + 7) // 8
    unary = np.unpackbits(np.frombuffer(data[17:cut], np.uint8), count=ones)
    quotients = np.diff(np.flatnonzero(unary == 0), prepend=-1) - 1
    bits = np.unpackbits(np.frombuffer(data[cut:], np.uint8), count=n * width).reshape(n, width)
    rest = bits.astype(np.int64) @ (1 << np.arange(width - 1, -1, -1, dtype=np.int64))
    return np.cumsum((quotients << width) + rest + 1) - 1


def _digest(text: str | None) -> bytes:
    return hashlib.sha256((text or "").encode("utf-8", "surrogatepass")).digest()


def _prints(digests: list[bytes]) -> np.ndarray:
    """The leading bits of each digest."""
    first = np.frombuffer(b"".join(d[:8] for d in digests), ">u8").astype(np.uint64)
    return (first >> np.uint64(64 - FINGERPRINT_BITS)).astype(np.int64)


def _span(owners: int) -> int:
    return -(-(1 << FINGERPRINT_BITS) // owners)


def _lists(distinct: np.ndarray, owners: int) -> Iterator[tuple[int, np.ndarray]]:
    """Sorted distinct fingerprints by owner, as offsets into the owner's range."""
    span = _span(owners)
    owner = distinct // span
    cuts = np.flatnonzero(np.diff(owner, prepend=-1))
    for begin, end in zip(cuts, [*cuts[1:], len(distinct)], strict=True):
        yield int(owner[begin]), distinct[begin:end] - owner[begin] * span


def _question(prints: np.ndarray, owners: int) -> Iterator[tuple[int, bytes]]:
    """For each owner its fingerprints, and a bitmap of those that several rows here have."""
    distinct, count = np.unique(prints, return_counts=True)
    for owner, values in _lists(distinct, owners):
        repeated = count[np.searchsorted(distinct, values + owner * _span(owners))] > 1
        bits = np.packbits(repeated).tobytes()
        yield owner, len(bits).to_bytes(8, "little") + bits + golomb_encode(values, _span(owners))


def _asked(question: bytes) -> tuple[np.ndarray, np.ndarray]:
    cut = 8 + int.from_bytes(question[:8], "little")
    values = golomb_decode(question[cut:])
    return values, np.unpackbits(np.frombuffer(question[8:cut], np.uint8), count=len(values)).astype(bool)


def _answer(owner: int, questions: list[bytes]) -> list[bytes]:
    """A bitmap for each list: what occurs in another list too, or several times in its own."""
    lists = [_asked(q) for q in questions]
    values = np.concatenate([v for v, _ in lists])
    _, place, count = np.unique(values, return_inverse=True, return_counts=True)
    repeated = (count[place] > 1) | np.concatenate([r for _, r in lists])
    ends = np.cumsum([len(v) for v, _ in lists])
    return [np.packbits(part).tobytes() for part in np.split(repeated, ends[:-1])]


def _suspects(answers: list[tuple[int, bytes, bytes]], owners: int) -> np.ndarray:
    """The fingerprints of this partition that more than one row has, sorted."""
    found = [np.zeros(0, np.int64)]
    for owner, question, bitmap in answers:
        values, _ = _asked(question)
        bits = np.unpackbits(np.frombuffer(bitmap, np.uint8), count=len(values)).astype(bool)
        found.append(values[bits] + owner * _span(owners))
    return np.sort(np.concatenate(found))


def flagged(docs: DataFrame, text_col: str, keep_all_texts: bool) -> DataFrame:
    """``docs`` as a struct with a row number, the text's sha256 and whether it is a suspect.

    Unless ``keep_all_texts``, texts of other rows are left out.
    """
    spark = docs.sparkSession
    at = docs.columns.index(text_col)
    # The count keeps the fingerprints that one owner holds within a bound.
    owners = max(common.shuffle_partitions(spark), -(-docs.count() // OWNER_ROWS))
    rows = docs.rdd
    if not rows.getNumPartitions():
        rows = docs.repartition(1).rdd

    def ask(it):
        prints = _prints([_digest(r[at]) for r in it])
        return _question(prints, owners) if len(prints) else ()

    def use(part, it, answers):
        suspects, row = _suspects(answers, owners), part << 33
        while some := list(itertools.islice(it, USED_ROWS)):
            digests = [_digest(r[at]) for r in some]
            prints = _prints(digests)
            where = np.minimum(np.searchsorted(suspects, prints), max(0, len(suspects) - 1))
            suspect = suspects[where] == prints if len(suspects) else np.zeros(len(some), bool)
            for r, d, s in zip(some, digests, suspect.tolist(), strict=True):
                doc = tuple(r) if s or keep_all_texts else (*r[:at], None, *r[at + 1 :])
                yield doc, row, d.hex(), s
                row += 1

    schema = T.StructType(
        [
            T.StructField("doc", T.StructType(docs.schema.fields)),
            T.StructField("row", T.LongType()),
            T.StructField("sha", T.StringType()),
            T.StructField("suspect", T.BooleanType()),
        ]
    )
    found = spark.createDataFrame(exchange(rows, owners, ask, _answer, use), schema, verifySchema=False)
    return common.stage(found, "exact")


def _classes(marked: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row for each text of several suspects: the row that stays, its id and the size.

    Copies meet as one partial row of each task, so a text that is a third of the input is no hot key.
    """
    text, doc_id = F.coalesce(F.col(f"doc.`{text_col}`"), F.lit("")), F.col(f"doc.`{id_col}`")
    return (
        marked.filter("suspect")
        .groupBy(text.alias("text"))
        .agg(
            F.max(doc_id).alias("keep_id"),
            F.coalesce(F.max_by("row", doc_id), F.max("row")).alias("keep_row"),
            F.count(F.lit(1)).alias("n"),
        )
        .select(F.sha2(F.col("text").cast("binary"), 256).alias("class_sha"), "keep_id", "keep_row", "n")
    )


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when their bytes are; null counts as empty, and an empty text is a text like
    any other. Of equal texts the largest id stays; null ids come last, and of repeated rows with
    that id exactly one stays. An empty table gives no rows. Other columns are not read.
    """
    marked = flagged(docs.select(id_col, text_col), text_col, keep_all_texts=False)
    rows = marked.select(F.col(f"doc.`{id_col}`").alias("doc_id"), "row", "sha", "suspect")
    classes = _classes(marked, id_col, text_col)
    return rows.join(classes, (rows.sha == classes.class_sha) & rows.suspect, "left").select(
        "doc_id",
        F.when(F.col("class_sha").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).alias("group_size"),
        F.coalesce(F.col("row") == F.col("keep_row"), F.lit(True)).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with all their columns; rules as in :func:`groups`."""
    marked = flagged(docs, text_col, keep_all_texts=True)
    kept = _classes(marked, id_col, text_col).select(F.col("keep_row").alias("row"))
    alone = marked.filter("not suspect").select("doc.*")
    return alone.unionByName(marked.filter("suspect").join(kept, "row", "left_semi").select("doc.*"))
