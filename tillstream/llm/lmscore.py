"""Scores of documents under a language model, beside the smoothed unigram score.

Context mixing predicts every bit of a text from the bytes and the word before it (see ``mixing``), over word
boundaries, from first byte to end mark. A word with the white space behind it is predicted by that, and by the words of
the same document before it. Experts differ in how much they trust the latter; the document's
probability is their mean, in which, word by word, the better ones gain weight. So the probabilities of all possible
texts add up to one, unseen words are spelled, and the model adapts as it reads.

Word counts never gather in one place: partitions ask the owners of hash ranges of words, each owner
adds up the counts of its words over all partitions and answers, and the partition scores its texts
in place.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.llm import common, mixing
from tillstream.llm.exchange import exchange

SMOOTHING = 0.1

#: Rows for each owner of words, at most.
OWNER_ROWS = 200_000

#: Weights of the document's own tokens so far once there are many, one for each expert, and the
#: number of tokens that gives half of it.
OWN_WEIGHTS = (0.02, 0.1, 0.25, 0.5, 0.9)
OWN_TOKENS = 30

#: Texts counted or scored at a time, and how many counts are merged at a time.
PART_ROWS = 1_000
MERGED_PARTS = 8

_SCHEMA = (
    "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
    "base_score double, score double, bits_per_byte double"
)


class _Words:
    """The tokens of some texts: distinct ones, and all of them as numbers of these."""

    def __init__(self, texts: list[str | None]) -> None:
        names, self.of, self.counts = mixing.tokens_of(pa.array(texts, pa.string()))
        self.names = names.to_pylist()


def _seen_before(text: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each token: how far the document's own tokens so far count, and its share of them."""
    at = np.arange(len(of))
    place = at - np.searchsorted(text, text)
    order = np.lexsort((of, text))  # stable, so places ascend
    same = np.zeros(len(order), bool)
    same[1:] = (np.diff(of[order]) == 0) & (np.diff(text[order]) == 0)
    times = np.empty(len(order), np.int64)
    times[order] = at - np.maximum.accumulate(np.where(same, 0, at))
    return place / (place + OWN_TOKENS), times / np.maximum(place, 1)


def _with_own(overall: np.ndarray, before: np.ndarray, share: np.ndarray) -> Iterator[np.ndarray]:
    """log10 probability of each token for each expert, who trusts the document's own tokens so much."""
    seen = share > 0
    for weight in OWN_WEIGHTS:
        own = weight * before
        p = np.log10(1 - own) + overall
        p[seen] = np.log10((1 - own[seen]) * 10.0 ** overall[seen] + (own * share)[seen])
        yield p


def _totals(scorer: mixing.Scorer, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """log10 probability of each text, a row for each expert; and by context mixing alone. Texts are taken
    a block at a time."""
    sizes = np.cumsum([len(t.encode("utf-8", "surrogatepass")) for t in texts]) // mixing.BLOCK_BYTES
    total, mixed = [], []
    for block in np.split(np.arange(len(texts)), np.flatnonzero(np.diff(sizes)) + 1):
        text, word, cost = scorer.words([texts[i] for i in block])
        mixed.append(np.bincount(text, weights=cost, minlength=len(block)))
        total.append(np.stack([
            np.bincount(text, weights=p, minlength=len(block)) for p in _with_own(cost, *_seen_before(text, word))
        ]))
    return np.concatenate(total, axis=1), np.concatenate(mixed)


def _pack(names: list[str], counts: np.ndarray) -> bytes:
    body = " ".join(names).encode("utf-8", "surrogatepass")  # the end token is the empty name
    raw = len(names).to_bytes(8, "little") + counts.astype("<i8").tobytes() + body
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def _merged(parts: list[pa.Table]) -> pa.Table:
    """The sums of ``n`` by name."""
    return pa.concat_tables(parts).group_by("name").aggregate([("n", "sum")]).rename_columns({"n_sum": "n"})


def _unpack(data: bytes) -> tuple[list[str], np.ndarray]:
    raw = pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True)
    n = int.from_bytes(raw[:8], "little")
    names = raw[8 + 8 * n :].decode("utf-8", "surrogatepass").split(" ") if n else []
    return names, np.frombuffer(raw[8 : 8 + 8 * n], "<i8")


def _answer(owner: int, questions: list[bytes]) -> list[bytes]:
    index: dict[str, int] = {}
    asked, counts = [], []
    for question in questions:
        names, own = _unpack(question)
        asked.append(np.array([index.setdefault(n, len(index)) for n in names], np.int64))
        counts.append(own)
    total = np.bincount(np.concatenate(asked), weights=np.concatenate(counts), minlength=len(index)).astype(np.int64)
    head = np.array([total.sum(), (total > 0).sum()], "<i8").tobytes()
    return [head + pa.compress(total[a].astype("<i8"), "zstd", asbytes=True) for a in asked]


_SCORERS: dict[int, mixing.Scorer] = {}


def _scorer(model) -> mixing.Scorer:
    """The worker's scorer of the newest model, kept between its tasks."""
    if id(model.value) not in _SCORERS:
        _SCORERS.clear()
        _SCORERS[id(model.value)] = mixing.Scorer(model.value)
    return _SCORERS[id(model.value)]


def score(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 10, fold: int = 0
) -> DataFrame:
    """One row for each document: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score,
    score, bits_per_byte``. ``score`` is the log10 probability of the whole text, and the last what context
    mixing alone takes for all its bits and the end mark, per byte; an empty text counts as one byte.

    All is learned from the documents with ``crc32(id) mod folds != fold``; a null id is one of them. A null
    or empty text is the end token alone. Repeated rows count and are returned as often as they come.
    Without training text every count is zero and every bit has probability one half. An empty table
    gives no rows.
    """
    spark = docs.sparkSession
    docs = common.id_text(docs, id_col, text_col)
    held_out = common.remainder(F.col("doc_id"), folds) == fold
    model = spark.sparkContext.broadcast(mixing.train(docs.filter(~held_out)))
    owners = max(common.shuffle_partitions(spark), -(-docs.count() // OWNER_ROWS))
    rows = docs.withColumn("held_out", held_out).rdd
    if not rows.getNumPartitions():
        rows = docs.withColumn("held_out", held_out).repartition(1).rdd

    def ask(it):
        parts = []
        while some := list(itertools.islice(it, PART_ROWS)):
            words = _Words([r[1] for r in some])
            trains = np.repeat(np.array([not r[2] for r in some], bool), words.counts)
            here = np.bincount(words.of[trains], minlength=len(words.names))
            parts.append(pa.table({"name": pa.array(words.names, pa.string()), "n": here}))
            if len(parts) == MERGED_PARTS:
                parts = [_merged(parts)]
        if parts:
            counts = _merged(parts)
            names, n = counts["name"].combine_chunks(), counts["n"].to_numpy()
            owner = np.concatenate([
                [zlib.crc32(x.encode("utf-8", "surrogatepass")) % owners for x in names.slice(i, 50_000).to_pylist()]
                for i in range(0, len(names), 50_000)
            ])
            order = np.argsort(owner, kind="stable")
            cuts = np.searchsorted(owner[order], np.arange(owners + 1))
            for o in range(owners):  # each is asked, for its totals
                own = order[cuts[o] : cuts[o + 1]]
                yield o, _pack(names.take(pa.array(own)).to_pylist(), n[own])

    def use(part, it, answers):
        names, known, n, v = [], [], 0, 0
        for _, question, answer in answers:
            own, _ = _unpack(question)
            names.append(pa.array(own, pa.string()))
            totals = np.frombuffer(answer[:16], "<i8")
            n, v = n + int(totals[0]), v + int(totals[1])
            known.append(np.frombuffer(pa.decompress(answer[16:], 8 * len(own), "zstd"), "<i8"))
        answers.clear()
        # packed, for as Python strings the words of a partition would fill its memory
        names, known = pa.concat_arrays(names), np.concatenate(known)
        scorer = _scorer(model)
        while some := list(itertools.islice(it, PART_ROWS)):
            words = _Words([r[1] for r in some])
            count = known[pc.index_in(pa.array(words.names, pa.string()), names).to_numpy()]
            log = np.log10((count + SMOOTHING) / (n + SMOOTHING * (v + 1)))
            total, mixed = _totals(scorer, [r[1] for r in some])
            text = np.repeat(np.arange(len(some)), words.counts)
            # the experts start with equal weights; those that predict a document well lead in it
            best = total.max(axis=0)
            scores = best + np.log10((10.0 ** (total - best)).mean(axis=0))
            sums = [
                np.bincount(text, weights=w, minlength=len(some)).tolist()
                for w in (count[words.of] > 0, log[words.of])
            ]
            for r, size, score, cm, hits, base in zip(
                some, words.counts.tolist(), scores.tolist(), mixed.tolist(), *sums, strict=True
            ):
                length = max(1, len(r[1].encode("utf-8", "surrogatepass")))
                yield r[0], r[2], size, int(hits), n, base, score, -cm * float(np.log2(10)) / length

    return spark.createDataFrame(exchange(rows, owners, ask, _answer, use), _SCHEMA, verifySchema=False)
