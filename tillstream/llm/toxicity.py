"""Toxicity by subword-bag embeddings and a linear softmax.

A word is the mean of the vectors of its character n-grams and of itself, hashed into one table. A
stretch of ``SPAN`` words is the mean of its words, and a linear layer with softmax tells how toxic
it is. Vectors and layer are trained jointly by stochastic gradient descent. A document is as toxic
as its worst stretch; as only documents are labelled, the stretches of a toxic one that count as
toxic are its worst under the model so far. An unseen spelling shares n-grams with the seen ones.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.llm import common

#: Labelled rows the model is fitted on, at most (the rows with the smallest hashes of their ids).
SAMPLE_ROWS = 6_000

THRESHOLD = 0.3
BUCKET_BITS = 17
BUCKETS = 1 << BUCKET_BITS
DIMENSION = 8
GRAMS = (3, 4, 5, 6)
SPAN = 6

#: Words taken apart at a time.
PART_WORDS = 20_000

#: Words whose worth a worker keeps between texts.
CACHE_WORDS = 500_000

#: Stretches scored at a time.
BATCH_BYTES = 4 << 20

#: Taken off both ends of a word, unless nothing else is left.
_EDGE = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())

_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def words_of(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct lower-case words without the punctuation around them, the words of all texts in a row
    as numbers of these, and where each text ends."""
    chunks, counts = common.chunks_of(pc.utf8_lower(texts.fill_null("")))
    index: dict[str, int] = {}
    of = np.array([index.setdefault(c.strip(_EDGE) or c, len(index)) for c in chunks.dictionary.to_pylist()], np.int64)
    words = of[chunks.indices.to_numpy()]
    there = words != index.get("", -1)
    ends = np.concatenate(([0], np.cumsum(there)))[np.cumsum(counts)]
    return list(index), words[there], ends


def subwords(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Table rows of each word and its n-grams, word by word, and how many each word has."""
    marked = [f"<{w}>" for w in words]
    points = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64) + np.uint64(1)
    sizes = np.array([len(m) for m in marked], np.int64)
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(words)), sizes)
    left = ends[owner] - np.arange(len(points))  # characters from here to the word's end
    powers = np.cumprod(np.full(int(sizes.max(initial=1)), _FACTOR, np.uint64))
    hashes = [np.add.reduceat(points * powers[sizes[owner] - left], ends - sizes)] if len(words) else []
    owners = [np.arange(len(words))]
    for n in GRAMS:
        at = np.flatnonzero(left >= n)
        h = np.full(len(at), n, np.uint64)
        for k in range(n):
            h = h * _FACTOR + points[at + k]
        hashes.append(h)
        owners.append(owner[at])
    h, owner = np.concatenate([*hashes, np.zeros(0, np.uint64)]), np.concatenate(owners)
    h ^= h >> np.uint64(29)
    h *= _FACTOR
    order = np.argsort(owner, kind="stable")
    return (h[order] >> np.uint64(64 - BUCKET_BITS)).astype(np.int32), np.bincount(owner, minlength=len(words))


@dataclass
class Bag:
    """Table of vectors, the linear layer of the toxic class against the other, and the calibration."""

    table: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    calibration: tuple[float, float] = (1.0, 0.0)

    def worth(self, words: list[str]) -> np.ndarray:
        """Each word's part in the log-odds of a stretch: averaging and the layer are linear, so
        the log-odds of a stretch are the mean of its words' worth and the bias."""
        if not words:
            return np.zeros(0)
        rows, lengths = subwords(words)
        direction = self.table @ (self.weights[:, 1] - self.weights[:, 0])
        return np.add.reduceat(direction[rows], np.cumsum(lengths) - lengths) / lengths

    def log_odds(self, spans: np.ndarray) -> np.ndarray:
        return spans + (self.bias[1] - self.bias[0])


def worst(worth: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each text (given by the end of its words) the largest mean of ``SPAN`` words in a row and
    where it begins; a shorter text is one stretch, an empty one has mean 0."""
    begins = np.concatenate(([0], ends[:-1]))
    total = np.concatenate(([0.0], np.cumsum(worth)))
    best, at = np.zeros(len(ends)), begins.copy()
    short = (ends - begins) <= SPAN
    some = short & (ends > begins)
    best[some] = (total[ends[some]] - total[begins[some]]) / (ends - begins)[some]
    if (~short).any():
        means = np.full(len(worth), -np.inf)
        means[: len(worth) - SPAN + 1] = (total[SPAN:] - total[:-SPAN]) / SPAN
        # no stretch may reach into the next text
        for back in range(1, SPAN):
            last = ends - back
            means[last[last >= begins]] = -np.inf
        long = np.flatnonzero(~short)
        for i in long.tolist():
            part = means[begins[i] : ends[i]]
            at[i] = begins[i] + int(part.argmax())
            best[i] = part.max()
    return best, at


class _Sample:
    """The training texts as word numbers, and each distinct word's table rows."""

    def __init__(self, texts: list[str]) -> None:
        index, self.words, self.ends = words_of(pa.array(texts, pa.string()))
        parts = [subwords(index[i : i + PART_WORDS]) for i in range(0, len(index), PART_WORDS)] or [subwords([])]
        self.flat, self.lengths = (np.concatenate(p) for p in zip(*parts, strict=True))
        self.begins = np.cumsum(self.lengths) - self.lengths

    def worth(self, model: Bag) -> np.ndarray:
        direction = model.table @ (model.weights[:, 1] - model.weights[:, 0])
        out = np.zeros(len(self.lengths))
        for i in range(0, len(out), PART_WORDS):
            first, own = self.begins[i], self.begins[i : i + PART_WORDS]
            last = own[-1] + self.lengths[i : i + PART_WORDS][-1]
            out[i : i + PART_WORDS] = np.add.reduceat(direction[self.flat[first:last]], own - first)
        return (out / self.lengths)[self.words]

    def step(self, model: Bag, begins: np.ndarray, sizes: np.ndarray, y: np.ndarray, rate: float) -> None:
        """One gradient step on stretches of words."""
        at = np.repeat(begins - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        word, owner = self.words[at], np.repeat(np.arange(len(sizes)), sizes)
        n = self.lengths[word]
        rows = self.flat[np.repeat(self.begins[word] - np.cumsum(n) + n, n) + np.arange(n.sum())]
        owner, share = np.repeat(owner, n), np.repeat(1.0 / (n * sizes[owner]), n)
        firsts = np.flatnonzero(np.diff(owner, prepend=-1))
        hidden = np.add.reduceat(model.table[rows] * share[:, None], firsts)
        out = hidden @ model.weights + model.bias
        p = np.exp(out - out.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        p[np.arange(len(y)), y] -= 1.0
        back = (p @ model.weights.T)[owner] * share[:, None]
        model.weights -= rate * hidden.T @ p / len(y) * 8
        model.bias -= rate * p.mean(axis=0)
        for d in range(DIMENSION):
            model.table[:, d] -= rate * np.bincount(rows, weights=back[:, d], minlength=BUCKETS)


def fit(texts: list[str], toxic: np.ndarray, epochs: int = 6, seed: int = 7, rate: float = 1.5) -> Bag | None:
    """The model of labelled texts; None unless both labels occur."""
    if not len(texts) or toxic.min() == toxic.max():
        return None
    rng = np.random.default_rng(seed)
    table = rng.uniform(-1, 1, (BUCKETS, DIMENSION)) / DIMENSION
    model = Bag(table, rng.normal(0, 0.3, (DIMENSION, 2)), np.zeros(2))
    sample = _Sample(texts)
    ends, begins = sample.ends, np.concatenate(([0], sample.ends[:-1]))
    held = np.arange(len(texts)) % 5 == 4  # for the calibration
    full = np.flatnonzero(~held & (ends > begins))
    for epoch in range(epochs):
        _, peak = worst(sample.worth(model), ends)
        chosen, labels = [], []
        for i in full.tolist():
            n = int(ends[i] - begins[i])
            if n <= SPAN:
                starts = np.array([begins[i]])
            elif epoch == 0:  # nothing is known yet: every stretch has the document's label
                starts = begins[i] + np.arange(0, n - SPAN + 1, SPAN)
            elif toxic[i]:  # the worst stretch and those that overlap half of it
                half = SPAN // 2
                starts = np.unique(np.clip([peak[i] - half, peak[i], peak[i] + half], begins[i], ends[i] - SPAN))
            else:  # the worst stretch and a few others
                starts = np.append(begins[i] + rng.integers(0, n - SPAN + 1, min(6, n // SPAN)), peak[i])
            chosen.append(starts)
            labels.append(np.full(len(starts), toxic[i]))
        spans, y = np.concatenate(chosen), np.concatenate(labels).astype(np.int64)
        owner = np.searchsorted(ends, spans, side="right")
        sizes = np.minimum(SPAN, ends[owner] - spans)
        order = rng.permutation(len(spans))
        size = int(np.clip(len(order) // 200, 8, 256))  # few stretches: more steps
        for at in range(0, len(order), size):
            some = order[at : at + size]
            sample.step(model, spans[some], sizes[some], y[some], rate * (1 - 0.9 * epoch / epochs))
    best, _ = worst(sample.worth(model), ends)
    model.calibration = _calibrate(model.log_odds(best[held]), toxic[held])
    return model


def _calibrate(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of the logistic regression of y on x."""
    if len(x) < 20 or y.min() == y.max():
        return 1.0, 0.0
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        v, g = p * (1 - p) + 1e-6, p - y
        step = np.linalg.solve(
            np.array([[(v * x * x).sum() + 1.0, (v * x).sum()], [(v * x).sum(), v.sum()]]),
            np.array([(g * x).sum() + (a - 1.0), g.sum()]),
        )
        a, b = a - step[0], b - step[1]
    return (float(a), float(b)) if a > 0 else (1.0, 0.0)


class Scorer:
    """Scores texts; keeps the worth of words it has seen."""

    def __init__(self, model: Bag | None) -> None:
        self.model, self.known, self.worth = model, {}, np.zeros(0)

    def scores(self, texts: pa.Array) -> np.ndarray:
        if self.model is None:
            return np.full(len(texts), 0.5)
        if len(self.known) > CACHE_WORDS:
            self.known, self.worth = {}, np.zeros(0)
        known = self.known
        words, of, ends = words_of(texts)
        numbers = np.array([known.setdefault(w, len(known)) for w in words], np.int64)
        if len(known) > len(self.worth):
            new = list(itertools.islice(known, len(self.worth), None))
            found = [self.model.worth(new[i : i + PART_WORDS]) for i in range(0, len(new), PART_WORDS)]
            self.worth = np.concatenate([self.worth, *found])
        best, _ = worst(self.worth[numbers[of]] if len(of) else np.zeros(0), ends)
        a, b = self.model.calibration
        return 1 / (1 + np.exp(-np.clip(a * self.model.log_odds(best) + b, -30, 30)))


def train(docs: DataFrame, labels: DataFrame, use, rows: int = SAMPLE_ROWS) -> Bag | None:
    """Fit on whole texts of at most ``rows`` labelled documents of which ``use(doc_id)`` holds."""
    some = (
        labels.select(F.col("doc_id").cast("bigint").alias("of"), F.col("toxic").cast("int").alias("label"))
        .filter(use(F.col("of")) & F.col("label").isNotNull())
        .orderBy(F.xxhash64("of"), "of", "label")
        .limit(rows)
    )
    found = common.id_text(docs).join(F.broadcast(some), F.col("doc_id") == F.col("of")).select("label", "text").collect()
    return fit([r.text for r in found], np.array([r.label for r in found]))


def classify(docs: DataFrame, labels: DataFrame, folds: int = 4, fold: int = 2, rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row for each document: ``doc_id, held_out, score, predicted``.

    Labels of documents with ``crc32(id) mod folds = fold`` are never read. A null or empty text has
    the score of an empty stretch. Without usable labels every score is 0.5. Repeated rows are
    scored each; a document labelled twice counts twice.
    """
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(train(docs, labels, lambda i: common.remainder(i, folds) != fold, rows))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model.value)
        for batch in common.slices(batches, "text", BATCH_BYTES):
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scorer.scores(batch.column(1)))], ["doc_id", "score"]
            )

    return common.id_text(docs).mapInArrow(scored, "doc_id bigint, score double").select(
        "doc_id",
        (common.remainder(F.col("doc_id"), folds) == fold).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
