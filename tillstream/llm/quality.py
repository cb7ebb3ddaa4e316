"""Document quality by a regularised quadratic discriminant.

A document is described by statistics of its characters, words and lines, transformed to be roughly
normal. Each class has a mean and a covariance that is shrunk towards its own diagonal and
towards the covariance of both classes. The score is the logistic of the difference of the two log densities, whose
Mahalanobis distances come from Cholesky factors that are computed once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.llm import common

#: Labelled rows the model is fitted on, at most (the rows with the smallest hashes of their ids).
SAMPLE_ROWS = 20_000

THRESHOLD = 0.3

#: Kinds of bytes whose shares are counted; bytes of other scripts count as letters.
_UPPER, _LOWER, _DIGIT, _SPACE, _STOP, _MARK, _LINE = range(7)


def _kinds() -> np.ndarray:
    kind = np.full(256, _LOWER)
    kind[ord("A") : ord("Z") + 1] = _UPPER
    kind[ord("0") : ord("9") + 1] = _DIGIT
    kind[33:48] = kind[58:65] = kind[91:97] = kind[123:127] = _MARK
    kind[[ord(c) for c in ".,;:"]] = _STOP
    kind[:33] = _SPACE
    kind[ord("\n")] = _LINE
    return kind


_KIND = _kinds()


#: Counts added to a share, so that those of a few words stay near what is usual.
PRIOR_COUNT = 12.0


def _share(part: float, whole: float, usual: float) -> float:
    """A share as log-odds, with ``PRIOR_COUNT`` counts of the usual share added."""
    more = PRIOR_COUNT * usual
    return float(np.log((part + more) / (max(whole - part, 0) + PRIOR_COUNT - more)))


def statistics(text: str | None) -> list[float]:
    """The transformed statistics of one text; an empty text has those of zero counts."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    by_kind = np.bincount(_KIND, weights=counts, minlength=7)
    n = len(raw)
    present = counts[counts > 0] / max(n, 1)
    entropy = float(-(present * np.log2(present)).sum()) if n else 0.0
    words = (text or "").split()
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    spread = float(((lengths - lengths.mean()) ** 2).sum()) if words else 0.0
    lines = [x for x in (text or "").split("\n") if x]
    distinct = set(words)
    repeats = sum(map(eq, words, words[1:]))
    again = sum(map(eq, words, words[2:]))
    marked = sum(1 for w in words if not w[-1].isalnum() and w[-1] not in ".,;:")
    alone = sum(1 for w in words if not w[0].isalnum() and len(w) == 1)
    seen_lines = len(set(lines))
    letters = by_kind[_UPPER] + by_kind[_LOWER]
    return [
        float(np.log((lengths.sum() + PRIOR_COUNT * 6.0) / (len(words) + PRIOR_COUNT))),
        float(np.log((spread + PRIOR_COUNT * 9.0) / (len(words) + PRIOR_COUNT))),
        _share(by_kind[_UPPER], letters, 0.04),
        _share(by_kind[_DIGIT], n, 0.005),
        _share(by_kind[_MARK], n, 0.005),
        _share(by_kind[_STOP], n, 0.03),
        _share(by_kind[_SPACE], n, 0.15),
        _share(len(distinct), len(words), 0.9),
        _share(repeats, len(words), 0.01),
        _share(again, len(words), 0.01),
        _share(marked, len(words), 0.02),
        _share(alone, len(words), 0.02),
        _share(seen_lines, len(lines), 0.95),
        float(np.log((n + PRIOR_COUNT * 80) / (len(lines) + PRIOR_COUNT))),
        (entropy * n + 100 * PRIOR_COUNT * 4.1) / (n + 100 * PRIOR_COUNT),
        float(np.log((counts.max() + 100 * PRIOR_COUNT * 0.15) / (n + 100 * PRIOR_COUNT))),
    ]


FEATURES = len(statistics(""))


@dataclass(frozen=True)
class Discriminant:
    """Two normal densities with cached factors, and the log odds of the classes."""

    scale: tuple[np.ndarray, np.ndarray]
    means: tuple[np.ndarray, np.ndarray]
    inverse_factors: tuple[np.ndarray, np.ndarray]
    log_determinants: tuple[float, float]
    log_odds: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        """The probability of class 1 for each row."""
        x = (x - self.scale[0]) / self.scale[1]
        density = []
        for mean, inverse, log_det in zip(self.means, self.inverse_factors, self.log_determinants, strict=True):
            z = (x - mean) @ inverse.T
            density.append(-0.5 * (z * z).sum(axis=1) - log_det)
        odds = np.clip(density[1] - density[0] + self.log_odds, -500, 500)
        return 1.0 / (1.0 + np.exp(-odds))


def fit(x: np.ndarray, y: np.ndarray, pooled: float = 0.2, diagonal: float = 0.05) -> Discriminant | None:
    """The model of rows ``x`` with labels ``y``; None unless both classes occur."""
    if not len(x) or y.min() == y.max():
        return None
    scale = (x.mean(axis=0), x.std(axis=0) + 1e-6)
    x = (x - scale[0]) / scale[1]
    both = np.cov(x.T, bias=True)
    means, factors, dets = [], [], []
    for label in (0, 1):
        own = x[y == label]
        cov = np.cov(own.T, bias=True) if len(own) > 1 else both
        shrink = max(pooled, FEATURES / (len(own) + FEATURES))
        cov = (1 - shrink) * cov + shrink * both
        cov = (1 - diagonal) * cov + diagonal * np.diag(np.diag(cov)) + 1e-3 * np.eye(len(cov))
        lower = np.linalg.cholesky(cov)
        means.append(own.mean(axis=0))
        factors.append(np.linalg.inv(lower))
        dets.append(float(np.log(np.diag(lower)).sum()))
    odds = float(np.log((y == 1).sum() / (y == 0).sum()))
    return Discriminant(scale, tuple(means), tuple(factors), tuple(dets), odds)


def _statistics_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    common.let_go()
    for batch in batches:
        rows = pa.array([statistics(t) for t in common.texts_of(batch)], pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([batch.column(0), rows], ["label", "stats"])


def train(docs: DataFrame, labels: DataFrame, label: str, use, rows: int = SAMPLE_ROWS) -> Discriminant | None:
    """Fit on at most ``rows`` labelled documents of which ``use(doc_id)`` holds.

    Labels that are null, or of documents that do not exist, are left out; a document labelled twice
    counts twice.
    """
    some = (
        labels.select(F.col("doc_id").cast("bigint").alias("of"), F.col(label).cast("int").alias("label"))
        .filter(use(F.col("of")) & F.col("label").isNotNull())
        .orderBy(F.xxhash64("of"), "of", "label")
        .limit(rows)
    )
    sample = common.id_text(docs).join(F.broadcast(some), F.col("doc_id") == F.col("of")).select("label", "text")
    found = sample.mapInArrow(_statistics_batches, "label int, stats array<double>").collect()
    if not found:
        return None
    return fit(np.array([r.stats for r in found]), np.array([r.label for r in found]))


def _probabilities(model: Discriminant | None, texts: pa.Array) -> pa.Array:
    common.let_go()
    x = np.array([statistics(t or "") for t in texts.to_pylist()]).reshape(-1, FEATURES)
    return pa.array(model.scores(x) if model else np.full(len(x), 0.5))


def score(docs: DataFrame, model: Discriminant | None, out: str = "score") -> DataFrame:
    """``docs`` with the probability of good quality; without a model every score is 0.5.

    Null and empty texts are scored like any other, repeated rows each, and all columns are kept.
    """
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.coalesce("text", F.lit("")).alias("text")
    )

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = _probabilities(model, batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), s], ["doc", "score"])

    schema = f"doc {rows.schema['doc'].dataType.simpleString()}, score double"
    return rows.mapInArrow(scored, schema).select("doc.*", F.col("score").alias(out))


def classify(docs: DataFrame, labels: DataFrame, folds: int = 5, fold: int = 0, rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row for each document: ``doc_id, held_out, score, predicted``.

    Labels of documents with ``crc32(id) mod folds = fold`` are never read. Null and empty texts are
    scored like any other, repeated rows each; a null id is never held out. An empty table gives no rows.
    """
    model = train(docs, labels, "quality", lambda i: common.remainder(i, folds) != fold, rows)
    return score(common.id_text(docs), model).select(
        "doc_id",
        (common.remainder(F.col("doc_id"), folds) == fold).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def keep(docs: DataFrame, labels: DataFrame, folds: int = 5, fold: int = 0, rows: int = SAMPLE_ROWS) -> DataFrame:
    """The documents that the classifier does not reject, with all their columns.

    Only the text goes to Python and only its score comes back; the other columns wait in the JVM.
    Null and empty texts are judged like any other, repeated rows each; an empty table gives no rows.
    """
    model = train(docs, labels, "quality", lambda i: common.remainder(i, folds) != fold, rows)

    def scored(texts: pa.Array) -> pa.Array:
        return _probabilities(model, texts)

    return docs.filter(F.arrow_udf(scored, "double")(F.col("text")) >= THRESHOLD)
