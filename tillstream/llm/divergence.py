"""Which terms set the sources of a language apart, by chunk factorization.

Texts are never tokenized one by one. A task cuts its documents at ASCII white space, counts their chunks, and sends the sums
by chunk, language and source to the chunk's bucket. There every chunk that is distinct over the whole corpus is tokenized
once, and its terms are joined back to its sums. No term reaches across ASCII white space, so the terms of the chunks are
the terms of the text and occurrences are plain sums.

Documents with a term are not: one may have it in several chunks (``word``, ``word,``). Only whether a language has enough of
them counts. A chunk with enough documents settles its terms; a term whose chunks together have too few is out. For a term between
the two every chunk is rare, so the chunk's documents, which travel with rare chunks, are a short list, and the term's distinct ones are
counted exactly.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstream.llm import common

#: Runs of ASCII letters and of everything beyond ASCII.
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")

#: Bytes of text that a task counts at a time; a longer text is taken alone.
SLICE_BYTES = 12 << 20
#: Sums that a bucket reads before it adds them up, and rows it writes at a time.
FOLD_CELLS = 1 << 20
ROWS_OUT = 1 << 16

#: Shares are whole parts of this; :func:`_share` divides by its three groups of three digits.
SCALE = 1_000_000_000
MIN_DOCS = 10
TOP = 10

_CELLS = (
    "bucket int, words string, langs array<string>, sources array<string>, begin bigint, "
    "word array<int>, grp array<int>, n array<int>, docs array<int>, ids array<int>"
)
_PARTIAL = "lang string, term string, docs bigint, ids array<bigint>, of array<struct<source:string,n:bigint>>"


def terms_of(chunk: str) -> list[str]:
    """The terms of a text in order; only A-Z are lower-cased."""
    return TERM.findall(chunk.encode().lower().decode())


class _Codes(dict):
    """The next number for whatever is new."""

    def __missing__(self, key):
        self[key] = number = len(self)
        return number


def _firsts(keys: np.ndarray) -> np.ndarray:
    """Where each run of equal keys begins."""
    return np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))[: len(keys)])


def _summed(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Different keys in order with the sums of their values."""
    order = np.argsort(keys)
    keys = keys[order]
    first = _firsts(keys)
    return keys[first], *(np.add.reduceat(v[order], first) if len(first) else v for v in values)


def _ranges(begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places of all ranges, one range after the other."""
    ends = np.cumsum(lengths)
    return np.repeat(begins - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of about ``SLICE_BYTES`` of text."""
    held: list[pa.RecordBatch] = []
    for batch in common.slices(batches, "text", SLICE_BYTES):
        if held and sum(b.nbytes for b in held) + batch.nbytes > SLICE_BYTES:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held = []
        held.append(batch)
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _counter(buckets: int, few: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Occurrences and documents by chunk and group, a row for each bucket; a sum of fewer than ``few`` documents names them."""
        for batch in _gathered(batches):
            codes = _Codes()
            pairs = zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), strict=True)
            group = np.array([codes[pair] for pair in pairs], np.int64)
            row = batch.column("row").to_numpy()
            chunks, per_doc = common.chunks_of(batch.column("text"))
            words = chunks.dictionary.to_pylist()
            bucket = np.fromiter((zlib.crc32(w.encode()) % buckets for w in words), np.int64, len(words))
            # words by bucket, so that a bucket's sums lie side by side
            by_bucket = np.argsort(bucket, kind="stable")
            place = np.empty(len(words), np.int64)
            place[by_bucket] = np.arange(len(words))
            word = place[chunks.indices.to_numpy()]
            doc = np.repeat(np.arange(len(group)), per_doc)
            keys, n = _summed(word * len(group) + doc, np.ones(len(doc), np.int64))
            word, doc = np.divmod(keys, len(group))
            cells = word * len(codes) + group[doc]
            order = np.argsort(cells, kind="stable")
            cells, doc = cells[order], doc[order]
            first = _firsts(cells)
            docs = np.diff(np.append(first, len(cells)))
            word, group_of = np.divmod(cells[first], len(codes))
            n = np.add.reduceat(n[order], first)
            listed = np.where(docs < few, docs, 0)
            begins = np.concatenate(([0], np.cumsum(listed)))
            ids = row[doc[_ranges(first, listed)]]
            word_ends = np.searchsorted(bucket[by_bucket], np.arange(buckets + 1))
            cell_ends = np.searchsorted(word, word_ends)
            for i in np.flatnonzero(np.diff(word_ends)):
                (w0, w1), (c0, c1) = word_ends[i : i + 2], cell_ends[i : i + 2]
                columns = {
                    "bucket": pa.scalar(i, pa.int32()),
                    "words": " ".join([words[k] for k in by_bucket[w0:w1]]),
                    "langs": [lang for lang, _ in codes],
                    "sources": [source for _, source in codes],
                    "begin": pa.scalar(row[0], pa.int64()),
                    "word": (word[c0:c1] - w0).astype(np.int32),
                    "grp": group_of[c0:c1].astype(np.int32),
                    "n": n[c0:c1].astype(np.int32),
                    "docs": docs[c0:c1].astype(np.int32),
                    # the rows of a slice are numbered in a row
                    "ids": (ids[begins[c0] : begins[c1]] - row[0]).astype(np.int32),
                }
                yield pa.RecordBatch.from_arrays([_one(v) for v in columns.values()], list(columns))
            pa.default_memory_pool().release_unused()

    return count


def _one(value) -> pa.Array:
    """A column of one row."""
    if isinstance(value, pa.Scalar):
        return pa.array([value.as_py()], value.type)
    if isinstance(value, str):
        return pa.array([value], pa.string())
    values = pa.array(value, pa.string()) if isinstance(value, list) else pa.array(value)
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


class _Bucket:
    """Sums of the chunks of a partition; memory follows its distinct chunks and groups."""

    def __init__(self, few: int) -> None:
        self.few, self.held = few, 0
        self.words, self.langs, self.groups = _Codes(), _Codes(), _Codes()
        self.cells = [tuple(np.zeros(0, np.int64) for _ in range(3))]
        self.ids = [tuple(np.zeros(0, np.int64) for _ in range(2))]

    def add(self, row: dict) -> None:
        words = np.array([self.words[w] for w in row["words"].as_py().split(" ")], np.int64)
        groups, langs = [], []
        for lang, source in zip(row["langs"].as_py(), row["sources"].as_py(), strict=True):
            langs.append(self.langs[lang])
            groups.append(self.groups[self.langs[lang], source])
        word, group, n, docs, ids = (row[c].values.to_numpy().astype(np.int64) for c in ("word", "grp", "n", "docs", "ids"))
        ids += row["begin"].as_py()
        self.cells.append(((words[word] << 32) + np.array(groups, np.int64)[group], n, docs))
        owner = (words[word] << 32) + np.array(langs, np.int64)[group]
        self.ids.append((np.repeat(owner, np.where(docs < self.few, docs, 0)), ids))
        self.held += len(word)
        if self.held >= FOLD_CELLS:
            self.fold()

    def fold(self) -> None:
        """Add up, and forget the documents of chunks that are not rare."""
        cells, n, docs = _summed(*(np.concatenate(x) for x in zip(*self.cells, strict=True)))
        self.cells, self.held = [(cells, n, docs)], 0
        self.lang_of = np.array([lang for lang, _ in self.groups], np.int64)
        self.owner = (cells >> 32 << 32) + self.lang_of[cells & 0xFFFFFFFF] if len(cells) else cells
        self.owners, self.docs = _summed(self.owner, docs)
        owner, ids = (np.concatenate(x) for x in zip(*self.ids, strict=True))
        keep = self.docs[np.searchsorted(self.owners, owner)] < self.few if len(owner) else np.zeros(0, bool)
        self.ids = [(owner[keep], ids[keep])]

    def rows(self) -> Iterator[pa.RecordBatch]:
        """A row for each chunk, language and term of the chunk."""
        self.fold()
        codes = _Codes()
        flat, times, lengths = [], [], []
        for word in self.words:
            found = _Codes()
            for term in terms_of(word):
                found[term] = dict.get(found, term, 0) + 1
            flat.extend(codes[term] for term in found)
            times.extend(found.values())
            lengths.append(len(found))
        flat, times, lengths = (np.array(x, np.int64) for x in (flat, times, lengths))
        begins = np.cumsum(lengths) - lengths
        terms = np.array(list(codes), object)
        names = pa.array(list(self.langs), pa.string())
        sources = pa.array([source for _, source in self.groups], pa.string())
        (cells, n, _), (id_owner, ids) = self.cells[0], self.ids[0]
        order = np.argsort(self.owner, kind="stable")
        group, n = cells[order] & 0xFFFFFFFF, n[order]
        cell_at = np.searchsorted(self.owner[order], self.owners)
        cell_n = np.diff(np.append(cell_at, len(order)))
        order = np.argsort(id_owner, kind="stable")
        ids = ids[order]
        id_at = np.searchsorted(id_owner[order], self.owners)
        id_n = np.searchsorted(id_owner[order], self.owners, "right") - id_at
        for i in range(0, len(self.owners), ROWS_OUT):
            word, lang = self.owners[i : i + ROWS_OUT] >> 32, self.owners[i : i + ROWS_OUT] & 0xFFFFFFFF
            own = i + np.repeat(np.arange(len(word)), lengths[word])
            at = _ranges(begins[word], lengths[word])
            of = _ranges(cell_at[own], cell_n[own])
            pairs = [sources.take(pa.array(group[of])), pa.array(n[of] * np.repeat(times[at], cell_n[own]))]
            columns = [
                names.take(pa.array(lang[own - i])), pa.array(terms[flat[at]], pa.string()), pa.array(self.docs[own]),
                _lists(id_n[own], pa.array(ids[_ranges(id_at[own], id_n[own])])),
                _lists(cell_n[own], pa.StructArray.from_arrays(pairs, ["source", "n"])),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "term", "docs", "ids", "of"])


def _lists(lengths: np.ndarray, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)), values)


def _joiner(few: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Every distinct chunk of the partition tokenized once, with its sums."""
        held = _Bucket(few)
        for batch in batches:
            for i in range(batch.num_rows):
                held.add({name: batch.column(name)[i] for name in batch.schema.names})
        yield from held.rows()

    return join


def _text(name: str) -> Column:
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit("")).alias(name)


def partial_counts(docs: DataFrame, few: int = 0) -> DataFrame:
    """``lang, term, docs, ids, of``: a row for each distinct chunk, language and term of the chunk.

    ``docs`` is how many documents of the language have the chunk, ``ids`` names them if they are fewer than ``few``, ``of`` has the
    occurrences of the term in that chunk by source.
    """
    rows = docs.select(_text("text"), _text("lang"), _text("source"), F.monotonically_increasing_id().alias("row"))
    parts = max(common.shuffle_partitions(docs.sparkSession), rows.rdd.getNumPartitions())
    # twice as many buckets as tasks, so that tasks differ less
    cells = rows.mapInArrow(_counter(2 * parts, few), _CELLS).repartition(parts, "bucket")
    return common.stage(cells.mapInArrow(_joiner(few), _PARTIAL), "chunk-terms")


def counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n``: occurrences of each term.

    Null texts, languages and sources count as empty, repeated rows each, other columns are ignored.
    """
    rows = partial_counts(docs).select("lang", "term", F.inline("of"))
    return rows.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"))


def _frequent(partial: DataFrame, min_docs: int) -> DataFrame:
    """``lang, term`` of the terms that at least ``min_docs`` documents of the language have."""
    known = partial.groupBy("lang", "term").agg(F.max("docs").alias("least"), F.sum("docs").alias("most"))
    known = common.stage(known.filter(F.col("most") >= min_docs), "bounds")
    sure = known.filter(F.col("least") >= min_docs).select("lang", "term")
    # each chunk of an unsure term is rare and names its documents
    unsure = known.filter(F.col("least") < min_docs).select("lang", "term")
    listed = partial.filter(F.size("ids") > 0).select("lang", "term", "ids").join(unsure, ["lang", "term"])
    exact = listed.select("lang", "term", F.explode("ids").alias("row")).distinct().groupBy("lang", "term").count()
    return sure.unionByName(exact.filter(F.col("count") >= min_docs).select("lang", "term"))


def _share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (count + 2) / (total + 2 * terms)), exact for totals up to 9 * 10^15.

    By long division, three digits of the result at a time, so that no product is too large.
    """
    rest, whole = count + 2, F.lit(0).cast("bigint")
    all_ = total + 2 * terms
    for _ in range(3):
        whole, rest = whole * 1_000 + F.call_function("div", rest * 1_000, all_), (rest * 1_000) % all_
    return whole + 1


def _gap(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """``lang, source, part, item, value, rank`` of every language and source that occurs.

    A language keeps the terms that at least ``min_docs`` of its documents have. Part ``pair`` compares the shares of all
    kept terms with those of each other source of the language; part ``term`` lists the ``top`` kept terms of the source whose share
    exceeds the language's. Null texts, languages and sources count as empty; repeated rows are documents each; a table without
    rows gives none. Ties rank by the item's bytes.

    A pair of sources costs the terms that both have: the sum over the terms of one source alone, and of neither, follows from the
    source's histogram of counts, since a share depends only on the count.
    """
    partial = partial_counts(docs, min_docs)
    often = common.stage(_frequent(partial, min_docs), "frequent-terms")
    # most terms are rare: only the others are taken apart by source
    by_source = partial.select("lang", "term", "of").join(often, ["lang", "term"]).select("lang", "term", F.inline("of"))
    by_source = by_source.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"))
    kept = by_source.groupBy("lang", "term").agg(
        F.sum("n").alias("total"), F.sort_array(F.collect_list(F.struct("source", "n"))).alias("of")
    )
    kept = common.stage(kept, "kept-terms")
    present = kept.select("lang", "term", "total", F.inline("of"))
    langs = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("total").alias("lang_n"))
    # how many kept terms a source has how often
    spread = common.stage(present.groupBy("lang", "source", "n").agg(F.count("*").alias("terms_n")), "histograms")
    sums = spread.groupBy("lang", "source").agg(
        F.sum(F.col("n") * F.col("terms_n")).alias("source_n"), F.sum("terms_n").alias("has")
    )
    groups = docs.select(_text("lang"), _text("source")).distinct().join(sums, ["lang", "source"], "left").join(langs, "lang", "left")
    zero = F.lit(0).cast("bigint")
    groups = groups.select(
        "lang", "source", *[F.coalesce(c, zero).alias(c) for c in ("source_n", "has", "terms", "lang_n")]
    )
    without = F.when(F.col("terms") > 0, _share(zero, F.col("source_n"), F.col("terms"))).otherwise(zero)
    groups = common.stage(groups.withColumn("p0", without), "groups")
    return _pairs(kept, spread, groups).unionByName(_terms(present, groups, top))


def _pairs(kept: DataFrame, spread: DataFrame, groups: DataFrame) -> DataFrame:
    def side(prefix: str) -> DataFrame:
        return groups.select("lang", "terms", *[F.col(c).alias(f"{prefix}_{c}") for c in ("source", "source_n", "has", "p0")])

    def share(count: str, prefix: str) -> Column:
        return _share(F.col(count), F.col(f"{prefix}_source_n"), F.col("terms"))

    a0, b0 = F.col("a_p0"), F.col("b_p0")
    two = side("a").join(side("b").drop("terms"), "lang")
    # terms of neither source, as if no term were in both
    base = two.filter("a_source < b_source").select(
        "lang", "a_source", "b_source",
        F.when(F.col("terms") > 0, (F.col("terms") - F.col("a_has") - F.col("b_has")) * _gap(a0, b0))
        .otherwise(F.lit(0)).cast("bigint").alias("value"),
    )
    # terms of one source against the other's share of an absent term
    own = spread.select("lang", F.col("source").alias("a_source"), "n", "terms_n").join(two, ["lang", "a_source"])
    own = own.filter("a_source != b_source").select(
        "lang", F.least("a_source", "b_source").alias("a_source"), F.greatest("a_source", "b_source").alias("b_source"),
        (F.col("terms_n") * _gap(share("n", "a"), b0)).alias("value"),
    )
    # terms of both: what the two parts above count wrongly
    rest = F.transform("of", lambda x, i: F.struct(x.alias("a"), F.slice("of", i + 2, F.size("of")).alias("others")))
    met = kept.select("lang", F.inline(rest)).select("lang", "a", F.explode("others").alias("b"))
    met = met.groupBy(
        "lang", F.col("a.source").alias("a_source"), F.col("b.source").alias("b_source"),
        F.col("a.n").alias("a_n"), F.col("b.n").alias("b_n"),
    ).agg(F.count("*").alias("times"))
    met = met.join(two, ["lang", "a_source", "b_source"])
    a, b = share("a_n", "a"), share("b_n", "b")
    both = met.select(
        "lang", "a_source", "b_source", (F.col("times") * (_gap(a, b) - _gap(a, b0) - _gap(a0, b) + _gap(a0, b0))).alias("value")
    )
    pairs = base.unionByName(own).unionByName(both).groupBy("lang", "a_source", "b_source").agg(F.sum("value").alias("value"))
    ways = F.array(
        F.struct(F.col("a_source").alias("source"), F.col("b_source").alias("item")),
        F.struct(F.col("b_source").alias("source"), F.col("a_source").alias("item")),
    )
    return _ranked(pairs.select("lang", "value", F.inline(ways)), "pair")


def _terms(present: DataFrame, groups: DataFrame, top: int) -> DataFrame:
    rows = present.join(groups, ["lang", "source"])
    p = _share(F.col("n"), F.col("source_n"), F.col("terms"))
    q = _share(F.col("total"), F.col("lang_n"), F.col("terms"))
    rows = rows.select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q")).filter("p > q")
    return _ranked(rows.withColumn("value", _gap(F.col("p"), F.col("q"))), "term", top)


def _ranked(rows: DataFrame, part: str, top: int | None = None) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    rows = rows.withColumn("rank", F.row_number().over(order))
    if top is not None:
        rows = rows.filter(F.col("rank") <= top)
    return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")
