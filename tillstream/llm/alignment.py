"""Alignment of the tokens of two tokenizers, with corpus-wide counts of linked pairs.

Byte places where tokens of both end cut a text into groups; every token of one side is linked with every token of
the other side of its group. Neither tokenizer reaches from a visible character over the blank or line end behind
it, so a text is aligned chunk by chunk; a worker aligns each distinct chunk once and keeps it while it is in use.

1. The first pass lists the distinct id pairs of each document and adds documents up within a task.
2. The distinct pairs of the corpus are cut into regions by a hash, and a minimal perfect hash is built for each.
3. Tasks add their documents into dense vectors with one count for each index of a region; the vectors are summed by a tree
   of ``FAN_IN`` at a time.
4. The second pass aligns the documents again and looks the counts up: an index is good if the key stored there is the pair.

A pair is one of at most A x B numbers (1.6 thousand million here), whatever the corpus. What the tasks need of the regions is
broadcast for at most ``ROUND_KEYS`` keys at a time, under nine bytes each; more keys take more rounds over the documents.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import json
import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.llm import common
from tillstream.llm.mphf import PerfectHash

BYTE_BPE = "byte_bpe_50k.json"
PIECE_BPE = "piece_bpe_32k.model"

#: Keys of a region on average, and of the regions that are broadcast together at most.
REGION_KEYS = 1 << 18
ROUND_KEYS = 1 << 23
FAN_IN = 16

#: Distinct chunks a worker keeps aligned; beyond them it begins anew.
CACHE_CHUNKS = 250_000
#: Unseen chunks encoded together; their bytes tell them apart.
JOINED_CHUNKS = 2_000
#: Texts aligned at a time, and pairs that a task collects before it hands them on.
SLICE_BYTES = 2 << 20
HELD_PAIRS = 1 << 20

#: White space, then what is visible. A chunk begins with a blank or a line end behind a visible character.
_RUN = re.compile(r"\s*\S+|\s+")
_ODD_SPACE = re.compile(r"[^\S \n]")

_HASH = 2_654_435_761
_HASH_BITS = 32


def chunks_of(text: str) -> list[str]:
    """The text in pieces that both tokenizers take apart independently of each other."""
    runs = _RUN.findall(text)
    if not _ODD_SPACE.search(text):
        return runs
    out: list[str] = []
    for run in runs:
        if out and run[0] not in " \n":
            out[-1] += run
        else:
            out.append(run)
    return out


def _byte_level() -> dict[str, int]:
    """The byte behind each character of a byte-level vocabulary: printable bytes stand for themselves."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(0x100) if b not in shown]
    return {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(rest)}


def _gather(begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places ``begin, ..., begin + length - 1`` of all runs in a row."""
    ends = np.cumsum(lengths)
    return np.repeat(begins - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)


class _Numbers(dict):
    """Chunk to number; an unseen chunk gets the next number and waits to be aligned."""

    def __init__(self) -> None:
        self.waiting: list[str] = []

    def __missing__(self, chunk: str) -> int:
        self.waiting.append(chunk)
        self[chunk] = number = len(self)
        return number


def _distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different values in order, and how often each occurs."""
    values = np.sort(values)
    first = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1]))[: len(values)])
    return values[first], np.diff(np.append(first, len(values)))


#: Encoded before the chunks, one token on either side, so that no chunk stands at the beginning of a text.
_LEAD = " a"


class Aligner:
    """Aligned chunks by number: ``size`` has tokens of A, tokens of B, groups, links, and whether the bytes differ.

    ``keys`` has the pair of each link; ``marks`` the ids of the groups, each with the sign that follows it in their text.
    """

    def __init__(self, path_a: str, path_b: str) -> None:
        import sentencepiece
        import tiktoken

        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        byte = _byte_level()
        with open(path_a, encoding="utf-8") as file:
            stored = json.load(file)
        special = {token["content"] for token in stored["added_tokens"]}
        # The merges of a byte-level vocabulary are in the order of its ids, so it says all that an encoder needs.
        ranks = {bytes(byte[c] for c in t): i for t, i in stored["model"]["vocab"].items() if t not in special}
        self.a = tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.bytes_a = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, i in ranks.items():
            self.bytes_a[i] = token
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]
        self.width_a, self.width_b = (np.array([len(x) for x in side], np.int64) for side in (self.bytes_a, self.bytes_b))
        # id and sign: "," or "|" behind an id of A, "," or ";" behind one of B
        ids_a, ids_b = range(len(self.bytes_a)), range(len(self.bytes_b))
        self.fragments = pa.array([f"{i}{c}" for i in ids_a for c in ",|"] + [f"{i}{c}" for i in ids_b for c in ",;"])
        self.clear()

    def clear(self) -> None:
        self.numbers = _Numbers()
        self.size = np.zeros((0, 5), np.int64)
        self.begins, self.keys = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.mark_begins, self.marks = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _encoded(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
        """Ids of both sides for chunks one after the other, and the byte length of each chunk.

        None if the bytes of the tokens are not those of the chunks.
        """
        text = _LEAD + "".join(chunks)
        ids_a, ids_b = self.a.encode_ordinary(text), self.b.encode(text[1:])
        raw = text.encode()
        if not b"".join(map(self.bytes_a.__getitem__, ids_a)) == b"".join(map(self.bytes_b.__getitem__, ids_b)) == raw:
            return None
        lengths = np.array([len(c) for c in chunks], np.int64)
        if len(raw) != len(text):
            lengths = np.array([len(c.encode()) for c in chunks], np.int64)
        return np.array(ids_a[1:], np.int64), np.array(ids_b[1:], np.int64), lengths

    def _learn(self, chunks: list[str]) -> None:
        """Align unseen chunks; some of them are encoded together, those that end with white space alone."""
        order = [i for i, c in enumerate(chunks) if not c[-1].isspace()]
        runs = [order[i : i + JOINED_CHUNKS] for i in range(0, len(order), JOINED_CHUNKS)]
        runs += [[i] for i, c in enumerate(chunks) if c[-1].isspace()]
        a, b, lengths, place = [], [], [], []
        bad: list[int] = []
        while runs:
            run = runs.pop()
            found = self._encoded([chunks[i] for i in run])
            if found is None:  # look for the chunks that are to blame
                half = len(run) // 2
                bad += run if not half else []
                runs += [run[:half], run[half:]] if half else []
                continue
            for held, part in zip((a, b, lengths, place), (*found, np.array(run, np.int64)), strict=True):
                held.append(part)
        none = [np.zeros(0, np.int64)]
        a, b, lengths, place = (np.concatenate(held or none) for held in (a, b, lengths, place))
        ends, end_a, end_b = np.cumsum(lengths), np.cumsum(self.width_a[a]), np.cumsum(self.width_b[b])
        common_ends = np.intersect1d(end_a, end_b, assume_unique=True)
        group_a, group_b = np.searchsorted(common_ends, end_a), np.searchsorted(common_ends, end_b)
        in_a, in_b = (np.bincount(g, minlength=len(common_ends)) for g in (group_a, group_b))
        last_a, last_b = np.cumsum(in_a), np.cumsum(in_b)
        # every token of A of a group beside every token of B of it
        beside = in_b[group_a]
        keys = np.repeat(a, beside) * len(self.bytes_b) + b[_gather((last_b - in_b)[group_a], beside)]
        at_a, at_b = np.arange(len(a)), np.arange(len(b))
        marks = np.zeros(len(a) + len(b), np.int64)
        marks[at_a + (last_b - in_b)[group_a]] = 2 * a + (at_a + 1 == last_a[group_a])
        marks[at_b + last_a[group_b]] = 2 * (b + len(self.bytes_a)) + (at_b + 1 == last_b[group_b])
        # sums up to the end of each chunk
        groups = np.searchsorted(common_ends, ends, side="right")
        links = np.concatenate(([0], np.cumsum(in_a * in_b)))[groups]
        upto = np.stack([np.concatenate(([0], last_a))[groups], np.concatenate(([0], last_b))[groups], groups, links], axis=1)
        size = np.zeros((len(chunks), 5), np.int64)
        size[place, :4] = np.diff(upto, axis=0, prepend=np.zeros((1, 4), np.int64))
        size[bad, 4] = 1
        begins, mark_begins = np.zeros(len(chunks), np.int64), np.zeros(len(chunks), np.int64)
        begins[place] = len(self.keys) + upto[:, 3] - size[place, 3]
        mark_begins[place] = len(self.marks) + upto[:, :2].sum(axis=1) - size[place, :2].sum(axis=1)
        for name, more in (("size", size), ("begins", begins), ("mark_begins", mark_begins), ("keys", keys), ("marks", marks)):
            setattr(self, name, np.concatenate([getattr(self, name), more]))

    def number(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of the chunks of all texts in a row, each with its blank in front, and how many each has.

        An empty text has none.
        """
        if len(self.numbers) > CACHE_CHUNKS:
            self.clear()
        cut = [chunks_of(f" {t}") if t else [] for t in texts]
        counts = np.array([len(c) for c in cut], np.int64)
        of = map(self.numbers.__getitem__, itertools.chain.from_iterable(cut))
        flat = np.fromiter(of, np.int64, int(counts.sum()))
        if self.numbers.waiting:
            self._learn(self.numbers.waiting)
            self.numbers.waiting = []
        return flat, counts

    def links(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pairs of all links of the chunks in a row, and how many each has."""
        lengths = self.size[numbers, 3]
        return self.keys[_gather(self.begins[numbers], lengths)], lengths

    def groups(self, numbers: np.ndarray, counts: np.ndarray) -> list[memoryview]:
        """``a1,a2|b1;a3|b2,b3`` of each run of ``counts`` chunks, as bytes."""
        lengths = self.size[numbers, :2].sum(axis=1)
        marks = self.marks[_gather(self.mark_begins[numbers], lengths)]
        if not len(marks):
            return [memoryview(b"")] * len(counts)
        shown = self.fragments.take(pa.array(marks))
        offsets = np.frombuffer(shown.buffers()[1], np.int32)[: len(marks) + 1]
        ends = offsets[np.cumsum(_sums(lengths, counts))].tolist()
        data = memoryview(shown.buffers()[2])
        return [data[begin : max(begin, end - 1)] for begin, end in zip([0, *ends], ends)]


@functools.cache
def aligner(path_a: str, path_b: str) -> Aligner:
    """One for each worker process, kept between its tasks."""
    return Aligner(path_a, path_b)


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums over runs of ``counts`` rows."""
    total = np.concatenate((np.zeros((1, *values.shape[1:]), np.int64), np.cumsum(values, axis=0)))
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]


def _pairs(path_a: str, path_b: str):
    """First pass: the pairs of a task and the number of its documents that hold each."""

    def merged(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        keys, place = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
        docs = np.zeros(len(keys), np.int64)
        np.add.at(docs, place, np.concatenate([d for _, d in held]))
        return keys, docs

    def rows(keys: np.ndarray, docs: np.ndarray) -> Iterator[pa.RecordBatch]:
        for i in range(0, len(keys), 1 << 16):
            part = [pa.array(keys[i : i + (1 << 16)]), pa.array(docs[i : i + (1 << 16)])]
            yield pa.RecordBatch.from_arrays(part, ["pair", "docs"])

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, held, size = aligner(path_a, path_b), [], 0
        for batch in common.slices(batches, "text", SLICE_BYTES):
            chunks, counts = one.number(common.texts_of(batch))
            doc = np.repeat(np.arange(len(counts)), counts)
            bad = np.zeros(len(counts), bool)
            bad[doc[one.size[chunks, 4] == 1]] = True
            # documents by chunk, each once, then by pair, each once
            doc, chunks = doc[~bad[doc]], chunks[~bad[doc]]
            doc, chunks = np.divmod(_distinct(doc * len(one.numbers) + chunks)[0], max(1, len(one.numbers)))
            keys, lengths = one.links(chunks)
            each, _ = _distinct(keys + (np.repeat(doc, lengths) << _HASH_BITS))
            keys, docs = _distinct(each & ((1 << _HASH_BITS) - 1))
            held.append((keys, docs))
            size += len(keys)
            if size > HELD_PAIRS:
                held = [merged(held)]
                size = len(held[0][0])
                if size > HELD_PAIRS // 2:
                    yield from rows(*held[0])
                    held, size = [], 0
        if held:
            yield from rows(*merged(held))

    return first


def _region(keys: np.ndarray, regions: int) -> np.ndarray:
    """The same as :func:`_region_column` gives."""
    mixed = (keys.astype(np.uint64) * np.uint64(_HASH)) & np.uint64((1 << _HASH_BITS) - 1)
    return ((mixed * np.uint64(regions)) >> np.uint64(_HASH_BITS)).astype(np.int64)


def _region_column(regions: int):
    mixed = (F.col("pair") * F.lit(_HASH)).bitwiseAND(F.lit((1 << _HASH_BITS) - 1))
    return F.shiftright(mixed * F.lit(regions), _HASH_BITS).alias("region")


def _built(group: pa.Table) -> pa.Table:
    """The perfect hash of a region and its keys in the order of their indices."""
    keys = group.column("pair").to_numpy()
    made = PerfectHash.build(keys)
    ordered = np.zeros(len(keys), np.uint32)
    ordered[made.index(keys)] = keys
    return pa.table(
        [[group.column("region")[0].as_py()], [len(keys)], [made.to_bytes()], [ordered.tobytes()]],
        ["region", "n", "hash", "pairs"],
    )


def _narrow(counts: np.ndarray) -> bytes:
    """Whole numbers in as few bytes as the largest takes."""
    return counts.astype(np.min_scalar_type(int(counts.max(initial=0)))).tobytes()


def _wide(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, f"u{len(data) // n}").astype(np.int64)


def _vectors(hashes):
    """Dense counts of a task for each region, by the index of its perfect hash."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {r: PerfectHash.from_bytes(h) for r, h in hashes.value.items()}
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            region, keys, docs = (batch.column(i).to_numpy() for i in range(3))
            order = np.argsort(region, kind="stable")
            region, keys, docs = region[order], keys[order], docs[order]
            for r in np.unique(region).tolist():
                i, j = np.searchsorted(region, [r, r + 1])
                if r not in found:
                    found[r] = np.zeros(len(known[r]), np.int64)
                np.add.at(found[r], known[r].index(keys[i:j]), docs[i:j])
        branch = TaskContext.get().partitionId()
        for r, counts in found.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([r]), pa.array([branch]), pa.array([len(counts)]), pa.array([_narrow(counts)])],
                ["region", "branch", "n", "counts"],
            )

    return add


_VECTOR = "region bigint, branch bigint, n bigint, counts binary"


def _added(group: pa.Table) -> pa.Table:
    n = group.column("n")[0].as_py()
    total = np.zeros(n, np.int64)
    for data in group.column("counts").to_pylist():
        total += _wide(data, n)
    first = group.slice(0, 1)
    return pa.table(
        [first.column("region"), first.column("branch"), first.column("n"), [_narrow(total)]], ["region", "branch", "n", "counts"]
    )


def _tree_sum(vectors: DataFrame, branches: int) -> DataFrame:
    """One vector for each region: ``FAN_IN`` branches become one until one is left."""
    while branches > 1:
        vectors = vectors.withColumn("branch", F.call_function("div", F.col("branch"), F.lit(FAN_IN)))
        vectors = vectors.groupBy("region", "branch").applyInArrow(_added, _VECTOR)
        branches = -(-branches // FAN_IN)
    return vectors


def _rounds(sizes: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """First and last region of each round, with at most ``ROUND_KEYS`` keys unless a region alone has more."""
    out: list[list[int]] = []
    held = 0
    for region, n in sizes:
        if out and held + n <= ROUND_KEYS:
            out[-1][1] = region
            held += n
        else:
            out.append([region, region])
            held = n
    return [(a, b) for a, b in out]


def pair_vectors(docs: DataFrame, path_a: str, path_b: str) -> tuple[DataFrame, list[tuple[int, int]], int]:
    """``region, n, hash, pairs, counts`` of all distinct linked pairs, the rounds, and the number of regions."""
    spark = docs.sparkSession
    seen = common.stage(docs.select("text").mapInArrow(_pairs(path_a, path_b), "pair bigint, docs bigint"), "pairs")
    distinct = common.stage(seen.select("pair").distinct(), "distinct-pairs")
    total = distinct.count()
    regions = max(1, -(-total // REGION_KEYS))
    built = distinct.withColumn("region", _region_column(regions)).groupBy("region").applyInArrow(
        _built, "region bigint, n bigint, hash binary, pairs binary"
    )
    built = common.stage(built, "perfect-hashes")
    rounds = _rounds([tuple(r) for r in built.select("region", "n").orderBy("region").collect()])
    counted = []
    for low, high in rounds:
        here = F.col("region").between(low, high)
        hashes = {r.region: bytes(r.hash) for r in built.filter(here).select("region", "hash").collect()}
        rows = seen.select(_region_column(regions), "pair", "docs").filter(here)
        # a task's vector is worth its size when the task has that many rows
        tasks = max(common.shuffle_partitions(spark), -(-seen.count() // max(1, total)))
        branches = min(tasks, rows.rdd.getNumPartitions())
        vectors = rows.coalesce(branches).mapInArrow(_vectors(spark.sparkContext.broadcast(hashes)), _VECTOR)
        counted.append(common.stage(_tree_sum(vectors, branches), "pair-counts").select("region", "counts"))
    if not counted:
        return built.withColumn("counts", F.lit(b"")), [], regions
    all_counts = functools.reduce(DataFrame.unionByName, counted)
    return common.stage(built.join(all_counts, "region"), "pair-vectors"), rounds, regions


def _pair_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for n, pairs, counts in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            columns = [pa.array(np.frombuffer(pairs, np.uint32).astype(np.int64)), pa.array(_wide(counts, n))]
            yield pa.RecordBatch.from_arrays(columns, ["pair", "documents"])


def _flat_pairs(vectors: DataFrame) -> DataFrame:
    return vectors.select("n", "pairs", "counts").mapInArrow(_pair_rows, "pair bigint, documents bigint")


def _id_of_a(path_b: str):
    return F.call_function("div", F.col("pair"), F.lit(_pieces(path_b)))


@functools.cache
def _pieces(path_b: str) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()


def pair_counts(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """``id_a, id_b, documents`` for every pair of ids that some document holds linked.

    ``docs`` has a ``text``; see :func:`align` for which texts have tokens.
    """
    path_a, path_b = path_a or public_tokenizers.path(BYTE_BPE), path_b or public_tokenizers.path(PIECE_BPE)
    texts = docs.select(F.coalesce(F.col("text"), F.lit("")).alias("text"))
    pairs = _flat_pairs(pair_vectors(texts, path_a, path_b)[0])
    return pairs.select(_id_of_a(path_b).alias("id_a"), (F.col("pair") % _pieces(path_b)).alias("id_b"), "documents")


class _Lookup:
    """Counts of the pairs of one round; a pair of another round has the count zero."""

    def __init__(self, regions: int, rows: list[tuple[int, int, bytes, bytes, bytes]]) -> None:
        self.regions = regions
        self.known = {
            region: (PerfectHash.from_bytes(made), np.frombuffer(pairs, np.uint32), np.frombuffer(counts, f"u{len(counts) // n}"))
            for region, n, made, pairs, counts in rows
        }

    def counts(self, keys: np.ndarray) -> np.ndarray:
        out = np.zeros(len(keys), np.int64)
        region = _region(keys, self.regions)
        order = np.argsort(region, kind="stable")
        for r, part in zip(*_runs(region[order]), strict=True):
            at = order[part]
            if r in self.known and len(at):
                made, pairs, counts = self.known[r]
                index = made.index(keys[at])
                sure = (index >= 0) & (pairs[index] == keys[at])
                out[at[sure]] = counts[index[sure]]
        return out


def _runs(values: np.ndarray) -> tuple[list[int], list[slice]]:
    names, begins = np.unique(values, return_index=True)
    ends = [*begins[1:].tolist(), len(values)][: len(names)]
    return names.tolist(), [slice(i, j) for i, j in zip(begins.tolist(), ends, strict=True)]


_RESULT = {
    "n_a": "bigint", "n_b": "bigint", "n_groups": "bigint", "n_links": "bigint", "n_best": "bigint", "count_sum": "bigint",
    "groups_sha256": "string",
}


def _looked_up(path_a: str, path_b: str, lookup, best, with_groups: bool):
    """Second pass: adds what the pairs of this round contribute to each document."""
    names = ["doc_id", "text", *_RESULT, *(["groups"] if with_groups else [])]

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = aligner(path_a, path_b)
        table = _Lookup(*lookup.value)
        most, width = best.value, len(one.bytes_b)
        for batch in common.slices(batches, "text", SLICE_BYTES):
            chunks, counts = one.number(common.texts_of(batch))
            used, local = np.unique(chunks, return_inverse=True)
            keys, lengths = one.links(used)
            found = table.counts(keys)
            top = (found > 0) & (found == most[keys // width])
            per_chunk = _sums(np.stack([top, found], axis=1), lengths)
            sizes, looked = _sums(one.size[chunks], counts), _sums(per_chunk[local], counts)
            good = (sizes[:, 4] == 0) & (counts > 0)
            groups = [g if ok else b"" for g, ok in zip(one.groups(chunks, counts), good.tolist(), strict=True)]
            before = [batch.column(batch.schema.names.index(c)).to_numpy() for c in ("n_best", "count_sum")]
            columns = [
                batch.column(0), batch.column(1), *[pa.array(sizes[:, i] * good) for i in range(4)],
                *[pa.array(before[i] + looked[:, i] * good) for i in range(2)],
                pa.array([hashlib.sha256(g).hexdigest() if len(g) else "" for g in groups], pa.string()),
            ]
            if with_groups:
                columns.append(pa.array([str(g, "ascii") for g in groups], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = "doc_id bigint, text string, " + ", ".join(f"{n} {t}" for n, t in _RESULT.items())
    return second, schema + (", groups string" if with_groups else "")


def align(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, with_groups: bool = False) -> DataFrame:
    """One row for each document: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``.

    A text is encoded with a blank in front; strings of special tokens are plain text. Null and empty texts, and those whose
    bytes are not those of the tokens of both sides, have no tokens: zeros and ''. Repeated rows return and count
    each, ids may be null, other columns are ignored, a table without rows gives none. ``with_groups`` adds
    ``groups``, the groups themselves as ``a1,a2|b1;a3|b2,b3``.
    """
    path_a, path_b = path_a or public_tokenizers.path(BYTE_BPE), path_b or public_tokenizers.path(PIECE_BPE)
    spark, rows = docs.sparkSession, common.id_text(docs)
    vectors, rounds, regions = pair_vectors(rows, path_a, path_b)
    # at most one row for each id of the vocabulary of A
    tops = _flat_pairs(vectors).groupBy(_id_of_a(path_b).alias("id_a")).agg(F.max("documents").alias("most")).collect()
    most = np.zeros(max((r.id_a for r in tops), default=0) + 1, np.int64)
    for r in tops:
        most[r.id_a] = r.most
    best = spark.sparkContext.broadcast(most)
    zero = F.lit(0).cast("bigint")
    out = rows.select("*", *[(zero if t == "bigint" else F.lit("")).alias(n) for n, t in _RESULT.items()])
    for i, (low, high) in enumerate(rounds or [(0, 0)]):
        taken = vectors.filter(F.col("region").between(low, high)).select("region", "n", "hash", "pairs", "counts").collect()
        lookup = spark.sparkContext.broadcast((regions, [tuple(r) for r in taken]))
        second, schema = _looked_up(path_a, path_b, lookup, best, with_groups)
        out = (common.stage(out, "rounds") if i else out).mapInArrow(second, schema)
    return out.drop("text")
