"""SimHash near-duplicates by an inverted index of byte positions with count filtering.

A fingerprint is eight bytes, so two fingerprints that differ in at most three bits agree in at
least five byte positions. One list for each (position, byte) would hold 1/256 of all
fingerprints; the index therefore keeps a list for each choice of five positions and their bytes. A pair
that shares m positions meets in C(m, 5) of the 56 lists of each side, so meeting once proves the count, and a
list has at most 2^24 different members however many documents there are. In a list the shared
positional bytes of a pair are tallied, pairs with five or more are kept, and their differing bits
are counted. Links of a short list are given out one by one, a long list gives only a spanning
forest, which keeps every component and never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.llm import common
from tillstream.llm.components import components

SEED = 42
SHINGLE = 3
MAX_BITS = 3
POSITIONS = 8
MATCHES = POSITIONS - MAX_BITS

#: Lists up to this length compare neighbours at each distance, longer ones search a forest.
SHORT_LIST = 64
#: Forest search compares with all unvisited members up to this length, beyond it by flipping bits.
LONG_LIST = 20_000


def _masks() -> np.ndarray:
    """The bytes each list looks at, as 64-bit masks."""
    return np.array(
        [sum(0xFF << (8 * p) for p in chosen) for chosen in combinations(range(POSITIONS), MATCHES)], np.uint64
    )


def fingerprint(text: str) -> int:
    """Bit i is set when it is set in more than half of the shingle hashes, repeats included."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    n = max(1, len(words) - SHINGLE + 1)
    begins = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
    stops = ends[-n:].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(line[a:b], SEED) for a, b in zip(begins, stops, strict=True)], "<u8")
    counts = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        part = hashes[at : at + (1 << 16)]
        bits = np.unpackbits(part.view(np.uint8).reshape(len(part), 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int32)
    return int((1 << np.flatnonzero(2 * counts > n).astype(object)).sum()) if n else 0


def _fingerprint_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    common.let_go()
    for batch in batches:
        prints = np.array([fingerprint(t) for t in common.texts_of(batch)], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(i) for i, c in enumerate(batch.schema.names) if c != "text"], pa.array(prints)],
            [*[c for c in batch.schema.names if c != "text"], "print"],
        )


def fingerprints(docs: DataFrame) -> DataFrame:
    """``docs(id columns, text)`` with the text replaced by its 64-bit ``print``."""
    kept = [f for f in docs.schema.fields if f.name != "text"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", print bigint"
    return docs.mapInArrow(_fingerprint_batches, schema)


def _linked(x: np.ndarray) -> np.ndarray:
    """Do fingerprints with this difference link? First the tally of equal bytes, then the bits."""
    equal = (x.view(np.uint8).reshape(*x.shape, POSITIONS) == 0).sum(axis=-1)
    return (equal >= MATCHES) & (np.bitwise_count(x) <= MAX_BITS)


def _by_distance(keys: np.ndarray, prints: np.ndarray, longest: int) -> list[np.ndarray]:
    """Links of sorted runs of equal keys, comparing members that are 1, 2, ... places apart."""
    found = []
    for d in range(1, longest):
        at = np.flatnonzero(keys[d:] == keys[:-d])
        if not len(at):
            break
        at = at[_linked(prints[at] ^ prints[at + d])]
        found.append(np.stack([prints[at], prints[at + d]], axis=1))
    return found


def forest(prints: np.ndarray) -> np.ndarray:
    """Links that span the components of one list of distinct fingerprints."""
    rest, found = np.sort(prints), []
    if len(rest) > LONG_LIST:
        return _forest_by_flips(rest)
    while len(rest):
        front, rest = [rest[0]], rest[1:]
        while front and len(rest):
            one = front.pop()
            near = _linked(rest ^ one)
            if near.any():
                new = rest[near]
                found.append(np.stack([np.full(len(new), one), new], axis=1))
                front.extend(new)
                rest = rest[~near]
    return np.concatenate(found) if found else np.zeros((0, 2), np.uint64)


def _forest_by_flips(members: np.ndarray) -> np.ndarray:
    """The same for a very long list, in time linear in its length: at most 2,324 flips each,
    for the members agree in 40 bits (or few more where two lists share a hash)."""
    vary = int(np.bitwise_or.reduce(members ^ members[0]))
    bits = [np.uint64(1 << b) for b in range(64) if vary >> b & 1]
    flips = [
        np.bitwise_xor.reduce(np.array(some, np.uint64)) for n in range(1, MAX_BITS + 1) for some in combinations(bits, n)
    ]
    free, found = np.ones(len(members), bool), []
    while free.any():
        front = np.array([np.argmax(free)])
        free[front] = False
        while len(front):
            nexts = []
            for flip in flips:
                want = members[front] ^ flip
                at = np.minimum(np.searchsorted(members, want), len(members) - 1)
                hit = (members[at] == want) & free[at]
                if hit.any():
                    new, first = np.unique(at[hit], return_index=True)
                    free[new] = False
                    found.append(np.stack([members[front[hit][first]], members[new]], axis=1))
                    nexts.append(new)
            front = np.concatenate(nexts) if nexts else np.zeros(0, np.int64)
    return np.concatenate(found) if found else np.zeros((0, 2), np.uint64)


def _links_of_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links from (list key, print) rows sorted by both; an unfinished list waits for the next batch."""
    keys, prints = np.zeros(0, np.int64), np.zeros(0, np.uint64)

    def links(keys: np.ndarray, prints: np.ndarray) -> Iterator[pa.RecordBatch]:
        begins = np.flatnonzero(np.diff(keys, prepend=keys[0] ^ 1))
        lengths = np.diff(begins, append=len(keys))
        long = lengths > SHORT_LIST
        found = [forest(prints[b : b + n]) for b, n in zip(begins[long], lengths[long], strict=True)]
        some = np.repeat((lengths > 1) & ~long, lengths)
        if some.any():
            found += _by_distance(keys[some], prints[some], int(lengths[~long].max()))
        pairs = np.concatenate(found).view(np.int64) if found else np.zeros((0, 2), np.int64)
        for at in range(0, len(pairs), 1 << 16):
            part = pairs[at : at + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part[:, 0]), pa.array(part[:, 1])], ["a", "b"])

    for batch in batches:
        keys = np.concatenate([keys, batch.column(0).to_numpy(zero_copy_only=False)])
        prints = np.concatenate([prints, batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)])
        last = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0
        if last:
            yield from links(keys[:last], prints[:last])
            keys, prints = keys[last:], prints[last:]
    if len(keys):
        yield from links(keys, prints)


def links(prints: DataFrame) -> DataFrame:
    """Distinct links ``a, b`` between the distinct values of ``prints.print`` that span all components."""
    lists = F.array(
        *[
            F.xxhash64(F.lit(i), F.col("print").bitwiseAND(F.lit(int(m))))
            for i, m in enumerate(_masks().view(np.int64))
        ]
    )
    postings = prints.select(F.explode(lists).alias("list"), "print")
    n = common.shuffle_partitions(prints.sparkSession)
    return (
        postings.repartition(n, "list")
        .sortWithinPartitions("list", "print")
        .mapInArrow(_links_of_lists, "a bigint, b bigint")
        .distinct()
    )


def _roots(marked: DataFrame, id_col: str) -> tuple[DataFrame, DataFrame]:
    """``print, least`` of the distinct prints, and ``node, root`` of those that have links."""
    distinct = common.stage(marked.groupBy("print").agg(F.min(id_col).alias("least")), "prints")
    return distinct, components(links(distinct))


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document: ``doc_id, fingerprint, component_id``.

    ``fingerprint`` is written as 16 hex digits. Texts are lower-cased in A-Z only; a null or empty
    text has fingerprint zero and links like any other. Repeated rows are returned as often as they
    come; ``component_id`` is the smallest id reachable, null if no reachable row has one.
    """
    marked = common.stage(fingerprints(common.id_text(docs, id_col, text_col)), "simhash")
    distinct, roots = _roots(marked, "doc_id")
    rooted = distinct.join(roots, distinct["print"] == roots.node, "left").select(
        "print", F.coalesce("root", "print").alias("root"), "least"
    )
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    component = rooted.join(least, "root").select(F.col("print").alias("of"), "component_id")
    return marked.join(component, marked["print"] == component["of"]).select(
        "doc_id",
        F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"),
        "component_id",
    )


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each component stays, with all its columns: the one with the smallest id;
    null ids come last, and of repeated rows with that id one stays."""
    rows = common.numbered(docs, "simhash-docs")
    marked = common.stage(
        fingerprints(
            rows.select(
                "row",
                F.col(f"doc.`{id_col}`").cast("bigint").alias("doc_id"),
                F.coalesce(F.col(f"doc.`{text_col}`"), F.lit("")).alias("text"),
            )
        ),
        "simhash",
    )
    distinct = common.stage(
        marked.groupBy("print").agg(
            F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("least")
        ),
        "prints",
    )
    roots = components(links(distinct))
    kept = (
        distinct.join(roots, distinct["print"] == roots.node, "left")
        .groupBy(F.coalesce("root", "print").alias("root"))
        .agg(F.min("least").alias("least"))
        .select(F.col("least.row").alias("row"))
    )
    # Only numbers are shuffled to find what goes; whole rows move only where these are too many to broadcast.
    gone = common.stage(marked.select("row").join(kept, "row", "left_anti"), "simhash-gone")
    return rows.join(gone, "row", "left_anti").select("doc.*")
