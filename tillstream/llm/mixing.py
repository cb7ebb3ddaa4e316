"""Probabilities of whole texts by online logistic context mixing.

Each byte of a text, and the end mark behind it, is predicted by binary decisions: the byte before it names a binary
tree over all bytes, a Huffman tree of the training text, so likely bytes take few decisions. For each order (how
many bytes before it count, over word boundaries) a hashed context and the place in the tree choose a slot with counts of
zeros and ones; so does the word before together with the letters of the current word. The prediction of a slot is its
log-odds. A set of weights, chosen by a gate, mixes the predictions in the logistic domain, and an adaptive table refines
the mixed probability. Slots are counted over all bytes of all training text; weights are learned
online over the same, each event against counts that leave it out, by every task for itself, and averaged.

Counts are exact until they are summed; then each pair is kept as a state of 12 bits, exact up to 7 and within a ninth above.
The probabilities of all texts add up to one.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tillstream.llm import common

#: Slots of each order from one byte on, and of the word before with the word so far, as powers of two. Their number is
#: fixed, so what is broadcast is too.
SLOT_BITS = (16, 18, 20, 21, 21, 21)
ORDERS = len(SLOT_BITS)
CONTEXT = ORDERS - 1
SLOTS = sum(1 << b for b in SLOT_BITS)
_FIRST = [sum(1 << b for b in SLOT_BITS[:i]) for i in range(ORDERS)]

#: Slots sent and summed together.
REGION = 1 << 14

#: Text read at a time.
BLOCK_BYTES = 1 << 17

END = 255  # a byte that UTF-8 does not use
SPACES = np.isin(np.arange(256), [*b" \t\n\x0b\x0c\r", END])
LEAST = 0.02  # added to both counts of a slot
LEVELS = 4  # how much the longest known context was seen, for the gate
DEPTHS = 8  # of a decision in its tree, for the gate
GATES = (ORDERS * LEVELS + 1) * DEPTHS
CHUNK = 1 << 13  # bytes worked on at a time
BUCKETS = 24  # of the refining table, over the range of log-odds
RANGE = 12.0

_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))
_BASE = 0x5851F42D4C957F2D  # of the hashes of words; odd, so it has an inverse


def tokens_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct tokens in lower case, all tokens in a row as numbers of these (the empty one, which ends
    a text, included), and how many each text has."""
    chunks, counts = common.chunks_of(pc.ascii_lower(texts.fill_null("")))
    names, of = chunks.dictionary, chunks.indices.to_numpy()
    empty = pc.index(names, "").as_py()
    if empty < 0:
        empty, names = len(names), pa.concat_arrays([names, pa.array([""], names.type)])
    there = of != empty
    words = np.diff(np.concatenate(([0], np.cumsum(there)))[np.concatenate(([0], np.cumsum(counts)))])
    return names, np.insert(of[there], np.cumsum(words), empty).astype(np.int32), words + 1


def spelled(names: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of texts, each with ``CONTEXT`` end marks before it and one behind, and where each ends."""
    gap, mark = bytes([END]) * CONTEXT, bytes([END])
    found = names.cast(pa.binary()).to_pylist()
    data = np.frombuffer(b"".join([gap + t + mark for t in found]), np.uint8)
    return data, np.cumsum([len(t) + CONTEXT + 1 for t in found])


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def _words_at(data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each byte: a hash of the word before and the letters of its own word before it; and a hash
    of its own word up to and with it. Upper case letters count in the first as lower case ones."""
    n, space = len(data), SPACES[data]
    at = np.arange(n)
    start = np.zeros(n, np.int64)  # of the word a byte belongs to; a space ends its word
    start[1:] = np.maximum.accumulate(np.where(space, at + 1, 0))[:-1]
    power, back = _powers(_BASE, n), _powers(pow(_BASE, -1, 1 << 64), n)

    def upto(values: np.ndarray) -> np.ndarray:
        return np.concatenate((np.zeros(1, np.uint64), np.cumsum((values.astype(np.uint64) + np.uint64(1)) * power)))

    own = upto(data)
    exact = (own[1:] - own[start]) * back[start]
    low = upto(np.where((data >= 65) & (data <= 90), data | 32, data))
    prefix = (low[:-1] - low[start]) * back[start]
    # the last word that ended before, or none since the text began
    event = space & (at > start)
    value = np.where(event, prefix, np.uint64(0))
    event[begins] = True
    value[begins] = 0
    last = np.zeros(n, np.int64)
    last[1:] = np.maximum.accumulate(np.where(event, at, 0))[:-1]
    before = (value[last] ^ (value[last] >> np.uint64(29))) * _MIX[1]
    return before + (prefix ^ (prefix >> np.uint64(31))) * _MIX[0], exact


@dataclass(frozen=True)
class Bytes:
    """The bytes of some texts with the end mark of each."""

    keys: np.ndarray  # the byte and the bytes before it in one integer
    words: np.ndarray  # a hash of the word before and the word so far
    exact: np.ndarray  # a hash of the own word up to and with the byte
    sizes: np.ndarray  # number of bytes of each text with its end mark

    def distinct(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The different pairs of key and word context, how often each occurs, and the pair of each byte."""
        both = (self.keys ^ (self.words >> np.uint64(17))) * _MIX[0] + self.words
        _, first, place, times = np.unique(both, return_index=True, return_inverse=True, return_counts=True)
        return self.keys[first], self.words[first], times, place


def bytes_of(texts: pa.Array) -> Bytes:
    data, ends = spelled(texts)
    keys = np.zeros(len(data), np.uint64)
    for back in range(CONTEXT + 1):
        keys[back:] |= data[: len(data) - back].astype(np.uint64) << np.uint64(8 * back)
    begins = np.concatenate(([0], ends[:-1])).astype(np.int64)
    words, exact = _words_at(data, begins)
    there = np.ones(len(data), bool)
    there[(begins[:, None] + np.arange(CONTEXT)).ravel()] = False
    return Bytes(keys[there], words[there], exact[there], ends - begins - CONTEXT)


def distinct(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different contexts with their byte, and how often each occurs."""
    return bytes_of(texts.fill_null("")).distinct()[:3]


@dataclass(frozen=True)
class Trees:
    """A binary tree over all bytes for each byte before. The decisions of a pair of bytes stand in a row."""

    first: np.ndarray  # of the decisions of each pair (byte before, byte)
    sizes: np.ndarray  # how many they are
    packed: np.ndarray  # of each decision, see ``_packed``

    def decisions(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For all decisions of the bytes in a row: the number of the byte, the place in the tree, and a mark: the
        depth (at most DEPTHS - 1) and, in the lowest bit, the way taken."""
        pair = (keys & np.uint64(0xFFFF)).astype(np.int64)
        sizes = self.sizes[pair]
        ends = np.cumsum(sizes)
        of = np.repeat(np.arange(len(pair)), sizes)
        at = (self.first[pair] - ends + sizes)[of]
        at += np.arange(len(at))
        packed = self.packed.take(at)
        return of, packed >> np.uint32(4), (packed & np.uint32(15)).astype(np.uint8)


def _tree(weights: np.ndarray) -> list[list[tuple[int, int]]]:
    """The decisions (node, way) that lead to each leaf of a Huffman tree."""
    paths: list[list[tuple[int, int]]] = [[] for _ in weights]
    heap = [(w, i, [i]) for i, w in enumerate(weights.tolist())]
    heapq.heapify(heap)
    for node in range(len(weights) - 1):
        one, two = heapq.heappop(heap), heapq.heappop(heap)
        for way, side in enumerate((one, two)):
            for leaf in side[2]:
                paths[leaf].append((node, way))
        heapq.heappush(heap, (one[0] + two[0], len(weights) + node, one[2] + two[2]))
    return [p[::-1] for p in paths]


def _packed(before: int, path: list[tuple[int, int]]) -> list[int]:
    """The decisions of a path, each as one number: the depth and the way, the byte before, the node, and where three
    levels at a time begin with the place below (0 to 6, from the top down)."""
    out, top, below = [], 0, 0
    for d, (node, way) in enumerate(path):
        if d % 3 == 0:
            top, below = node, 0
        place = below << 24 | top << 16 | before << 8 | node
        out.append(place << 4 | min(d, DEPTHS - 1) << 1 | way)
        below = 2 * below + 1 + way
    return out


def trees(pairs: np.ndarray) -> Trees:
    """Trees of counts of (byte before, byte). Every byte has a leaf, whether it was seen or not."""
    pairs = pairs.reshape(256, 256).astype(float)
    usual = pairs.sum(axis=0) + 1.0
    usual = usual / usual.sum() + 1e-5
    sizes, packed = [], []
    for before in range(256):
        total = pairs[before].sum()
        for path in _tree((pairs[before] + 2.0 * usual) / (total + 2.0)):
            sizes.append(len(path))
            packed += _packed(before, path)
    # a key has the byte lowest and the byte before above it, as pairs have
    sizes = np.array(sizes, np.int64)
    return Trees(np.cumsum(sizes) - sizes, sizes, np.array(packed, np.uint32))


def _paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each byte follows each other in this task's training text."""
    pairs = np.zeros(1 << 16, np.int64)
    for batch in common.slices(batches, "text", BLOCK_BYTES):
        data, ends = spelled(batch.column(0).fill_null(""))
        there = np.ones(len(data) - 1, bool)  # bytes with one before them in their text, or its first mark
        begins = np.concatenate(([0], ends[:-1])).astype(np.int64)
        there[(begins[:, None] + np.arange(-1, CONTEXT - 1)).ravel()[1:]] = False
        pair = (data[:-1].astype(np.int64) << 8) | data[1:]
        pairs += np.bincount(pair[there], minlength=1 << 16)
    yield pa.RecordBatch.from_arrays([pa.array([pairs.astype("<f8").tobytes()])], ["learned"])


def _contexts(keys: np.ndarray, words: np.ndarray) -> list[np.ndarray]:
    """A hash for each order from two bytes on, that of the words last."""
    out = []
    for order in range(2, CONTEXT + 1):
        h = (((keys >> np.uint64(8)) & np.uint64((1 << 8 * order) - 1)) + np.uint64(order)) * _MIX[0]
        out.append((((h ^ (h >> np.uint64(31))) * _MIX[1]) >> np.uint64(32)).astype(np.uint32))
    out.append(((words * _MIX[1]) >> np.uint64(32)).astype(np.uint32))
    return out


def _slots(contexts: list[np.ndarray], of: np.ndarray, places: np.ndarray) -> Iterator[np.ndarray]:
    """For each order the slot of every decision, among those of the order. The byte before and the node are the first;
    in the others the decisions of three levels share a block of eight, so that they lie in one line of memory."""
    yield (places & np.uint32(0xFFFF)).astype(np.int64)
    below = places >> np.uint32(24)
    moved = ((places >> np.uint32(8)) & np.uint32(0xFFFF)) * np.uint32(0x9E3779B1)
    for bits, context in zip(SLOT_BITS[1:], contexts, strict=True):
        block = (context.take(of) + moved) >> np.uint32(35 - bits)
        yield (block << np.uint32(3) | below).astype(np.int64)


def _counted(trees_of):
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Counts of this task's training text, by region."""
        table, tree = np.zeros((SLOTS, 2), np.uint32), trees_of()
        parts = [table[f : f + (1 << b)].reshape(-1) for f, b in zip(_FIRST, SLOT_BITS, strict=True)]
        for batch in common.slices(batches, "text", BLOCK_BYTES):
            data = bytes_of(batch.column(0).fill_null(""))
            for at in range(0, len(data.keys), CHUNK):
                keys = data.keys[at : at + CHUNK]
                of, places, marks = tree.decisions(keys)
                way = marks & 1
                for part, slot in zip(parts, _slots(_contexts(keys, data.words[at : at + CHUNK]), of, places), strict=True):
                    slot += slot
                    slot += way
                    np.add.at(part, slot, np.uint32(1))
        for region, at in enumerate(range(0, SLOTS, REGION)):
            part = table[at : at + REGION]
            if part.any():
                packed = pa.compress(np.ascontiguousarray(part.T), "zstd", asbytes=True)
                yield pa.RecordBatch.from_arrays([pa.array([region], pa.int32()), pa.array([packed])], ["region", "counts"])

    return counted


def _region_rows(region: int) -> int:
    return min(REGION, SLOTS - region * REGION)


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each region of this partition: the sums as floats, which keep large and rare counts alike."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for region, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            n = _region_rows(region)
            part = np.frombuffer(pa.decompress(packed, 8 * n, "zstd"), np.uint32).reshape(2, n)
            sums[region] = sums.get(region, 0) + part.astype(np.uint64)
    for region, total in sums.items():
        packed = total.astype("<f4").tobytes()
        yield pa.RecordBatch.from_arrays([pa.array([region], pa.int32()), pa.array([packed])], ["region", "counts"])


def _stated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The states of summed regions."""
    for batch in batches:
        made = [_states(np.frombuffer(c, "<f4").reshape(2, -1)).astype("<u2").tobytes() for c in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], ["region", "counts"])


def count(texts: DataFrame, tree) -> np.ndarray:
    """The state of each slot over all ``texts.text``. What is collected has a fixed size."""
    n = common.shuffle_partitions(texts.sparkSession)
    sums = (
        texts.select("text")
        .mapInArrow(_counted(lambda: tree.value), "region int, counts binary")
        .repartition(n, "region")
        .mapInArrow(_summed, "region int, counts binary")
        .mapInArrow(_stated, "region int, counts binary")
    )
    with common.small_batches(texts.sparkSession):
        rows = sums.collect()
    states = np.zeros(SLOTS, np.uint16)
    for r in rows:
        size, at = _region_rows(r.region), r.region * REGION
        states[at : at + size] = np.frombuffer(r.counts, "<u2")
    return states


#: Counts that a state tells apart: all to 7, then in equal ratios.
_STEPS = np.concatenate((np.arange(8), np.geomspace(8, 1 << 20, 56)))


def _states(both: np.ndarray) -> np.ndarray:
    """Zeros and ones as one number; where one is above a million both shrink alike, and none to nothing."""
    shrink = np.maximum(both.max(axis=0) / _STEPS[-1], 1)
    level = np.searchsorted((_STEPS[1:] + _STEPS[:-1]) / 2, np.where(both > 0, np.maximum(both / shrink, 1), 0))
    return (level[0] << 6 | level[1]).astype(np.uint16)


def _meanings() -> tuple[np.ndarray, np.ndarray]:
    """Log-odds of each state, and what it says for the gate (0: never seen): as it is, and without a zero or a one."""
    zeros, ones = np.repeat(_STEPS, 64), np.tile(_STEPS, 64)
    cases = [(zeros, ones), (zeros - (zeros > 0), ones), (zeros, ones - (ones > 0))]
    odds = [np.log((o + LEAST) / (z + LEAST)) for z, o in cases]
    seen = [(n > 0).astype(np.uint8) + (n > 1) + (n > 4) + (n > 20) for n in (z + o for z, o in cases)]
    return np.concatenate(odds).astype(np.float32), np.concatenate(seen).astype(np.uint8)


_ODDS, _SEEN = _meanings()
#: Log-odds of a state and, as the other part, what it says for the gate, by order.
_MEANING = [(_ODDS + 1j * np.where(_SEEN > 0, _SEEN + o * LEVELS, 0)).astype(np.complex64) for o in range(ORDERS)]


def _inputs(states: np.ndarray, contexts, of: np.ndarray, places: np.ndarray, marks: np.ndarray, leave_out: bool):
    """Log-odds of each order (and a constant), and the gate. ``leave_out``: the way itself does not count."""
    x = np.empty((len(of), ORDERS + 1), np.float32)
    gate = np.zeros(len(of), np.float32)
    own = ((marks & 1).astype(np.int64) + 1) << 12 if leave_out else None
    for order, slot in enumerate(_slots(contexts, of, places)):
        first = _FIRST[order]
        state = states[first : first + (1 << SLOT_BITS[order])].take(slot).astype(np.int64)
        if leave_out:
            state += own
        found = _MEANING[order].take(state)
        x[:, order] = found.real
        np.maximum(gate, found.imag, out=gate)
    x[:, ORDERS] = 0.3
    return x, gate.astype(np.int64) * DEPTHS + (marks >> 1)


def _mixed(weights: np.ndarray, gate: np.ndarray, x: np.ndarray) -> np.ndarray:
    return np.clip(np.einsum("ij,ij->i", weights.take(gate, axis=0), x), -RANGE, RANGE)


@dataclass(frozen=True)
class Model:
    trees: Trees
    states: np.ndarray  # of the slots
    weights: np.ndarray  # by gate and input
    refined: np.ndarray  # log-odds by gate and bucket of the mixed log-odds

    def costs(self, keys: np.ndarray, words: np.ndarray | None = None) -> np.ndarray:
        """log10 probability of each byte in its context; without ``words`` no word stands before."""
        words = np.zeros(len(keys), np.uint64) if words is None else words
        out = [np.zeros(0)]
        for at in range(0, len(keys), CHUNK):
            some = keys[at : at + CHUNK]
            of, places, marks = self.trees.decisions(some)
            x, gate = _inputs(self.states, _contexts(some, words[at : at + CHUNK]), of, places, marks, False)
            final = _refine(self.refined, _mixed(self.weights, gate, x), gate)
            against = np.where(marks & 1, -final, final)
            cost = np.log(1 + np.exp(-np.abs(against))) + np.maximum(against, 0)
            out.append(np.bincount(of, weights=cost, minlength=len(some)))
        return np.concatenate(out) / -np.log(10)


def _buckets(mixed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = (mixed + np.float32(RANGE)) * np.float32((BUCKETS - 1) / (2 * RANGE))
    low = np.minimum(at.astype(np.int64), BUCKETS - 2)
    return low, at - low.astype(np.float32)


def _refine(refined: np.ndarray, mixed: np.ndarray, gate: np.ndarray) -> np.ndarray:
    low, part = _buckets(mixed)
    low += gate * BUCKETS
    flat = refined.reshape(-1)
    one = flat.take(low)
    return np.float32(0.5) * (mixed + one + (flat.take(low + 1) - one) * part)


def start_weights() -> np.ndarray:
    return np.tile(np.array([0.1, 0.15, 0.2, 0.25, 0.3, 0.3, 0.0], np.float32), (GATES, 1))


def _learned(model_of):
    def learned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (tree, states), weights = model_of(), start_weights()
        power, events = np.full(weights.shape, 1e-2), np.zeros(GATES)
        hits = np.zeros(2 * GATES * BUCKETS)
        for batch in common.slices(batches, "text", BLOCK_BYTES):
            data = bytes_of(batch.column(0).fill_null(""))
            for at in range(0, len(data.keys), CHUNK):
                keys = data.keys[at : at + CHUNK]
                of, places, marks = tree.decisions(keys)
                x, gate = _inputs(states, _contexts(keys, data.words[at : at + CHUNK]), of, places, marks, True)
                mixed = _mixed(weights, gate, x)
                way = (marks & 1).astype(np.int64)
                low, part = _buckets(mixed)
                place = (way * GATES + gate) * BUCKETS + low + (part > 0.5)
                hits += np.bincount(place, minlength=len(hits))
                error = 1 / (1 + np.exp(-mixed)) - way.astype(np.float32)
                grown = np.bincount(gate, minlength=GATES)
                x *= error[:, None]
                slope = np.stack([np.bincount(gate, weights=x[:, i], minlength=GATES) for i in range(ORDERS + 1)], axis=1)
                slope /= np.maximum(grown, 1.0)[:, None]
                power += slope * slope
                weights -= (0.05 * slope / np.sqrt(power)).astype(np.float32)
                events += grown
        packed = np.concatenate([(weights * events[:, None]).ravel(), events, hits]).astype("<f8").tobytes()
        yield pa.RecordBatch.from_arrays([pa.array([packed])], ["learned"])

    return learned


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        for packed in batch.column(0).to_pylist():
            one = np.frombuffer(packed, "<f8")
            total = one if total is None else total + one
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()])], ["learned"])


def _gathered(texts: DataFrame, of, size: int) -> np.ndarray:
    """The sum of what every task makes of its texts; it has one fixed size, and a few tasks add it up before it is
    collected."""
    spark = texts.sparkSession
    added = (
        texts.select("text")
        .mapInArrow(of, "learned binary")
        .coalesce(common.shuffle_partitions(spark))
        .mapInArrow(_added, "learned binary")
    )
    with common.small_batches(spark):
        rows = added.collect()
    return sum((np.frombuffer(r.learned, "<f8") for r in rows), np.zeros(size))


def train(texts: DataFrame) -> Model:
    """The model of all ``texts.text``, which may be empty; its size does not depend on them."""
    spark = texts.sparkSession
    tree = spark.sparkContext.broadcast(trees(_gathered(texts, _paired, 1 << 16)))
    states = count(texts, tree)
    held = spark.sparkContext.broadcast((tree.value, states))
    sums = _gathered(texts, _learned(lambda: held.value), GATES * (ORDERS + 2 + 2 * BUCKETS))
    cut = GATES * (ORDERS + 1)
    events = sums[cut : cut + GATES, None]
    weights = np.where(events > 0, sums[:cut].reshape(GATES, -1) / np.maximum(events, 1), start_weights())
    zeros, ones = sums[cut + GATES :].reshape(2, GATES, BUCKETS)
    centre = np.linspace(-RANGE, RANGE, BUCKETS)
    usual = 1 / (1 + np.exp(-centre))
    prior = 20.0  # counts that speak for the mixed probability itself
    refined = np.log((ones + prior * usual) / (zeros + prior * (1 - usual)))
    model = Model(tree.value, states, weights.astype(np.float32), refined.astype(np.float32))
    held.unpersist()
    tree.unpersist()
    return model


class Scorer:
    """log10 probabilities of texts."""

    def __init__(self, model: Model) -> None:
        self.model = model

    def words(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All words of the texts in a row, each with the white space or end mark behind it: the number of
        its text, a hash of it, and its log10 probability after the text before it."""
        data = bytes_of(pa.array(texts, pa.string()))
        ends = np.flatnonzero(SPACES[(data.keys & np.uint64(255)).astype(np.int64)])
        begins = np.concatenate(([0], ends[:-1] + 1))
        text = np.repeat(np.arange(len(texts)), data.sizes)[ends]
        return text, data.exact[ends], np.add.reduceat(self.model.costs(data.keys, data.words), begins)

    def tokens(self, names: list[str]) -> np.ndarray:
        """The log10 probability of each as a whole text."""
        text, _, cost = self.words(names)
        return np.bincount(text, weights=cost, minlength=len(names))
