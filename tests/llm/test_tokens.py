"""Token ids, files, packing and counts against the tokenizers library itself."""

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tillstream.llm import huffman, packing, rollups, tokens
from tillstream.session import work_dir


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokens.path())


def ids_of(library, texts):
    return [e.ids for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


_TEXT = st.text(
    st.sampled_from(list("abcXYZéßñ漢Ж .,!?'\"<|>\n\t\r\x0b\x1c ́019-$#%")) | st.characters(codec="utf-8"), max_size=60
)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(_TEXT, st.sampled_from(["<|endoftext|>", "It's", "WE'LL go.", "x<|startoftext|>,", None])), max_size=8))
def test_chunks_give_the_library_ids(library, texts):
    ids, counts = tokens.encoder(tokens.path()).encode(texts)
    want = ids_of(library, texts)
    assert counts.tolist() == [len(w) for w in want]
    assert ids.tolist() == [i for w in want for i in w]


def test_cache_that_forgets(library, documents, monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_CHUNKS", 500)
    texts = [r.text for r in documents.limit(60).collect()]
    encoder = tokens.Encoder(tokens.path())
    for i in range(0, 60, 7):
        ids, _ = encoder.encode(texts[i : i + 7])
        assert ids.tolist() == [x for w in ids_of(library, texts[i : i + 7]) for x in w]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 5000), min_size=1, max_size=300), st.integers(0, 2**32))
def test_huffman_round_trip(counts, seed):
    counts = np.array(counts)
    if not counts.any():
        counts[0] = 1
    lengths = huffman.code_lengths(counts)
    assert ((lengths > 0) == (counts > 0)).all() and lengths.max() <= huffman.MAX_BITS
    assert (2.0 ** -lengths[lengths > 0]).sum() <= 1
    ids = np.random.default_rng(seed).choice(np.flatnonzero(counts), 700).astype(np.uint32)
    offsets, payload = huffman.encode_bits(ids, lengths, huffman.canonical(lengths))
    back = huffman.decode_bits(payload, offsets[:: huffman.STRIDE], len(ids), huffman.decode_table(lengths))
    assert (back == ids).all()


def test_lengths_are_limited_and_optimal():
    import heapq

    counts = np.random.default_rng(1).integers(1, 1000, 500)
    heap, cost = counts.tolist(), 0
    heapq.heapify(heap)
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        cost += both
        heapq.heappush(heap, both)
    assert (counts * huffman.code_lengths(counts)).sum() == cost
    steep = (1.9 ** np.arange(60)).astype(np.int64)
    assert huffman.code_lengths(steep).max() == huffman.MAX_BITS


def test_files_hold_every_id_in_order(spark, library, documents, odd):
    docs = documents.select("doc_id", "text").unionByName(odd.select("doc_id", "text"))
    folder = work_dir(spark, "test-files")
    huffman.write(docs, folder)
    got = huffman.read(spark, folder).toPandas().sort_values("start")
    rows = docs.toPandas()
    rows["id"], rows["t"] = rows.doc_id.fillna(-1), rows.text.fillna("")
    rows = rows.sort_values(["id", "t"])
    want = [[*i, huffman.END_ID] for i in ids_of(library, rows.t)]
    assert got.doc_id.fillna(-1).tolist() == rows.id.tolist()
    assert [np.frombuffer(b, "<u4").tolist() for b in got.ids] == want
    assert got.n_tokens.tolist() == [len(w) for w in want]
    assert got.start.tolist() == np.concatenate([[0], np.cumsum([len(w) for w in want])[:-1]]).tolist()
    assert got.ids_crc32.tolist() == [zlib.crc32(np.array(w, "<u4").tobytes()) for w in want]


def test_packing(spark, library, documents, odd):
    docs = documents.select("doc_id", "text").unionByName(odd.select("doc_id", "text")).withColumnRenamed("text", "body")
    got = packing.pack(docs, text_col="body", with_ids=True)
    pieces = got.toPandas()
    rows = docs.toPandas()
    want = {}
    for doc_id, ids in zip(rows.doc_id.fillna(-1), ids_of(library, rows.body), strict=True):
        want.setdefault(doc_id, []).append([*ids, packing.END_ID])
    for doc_id, own in pieces.groupby(pieces.doc_id.fillna(-1)):
        copies = len(want[doc_id])
        assert own.length.sum() == sum(len(w) for w in want[doc_id])
        if copies == 1:
            own = own.sort_values("start")
            assert [i for b in own.ids for i in np.frombuffer(b, "<u4")] == want[doc_id][0]
            assert (own.doc_tokens == len(want[doc_id][0])).all()
    assert set(pieces.doc_id.fillna(-1)) == set(want)
    assert (pieces.ids_crc32 == [zlib.crc32(b) for b in pieces.ids]).all()
    for _, own in pieces.sort_values("offset").groupby("sequence_id"):
        assert own.offset.tolist() == np.concatenate([[0], np.cumsum(own.length)[:-1]]).tolist()
        assert own.length.sum() <= packing.CAPACITY
    sizes = pieces.groupby("sequence_id").length.sum()
    assert sizes.index.tolist() == list(range(len(sizes)))
    padding = sum(packing.CAPACITY - n for n in sizes if n & (n - 1))
    assert padding <= 0.02 * sizes.sum() + packing.CAPACITY
    joined = packing.sequences(got).collect()
    assert all(4 * r.length == len(r.ids) for r in joined)


def test_class_pieces_fill_sequences():
    best = packing.classes(2048)
    for n in [1, 2, 45, 46, 700, 2047, 2048, 5000]:
        pieces = list(packing.cuts(n, 2048, best))
        assert sum(size for _, size, _ in pieces) == n
        assert all(size == 2048 // j and 2048 - j * size < j for _, size, j in pieces)


def _totals(spark, store):
    return {(r.source, r.lang, r.tokenizer): (r.docs, r.tokens) for r in rollups.totals(spark, store).collect()}


def test_rollups(spark, library):
    store = work_dir(spark, "test-rollups")
    state = {}

    def go(batch, *changes, keep=True):
        frame = spark.createDataFrame(
            list(changes), "op string, doc_id long, source string, lang string, text string, seq long"
        ).withColumnRenamed("x", "x")
        rollups.apply(spark, store, batch, frame.selectExpr("*", "1 as docs", "2 as tokens", "3 as batch"))
        if keep:
            for op, doc, source, lang, text, _ in sorted(changes, key=lambda c: c[5] or 0):
                state.pop(doc, None)
                if op != "delete":
                    state[doc] = (source, lang, text)
        want = {}
        for source, lang, text in state.values():
            both = len((text or "").encode().split()), len(ids_of(library, [text])[0])
            for name, n in zip(rollups.VERSIONS, both, strict=True):
                docs, total = want.get((source, lang, name), (0, 0))
                want[(source, lang, name)] = (docs + 1, total + n)
        assert _totals(spark, store) == want

    first = [("insert", i, f"s{i % 2}", "en", "some words " * i, 0) for i in range(6)]
    go(1, *first, ("insert", None, None, None, None, 0))
    go(1, *first, ("insert", None, None, None, None, 0))
    second = [
        ("revise", 1, "s9", None, "moved and revised", 0), ("delete", 2, "s0", "en", None, 0),
        ("delete", 77, "s0", "en", "never there", 0), ("insert", 3, "s1", "de", "over", 0),
        ("revise", 4, "s0", "en", "first", 1), ("delete", 4, "s0", "en", "then gone", 2),
        ("insert", 8, "s0", "en", "repeated", 0), ("insert", 8, "s0", "en", "repeated", 0),
    ]
    go(2, *second)
    go(2, *second)
    go(3, ("insert", 2, "s0", "en", "back again", 0), ("delete", None, None, None, None, 0))
    go(2, *second, keep=False)


def test_empty_tables(spark, empty):
    folder = work_dir(spark, "test-empty")
    huffman.write(empty, folder)
    assert huffman.read(spark, folder).count() == 0
    assert packing.pack(empty).count() == 0
    rollups.apply(spark, f"{folder}/r", 1, empty.selectExpr("'insert' as op", "*"))
    assert rollups.totals(spark, f"{folder}/r").count() == 0


@settings(max_examples=50, deadline=None)
@given(st.lists(_TEXT, max_size=20))
def test_strings_of_a_dictionary(texts):
    dictionary = pa.array(texts, pa.string()).dictionary_encode().dictionary
    assert tokens.strings(dictionary) == dictionary.to_pylist() == list(dict.fromkeys(texts))


def test_plain_words_go_to_the_model_itself(library):
    """Normalizing, splitting and offsets cost more than half of the encoding; only odd chunks need them."""
    encoder, calls = tokens.Encoder(tokens.path()), []

    class Watched:
        def encode(self, text, add_special_tokens):
            calls.append(text)
            return library.encode(text, add_special_tokens=add_special_tokens)

    encoder.tokenizer = Watched()
    texts = ["wordlike Été naïve Naïve größer, WORDS words; Words", "İstanbul 漢字 it's x's a1 <|endoftext|>, don't; don't", None, "ﬁné"]
    ids, counts = encoder.encode(texts)
    want = ids_of(library, texts)
    assert counts.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]
    assert not any(w in c.split(" ") for c in calls for w in ("wordlike", "Été", "naïve", "größer", "words"))
    assert any("don't" in c for c in calls)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from([*map(chr, tokens._SPELLED), *"ſıİŉ×÷ªºµ"]), max_size=12), min_size=1, max_size=30))
def test_words_of_plain_letters_give_the_library_ids(library, words):
    encoder = tokens.encoder(tokens.path())
    assert encoder.spells
    ids, counts = encoder.encode([" ".join(words)])
    assert ids.tolist() == ids_of(library, [" ".join(words)])[0]


def test_a_vocabulary_that_spells_otherwise(library, tmp_path):
    """Without lower case the model itself gives other ids, so every chunk goes through the library."""
    import json

    other = json.loads(library.to_str())
    other["normalizer"]["normalizers"].pop()
    path = tmp_path / "other.json"
    path.write_text(json.dumps(other))
    assert not tokens.Encoder(str(path)).spells
