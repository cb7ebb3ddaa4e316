"""Aligned tokens against both libraries on whole texts, counts against a dictionary, the perfect hash against its claim."""

import base64
import functools
import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from tillstream.llm import alignment
from tillstream.llm.mphf import PerfectHash
from tillstream.llm.queries import QUERIES

A, B = public_tokenizers.path(alignment.BYTE_BPE), public_tokenizers.path(alignment.PIECE_BPE)


@pytest.fixture(scope="module")
def library():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken")) as file:
        known = {int(i): base64.b64decode(t) for t, i in map(str.split, file)}
    b = sentencepiece.SentencePieceProcessor(model_file=B)

    def side_b(i):
        piece = b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()

    def groups(text):
        """Groups of (ids of A, ids of B), or None where a text has no tokens."""
        if not text:
            return None
        a_ids, b_ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        a_bytes, b_bytes = [known[i] for i in a_ids], [side_b(i) for i in b_ids]
        if not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
            return None
        a_ends, b_ends = np.cumsum([len(x) for x in a_bytes]).tolist(), np.cumsum([len(x) for x in b_bytes]).tolist()
        a_at, b_at = ({end: at + 1 for at, end in enumerate(ends)} for ends in (a_ends, b_ends))
        out, i, j = [], 0, 0
        for end in sorted(a_at.keys() & b_at.keys()):
            k, m = a_at[end], b_at[end]
            out.append((a_ids[i:k], b_ids[j:m]))
            i, j = k, m
        return out

    return groups


def brute(groups, docs):
    found = [(doc_id, groups(text)) for doc_id, text in docs]
    counts, most = Counter(), Counter()
    for _, gs in found:
        counts.update({(x, y) for xs, ys in gs or [] for x in xs for y in ys})
    for (x, _), n in counts.items():
        most[x] = max(most[x], n)
    out = []
    for doc_id, gs in found:
        links = [(x, y) for xs, ys in gs or [] for x in xs for y in ys]
        text = ";".join(f"{','.join(map(str, xs))}|{','.join(map(str, ys))}" for xs, ys in gs or [])
        out.append((
            str(doc_id), sum(len(xs) for xs, _ in gs or []), sum(len(ys) for _, ys in gs or []), len(gs or []), len(links),
            sum(counts[p] == most[p[0]] for p in links), sum(counts[p] for p in links),
            hashlib.sha256(text.encode()).hexdigest() if gs else "",
        ))
    return sorted(out), counts


NAMES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def rows(df):
    return sorted((str(r.doc_id), *[r[n] for n in NAMES]) for r in df.collect())


_TEXT = st.text(
    st.sampled_from(list("abXY éß漢Ж🙂.,'\n\t\r\x0b\x1c\x85 　▁ ́01 ")) | st.characters(codec="utf-8"), max_size=40
)


@settings(max_examples=300, deadline=None)
@given(st.lists(_TEXT | st.sampled_from([" ", "  ", "a ", "a \n", "\n\n b", "x<|endoftext|> </s>", "don't 'll", " \r x", "a\x00b"]), max_size=6))
def test_chunks_align_like_whole_texts(library, texts):
    one = alignment.aligner(A, B)
    numbers, counts = one.number(texts)
    ends = np.cumsum(counts)
    for text, end, n in zip(texts, ends, counts, strict=True):
        own = numbers[end - n : end]
        want = library(text)
        assert (n == 0 or bool(one.size[own, 4].any())) == (want is None)
        if want is not None:
            got = str(one.groups(own, np.array([n]))[0], "ascii")
            assert got == ";".join(f"{','.join(map(str, xs))}|{','.join(map(str, ys))}" for xs, ys in want)


@pytest.fixture(scope="module")
def some(documents, odd, spark):
    more = [(500, "▁ marks a blank"), (501, "ends with blanks  "), (502, " "), (503, "a\r\nb\tc"), (504, "x" * 3000), (None, None)]
    texts = spark.createDataFrame(more, "doc_id long, text string")
    parts = [documents.filter("doc_id < 60"), odd, texts]
    return functools.reduce(DataFrame.unionByName, [p.select("doc_id", "text") for p in parts])


@pytest.mark.parametrize(("region", "round_keys", "fan_in"), [(1 << 18, 1 << 23, 16), (500, 3_000, 2)])
def test_documents(monkeypatch, library, some, region, round_keys, fan_in):
    """One region and round, and many of both with a deep tree, give the brute-force result."""
    monkeypatch.setattr(alignment, "REGION_KEYS", region)
    monkeypatch.setattr(alignment, "ROUND_KEYS", round_keys)
    monkeypatch.setattr(alignment, "FAN_IN", fan_in)
    want, counts = brute(library, [tuple(r) for r in some.collect()])
    assert rows(alignment.align(some)) == want
    got = {(r.id_a, r.id_b): r.documents for r in alignment.pair_counts(some).collect()}
    assert got == counts


def test_query(spark, sf_dir, library, documents):
    docs = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    assert rows(QUERIES["op12_alignment"](spark, sf_dir)) == brute(library, docs)[0]


def test_groups_and_other_columns(library, odd):
    got = alignment.align(odd, with_groups=True)
    assert got.columns == ["doc_id", *NAMES, "groups"]
    for r in got.collect():
        assert r.groups_sha256 == (hashlib.sha256(r.groups.encode()).hexdigest() if r.groups else "")


def test_empty_table(empty, odd):
    assert alignment.align(empty).count() == 0
    assert alignment.pair_counts(empty).count() == 0
    none = alignment.align(odd.filter("text is null or text = ''")).collect()
    assert none and all([r[n] for n in NAMES] == [0] * 6 + [""] for r in none)


def test_worker_cache_begins_anew(monkeypatch, library):
    monkeypatch.setattr(alignment, "CACHE_CHUNKS", 5)
    one = alignment.Aligner(A, B)
    for text in ("one two three four five six", "six seven one", "two"):
        got = str(one.groups(*one.number([text]))[0], "ascii")
        assert got == ";".join(f"{','.join(map(str, xs))}|{','.join(map(str, ys))}" for xs, ys in library(text))


@pytest.mark.parametrize("n", [0, 1, 2, 63, 1000, 100_000])
def test_perfect_hash(n):
    keys = np.random.default_rng(n).choice(1_600_000_000, n, replace=False)
    made = PerfectHash.from_bytes(PerfectHash.build(keys).to_bytes())
    assert sorted(made.index(keys).tolist()) == list(range(n))
    assert len(made) == n
    if n > 1000:
        assert len(made.to_bytes()) * 8 < 6 * n
    others = np.arange(1_600_000_000, 1_600_001_000)
    assert ((made.index(others) >= -1) & (made.index(others) < max(n, 1))).all()


def test_repeated_keys_are_refused():
    with pytest.raises(ValueError, match="distinct"):
        PerfectHash.build(np.array([5, 5]))
