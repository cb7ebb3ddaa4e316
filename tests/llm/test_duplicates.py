"""Fingerprint groups, exact groups and their stages against brute force."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from tillstream.llm import exact, simhash


def plain_print(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_of(prints):
    prints = np.array(prints, np.uint64)
    label = np.arange(len(prints))
    while True:
        new = np.array([label[np.bitwise_count(prints ^ p) <= 3].min() for p in prints])
        if (new == label).all():
            return label
        label = new


def test_prints_and_components(spark, documents, odd):
    docs = documents.unionByName(odd.select(documents.columns))
    rows = docs.collect()
    got = simhash.groups(docs).collect()
    assert sorted((r.doc_id or -1, r.fingerprint) for r in got) == sorted(
        (r.doc_id or -1, f"{plain_print(r.text):016x}") for r in rows
    )
    label = components_of([plain_print(r.text) for r in rows])
    least = {}
    for r, c in zip(rows, label, strict=True):
        if r.doc_id is not None:
            least[c] = min(least.get(c, r.doc_id), r.doc_id)
    want = sorted((f"{plain_print(r.text):016x}", least.get(c)) for r, c in zip(rows, label, strict=True))
    key = lambda x: (x[0], x[1] is None, x[1] or 0)
    assert sorted(((r.fingerprint, r.component_id) for r in got), key=key) == sorted(want, key=key)


@pytest.mark.parametrize("spread", [2, 40])
def test_links_of_chains_and_crowds(spark, spread):
    """Many prints around few centres: long lists, chains of links, hot lists."""
    rng = np.random.default_rng(spread)
    centres = rng.integers(0, 1 << 63, 3, dtype=np.int64)
    prints = set()
    for c in centres.tolist():
        for _ in range(400):
            for b in rng.choice(64, rng.integers(0, 4), replace=False):
                c ^= 1 << int(b)
            prints.add(c & ((1 << 63) - 1))
            if rng.random() < 1 / spread:
                c = int(centres[0])
    prints = sorted(prints)
    frame = spark.createDataFrame([(p,) for p in prints], "print long")
    got = {r.node: r.root for r in simhash.components(simhash.links(frame)).collect()}
    label = components_of(prints)
    first = {c: min(p for p, x in zip(prints, label, strict=True) if x == c) for c in set(label.tolist())}
    assert {p: got.get(p, p) for p in prints} == {p: first[c] for p, c in zip(prints, label.tolist(), strict=True)}


def test_forest_by_flips_agrees_with_comparison():
    rng = np.random.default_rng(5)
    members = np.unique(rng.integers(0, 1 << 14, 1500, dtype=np.uint64) << np.uint64(9))
    plain = simhash.forest(members)
    flips = simhash._forest_by_flips(members)
    assert len(plain) == len(flips)
    assert (np.bitwise_count(flips[:, 0] ^ flips[:, 1]) <= 3).all()


def test_near_stage_keeps_one_of_each_group(spark, documents, odd):
    kept = simhash.deduplicate(documents).collect()
    groups = simhash.groups(documents).collect()
    assert sorted(r.doc_id for r in kept) == sorted({g.component_id for g in groups})
    out = simhash.deduplicate(odd)
    assert out.columns == odd.columns
    texts = [plain_print(r.text) for r in out.collect()]
    assert len(texts) == len(set(texts)) and 0 in texts


@settings(max_examples=50, deadline=None)
@given(st.sets(st.integers(0, (1 << 40) - 1), max_size=300))
def test_golomb_codes(values):
    values = np.array(sorted(values), np.int64)
    assert (exact.golomb_decode(exact.golomb_encode(values, 1 << 40)) == values).all()


def _exact_want(rows):
    count = Counter(r.text or "" for r in rows)
    last = {}
    for r in rows:
        t, old = r.text or "", last.get(r.text or "")
        last[t] = r.doc_id if old is None else max(old, r.doc_id if r.doc_id is not None else old)
    return sorted(
        (str(r.doc_id), str(last[r.text or ""]), count[r.text or ""], hashlib.sha256((r.text or "").encode()).hexdigest())
        for r in rows
    )


def test_exact_groups(spark, documents, odd):
    docs = documents.unionByName(odd.select(documents.columns)).repartition(7)
    from tillstream.llm import common

    docs = common.stage(docs, "test")
    got = exact.groups(docs).collect()
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.text_sha256) for r in got) == _exact_want(docs.collect())
    kept = [r for r in got if r.kept]
    assert len(kept) == len({r.text_sha256 for r in got}) == len({r.text_sha256 for r in kept})
    assert all(r.doc_id == r.keep_id for r in kept)


def test_exact_stage(spark, odd):
    from tillstream.llm import common

    docs = common.stage(odd, "test")
    out = exact.deduplicate(docs)
    assert out.columns == odd.columns
    rows = out.collect()
    assert sorted(r.text or "" for r in rows) == sorted({r.text or "" for r in docs.collect()})
    assert {r.doc_id for r in rows} == {None, 2, 3, 5, 6, 7, 8, 9}


def test_owners_answer_what_several_rows_have():
    parts = [np.array([5, 9, 9, 1 << 47]), np.array([5, 7]), np.array([1 << 47, 11, 1 << 40])]
    owners = 3
    asked = [dict(exact._question(p, owners)) for p in parts]
    for part, questions in zip(parts, asked, strict=True):
        answers = []
        for owner, question in questions.items():
            everyone = [q[owner] for q in asked if owner in q]
            answers.append((owner, question, exact._answer(owner, everyone)[everyone.index(question)]))
        want = sorted(v for v in set(part.tolist()) if sum((p == v).sum() for p in parts) > 1)
        assert exact._suspects(answers, owners).tolist() == want


def test_empty_tables(empty):
    assert simhash.groups(empty).count() == 0 and simhash.deduplicate(empty).count() == 0
    assert exact.groups(empty).count() == 0 and exact.deduplicate(empty).count() == 0
