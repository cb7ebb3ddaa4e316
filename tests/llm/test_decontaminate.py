"""Benchmark overlaps against a dictionary of all windows."""

import hashlib
import re

import pytest

from tillstream.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    index = {}
    for item, text in items:
        w = words(text)
        n = min(13, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            index.setdefault(n, {}).setdefault(tuple(w[i : i + n]), set()).add(str(item))
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for n, windows in index.items():
            for i in range(len(w) - n + 1):
                if names := windows.get(tuple(w[i : i + n])):
                    hit.update(range(i, i + n))
                    found |= names
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((str(doc_id), len(w), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out)


def run(docs, items):
    got = decontaminate.overlaps(docs, items).collect()
    return sorted((str(r.doc_id), r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got)


@pytest.fixture(scope="module")
def planted(spark, documents, odd):
    texts = [
        (100_001, "Alpha beta, gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi"),
        (100_002, "before ALPHA beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu after " * 3),
        (100_003, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"),
        (100_004, "one two three " * 50),
        (100_005, "a a a a a a a a a a a a a a a a a a a a a a b"),
        (100_006, "the of, and"),
    ]
    more = spark.createDataFrame(texts, "doc_id long, text string")
    return documents.select("doc_id", "text").unionByName(odd.select("doc_id", "text")).unionByName(more)


@pytest.fixture(scope="module")
def items(spark, sf_dir):
    base = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    more = [
        (9001, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron"),
        (9002, "One two"), (9003, "!!"), (9004, None), (9005, ""), (9006, "a a a a a a a a a a a a a a"),
        (9007, "漢字"), (9008, "three one two three"), (9001, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron"),
    ]
    return base.unionByName(spark.createDataFrame(more, base.schema))


@pytest.mark.parametrize("limit", [200_000, -1])
def test_overlaps(monkeypatch, planted, items, limit):
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", limit)
    assert run(planted, items) == brute(
        [tuple(r) for r in planted.collect()], [(r.item_id, r.text) for r in items.collect()]
    )


def test_stage_drops_contaminated_rows_only(spark, odd, items):
    out = decontaminate.clean(odd, items)
    assert out.columns == odd.columns
    bad = {r[0] for r in run(odd, items) if r[5]}
    assert sorted(str(r.doc_id) for r in out.collect()) == sorted(str(r.doc_id) for r in odd.collect() if str(r.doc_id) not in bad)
    assert "6" in bad


def test_empty_tables(spark, empty, items, odd):
    assert decontaminate.overlaps(empty, items).count() == 0
    none = items.limit(0)
    assert {r.n_hit for r in decontaminate.overlaps(odd, none).collect()} == {0}
    assert decontaminate.clean(odd, none).count() == odd.count()


def test_no_python_in_the_plan(planted, items):
    plan = decontaminate.overlaps(planted, items)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
