"""Shares and gaps of terms against a dictionary, and the query against its SQL."""

import functools
import re
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import DataFrame

from tillstream.llm import divergence
from tillstream.llm.queries import CHECKS, QUERIES

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
COLUMNS = ["lang", "source", "part", "item", "value", "rank"]


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute(docs, min_docs=10, top=10):
    seen, counts, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in docs:
        lang, source = lang or "", source or ""
        terms = TERM.findall(lower(text or ""))
        groups[lang].add(source)
        counts[lang, source].update(terms)
        seen[lang].update(set(terms))
    out = []
    for lang, sources in groups.items():
        kept = {t for t, n in seen[lang].items() if n >= min_docs}
        v = len(kept)
        n = {s: sum(counts[lang, s][t] for t in kept) for s in sources}
        total = Counter()
        for s in sources:
            total.update({t: counts[lang, s][t] for t in kept})

        def share(count, of):
            return 1 + 10**9 * (count + 2) // (of + 2 * v)

        def ranked(source, part, rows, most=None):
            rows = sorted(rows, key=lambda r: (-r[1], r[0].encode()))[:most]
            return [(lang, source, part, item, value, i + 1) for i, (item, value) in enumerate(rows)]

        p = {s: {t: share(counts[lang, s][t], n[s]) for t in kept} for s in sources}
        q = {t: share(total[t], sum(n.values())) for t in kept}
        for s in sources:
            pairs = [(o, sum((p[s][t] - p[o][t]) ** 2 // (p[s][t] + p[o][t]) for t in kept)) for o in sources if o != s]
            terms = [(t, (p[s][t] - q[t]) ** 2 // (p[s][t] + q[t])) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            out += ranked(s, "pair", pairs) + ranked(s, "term", terms, top)
    return sorted(out)


def rows(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


DOCS = "text string, lang string, source string"


@pytest.fixture(scope="module")
def some(spark, documents, odd):
    more = [("word word, Word. word-word\tWORD don't 東京 é", "xx", f"s{i % 4}") for i in range(30)]
    more += [("only here " * 3, "xx", "s9"), ("", "xx", "empty"), (None, None, None), ("... 123", "yy", "a"), ("", "yy", "b"), (None, "zz", "")]
    parts = [documents, odd, spark.createDataFrame(more, DOCS)]
    return functools.reduce(DataFrame.unionByName, [p.select("text", "lang", "source") for p in parts])


@pytest.mark.parametrize("block", [8 << 20, 20_000])
def test_audit(monkeypatch, some, block):
    monkeypatch.setattr(divergence, "SLICE_BYTES", block)
    monkeypatch.setattr(divergence, "FOLD_CELLS", block // 100)
    monkeypatch.setattr(divergence, "ROWS_OUT", block // 100)
    got = rows(divergence.audit(some))
    assert got == brute([tuple(r) for r in some.collect()])
    assert {"pair", "term"} == {r[2] for r in got}
    assert ("yy", "a", "pair", "b", 0, 1) in got  # a language that keeps no term


def test_counts(some):
    n = Counter()
    for text, lang, source in some.collect():
        n.update((lang or "", source or "", t) for t in TERM.findall(lower(text or "")))
    assert {(r.lang, r.source, r.term): r.n for r in divergence.counts(some).collect()} == n


def test_other_limits(some):
    docs = [tuple(r) for r in some.collect()]
    assert rows(divergence.audit(some, min_docs=3, top=2)) == brute(docs, 3, 2)


def test_odd_and_empty_tables(odd, empty):
    docs = [(r.text, r.lang, r.source) for r in odd.collect()]
    assert rows(divergence.audit(odd, min_docs=1)) == brute(docs, 1)
    assert divergence.audit(empty).count() == 0


def test_long_counts_do_not_overflow(spark):
    c, total = 40_000_000_000, 10**15
    got = spark.range(1).select(
        divergence._share(*[divergence.F.lit(x).cast("bigint") for x in (c, total, 1_000_000)]).alias("p")
    )
    assert got.first().p == 1 + 10**9 * (c + 2) // (total + 2_000_000)


def test_query(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    want = con.execute(CHECKS["op13_divergence"]).fetchdf()[COLUMNS]
    want = sorted(tuple(x.item() if hasattr(x, "item") else x for x in r) for r in want.itertuples(index=False))
    assert rows(QUERIES["op13_divergence"](spark, sf_dir)) == want


def test_term_in_several_rare_chunks(spark):
    """Neither chunk is frequent; the term is if its documents, and not its chunks, are enough."""
    docs = [(f"apple, apple! {w}", "xx", "a") for w in ("pear", "pear;") for _ in range(3)]
    docs += [("apple", "xx", "b"), ("(apple) Apple", "xx", "b"), ("plum. plum", "xx", "b"), ("plum", "xx", "a"), ("plum", "yy", "a")]
    for least in (2, 3, 6, 7, 8, 9):
        got = rows(divergence.audit(spark.createDataFrame(docs, DOCS).repartition(3), min_docs=least))
        assert got == brute(docs, least)
