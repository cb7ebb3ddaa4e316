"""The pipeline against its stages, and the registered queries."""

import re

import corpus_pipeline
import duckdb
import pytest

import __spark_entry__ as entry
from tillstream.llm.queries import CHECKS, QUERIES
from tillstream.llm import decontaminate, exact, packing, quality, simhash


def test_stages_and_run(spark, sf_dir, documents, labels):
    docs = documents
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    for name, apply in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r for r in docs.collect()}
        if name == "quality":
            want = {r.doc_id for r in quality.classify(docs, labels).collect() if r.predicted}
        elif name == "exact_dedup":
            want = {r.doc_id for r in exact.groups(docs).collect() if r.kept}
        elif name == "near_dedup":
            want = {r.doc_id for r in simhash.groups(docs).collect() if r.doc_id == r.component_id}
        else:
            want = {r.doc_id for r in decontaminate.overlaps(docs, benchmark).collect() if not r.contaminated}
        out = apply(spark, docs, sf_dir)
        assert out.columns == documents.columns
        docs = corpus_pipeline.stage(out, "test")
        rows = docs.collect()
        assert {r.doc_id for r in rows} == want and len(rows) == len(want) <= len(before)
        assert all(before[r.doc_id] == r for r in rows)
    got = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r.doc_id for r in got} == want
    assert sorted(map(tuple, got)) == sorted(map(tuple, packing.pack(docs).select(got[0].__fields__).collect()))


def test_names():
    found = {int(m[1]) for m in (re.match(r"op(\d+)_", n) for n in QUERIES) if m}
    assert found == set(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(CHECKS) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_checking_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    want, got = con.execute(CHECKS[name]).fetchdf(), QUERIES[name](spark, sf_dir).toPandas()
    columns = sorted(want.columns)
    assert columns == sorted(got.columns)
    rows = lambda df: sorted(map(tuple, df[columns].astype(object).values.tolist()), key=str)
    assert rows(got) == rows(want)
