"""The rule of op9 for rows without an id and repeated rows."""

from tillstream.llm import rollups
from tillstream.session import work_dir


def test_rows_of_one_id_or_none_are_one_document(spark):
    rows = [("insert", None, "a b"), ("insert", None, "c d"), ("insert", 1, "e"), ("insert", 1, "e"), ("insert", 2, "e")]
    changes = spark.createDataFrame(rows, "op string, doc_id long, text string").selectExpr("*", "'s' as source", "'en' as lang")
    store = work_dir(spark, "test-odd-counts")
    rollups.apply(spark, store, 1, changes)
    got = {r.tokenizer: (r.docs, r.tokens) for r in rollups.totals(spark, store).collect()}
    assert got[rollups.WORDS] == (3, 4)
