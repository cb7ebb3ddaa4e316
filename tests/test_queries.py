"""Every registered query against its checking SQL on the same tables."""

import math
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from tillstream.plans import load

QUERIES, CHECKS = load()

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def db(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _value(v):
    if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
        return None
    return v.item() if hasattr(v, "item") else v


def rows(df):
    df = df[sorted(df.columns)].astype(object)
    out = [tuple(map(_value, r)) for r in df.itertuples(index=False)]
    return sorted(out, key=lambda r: [(v is None, str(v)) for v in r])


def same(spark, db, sf_dir, name):
    got = QUERIES[name](spark, sf_dir).toPandas()
    want = db.execute(CHECKS[name]).fetchdf()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_every_query_has_a_check():
    assert set(QUERIES) == set(CHECKS)
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, sf_dir, name):
    same(spark, db, sf_dir, name)


@pytest.mark.parametrize("name", ["minute_gmv", "payment_detail", "usage_rates", "month_to_date"])
def test_any_session_zone(spark, db, sf_dir, name):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        same(spark, db, sf_dir, name)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_entry(spark, sf_dir):
    got = entry.entry(spark)
    assert got.columns == ["stat_minute", "net_amount", "pay_amount", "pay_count"]
    assert got.count() > 0
