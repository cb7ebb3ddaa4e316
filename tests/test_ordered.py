"""Ordered and skew-safe operators against brute force, with hot keys."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tillstream.operators import skew
from tillstream.operators.asof import asof_lookup, intervals, last_below, merge_points
from tillstream.operators.ordered import (
    following,
    latest_per_key,
    quantiles,
    rolling_distinct,
    rolling_sums,
    running,
)


def events(n=400, seed=1, span=300):
    """(key, at, value): key ``hot`` holds more than a third of the rows."""
    r = random.Random(seed)
    return [
        ("hot" if r.random() < 0.4 else f"k{r.randrange(12)}", r.randrange(span), r.randrange(20))
        for _ in range(n)
    ]


@pytest.fixture(scope="module")
def rows():
    return events()


@pytest.fixture(scope="module")
def df(spark, rows):
    return spark.createDataFrame(rows, "k string, at long, v long").cache()


@pytest.mark.parametrize("block", [1, 7, 50, 1000])
def test_running(df, rows, block):
    got = running(df, ["k"], "at", {"s": (F.col("v"), "sum"), "m": (F.col("v"), "max")}, block)
    got = {(r.k, r.at): r for r in got.collect()}
    assert set(got) == {(k, a) for k, a, _ in rows}
    for (k, a), r in got.items():
        own = [v for k2, a2, v in rows if (k2, a2) == (k, a)]
        before = [v for k2, a2, v in rows if k2 == k and a2 < a]
        assert (r.s, r.m) == (sum(own), max(own))
        assert (r.s_before or 0, r.m_before) == (sum(before), max(before, default=None))
        assert (r.s_upto, r.m_upto) == (sum(own + before), max(own + before))


@pytest.mark.parametrize("width", [1, 10, 60, 500])
def test_rolling(df, rows, width):
    sums = {(r.k, r.at): r.s for r in rolling_sums(df, "k", "at", width, {"s": F.col("v")}).collect()}
    others = {
        (r.k, r.at): r.d for r in rolling_distinct(df, "k", "v", "at", width, "d").collect()
    }
    assert set(sums) == set(others) == {(k, a) for k, a, _ in rows}
    for (k, a), s in sums.items():
        near = [v for k2, a2, v in rows if k2 == k and a - width <= a2 <= a]
        assert s == sum(near)
        assert others[k, a] == len(set(near))


@pytest.mark.parametrize("block", [1, 5, 100])
def test_following(df, rows, block):
    points = df.select("k", "at").distinct()
    got = {(r.k, r.at): r.n for r in following(points, ["k"], "at", "n", block).collect()}
    assert set(got) == {(k, a) for k, a, _ in rows}
    for (k, a), n in got.items():
        assert n == min((a2 for k2, a2, _ in rows if k2 == k and a2 > a), default=None)


def test_quantiles(df, rows):
    got = {r.k: r for r in quantiles(df, ["k"], "v", [1, 50, 90, 100]).collect()}
    for k in {k for k, _, _ in rows}:
        values = sorted(v for k2, _, v in rows if k2 == k)
        for p in (1, 50, 90, 100):
            assert got[k][f"p{p}"] == values[math.ceil(p * len(values) / 100) - 1]


def test_latest_per_key(df, rows):
    got = {r.k: (r.at, r.v) for r in latest_per_key(df, ["k"], ["at"]).collect()}
    want = {}
    for k, a, v in rows:
        want[k] = max(want.get(k, (a, v)), (a, v))
    assert got == want


@pytest.fixture(scope="module")
def sides(spark):
    left = [("hot" if i % 3 else f"k{i % 50}", i) for i in range(600)] + [(None, -i) for i in range(1, 9)]
    right = [(f"k{i}", i * 10) for i in range(0, 50, 2)] + [("hot", 7), ("hot", 8), (None, 9)]
    return (
        spark.createDataFrame(left, "k string, a long"),
        spark.createDataFrame(right, "k string, b long"),
    )


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("hot_rows", [0, 10, 10_000])
def test_salted_join(sides, how, hot_rows):
    left, right = sides
    plain = left.join(right, ["k"], how)
    got = skew.salted_join(left, right, ["k"], how, hot_rows, salts=5)
    assert got.columns == plain.columns
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, plain.collect()), key=key)


def test_salted_join_spreads_the_hot_key(sides, monkeypatch):
    left, _ = sides
    hot = skew.hot_buckets(left.dropna(), ["k"], 10).collect()
    assert len(hot) >= 1
    salts = left.where("k = 'hot'").select(skew.content_salt(left, 8).alias("s")).distinct()
    assert salts.count() == 8


def test_lookup_join_beyond_the_size_bound(sides, monkeypatch):
    left, right = sides
    small = skew.lookup_join(left, right, ["k"]).collect()
    monkeypatch.setattr(skew, "fits_broadcast", lambda df, limit=1: skew.measured_bytes(df) <= 1)
    large = skew.lookup_join(left, right, ["k"], derived=True)
    assert "_salt" in large._jdf.queryExecution().toString()
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, large.collect()), key=key) == sorted(map(tuple, small), key=key)


def test_two_stage_and_isolated(df, rows):
    sums = {"n": F.lit(1), "s": F.col("v")}
    want = {}
    for k, _, v in rows:
        n, s = want.get(k, (0, 0))
        want[k] = (n + 1, s + v)
    salted = skew.two_stage(df, ["k"], sums, 7, F.col("at"))
    assert {r.k: (r.n, r.s) for r in salted.collect()} == want
    apart = skew.isolate_hot(df, "k", 50, sums, 7, F.col("at")).collect()
    assert {r.k: (r.n, r.s) for r in apart} == want
    assert {r.k for r in apart if r.path == "salted"} == {k for k in want if want[k][0] > 50}


def test_running_over_a_million_blocks(spark):
    """All blocks of one key; the largest group that a task sorts is a block, or a group of blocks."""
    n = 1_000_000
    points = spark.range(n).selectExpr("'hot' as k", "id * 10 as at", "id % 7 as v")
    got = running(points, ["k"], "at", {"s": (F.col("v"), "sum"), "m": (F.col("v"), "max")}, block=10)
    assert n / 4_096 < 4_096
    wrong = got.where((F.col("s_upto") != F.expr("div(at, 70) * 21 + (at / 10 % 7) * (at / 10 % 7 + 1) / 2")))
    assert got.count() == n
    assert wrong.count() == 0
    assert got.where("m_upto <> least(at / 10, 6)").count() == 0


def _asof(dim, key, t):
    """Latest (at, version) not after t."""
    found = [d for d in dim if d[0] == key and d[1] <= t]
    return max(found, key=lambda d: (d[1], d[2]), default=None)


@pytest.mark.parametrize(("block_ms", "limit"), [(3, 0), (40, 1 << 20), (1000, 1 << 20)])
@pytest.mark.parametrize("before_first", ["null", "first"])
def test_asof_lookup(spark, monkeypatch, before_first, block_ms, limit):
    monkeypatch.setattr(skew, "fits_broadcast", lambda df: skew.measured_bytes(df) <= limit)
    r = random.Random(5)
    dim = [(f"k{r.randrange(6)}" if i % 3 else "hot", r.randrange(100), i, f"x{i}") for i in range(40)]
    facts = [("hot" if i % 3 else f"k{i % 9}", r.randrange(-20, 140), i) for i in range(300)]
    got = asof_lookup(
        spark.createDataFrame(facts, "k string, t long, i long"),
        spark.createDataFrame(dim, "k string, at long, ver long, x string"),
        ["k"], "t", "at", "d", "ver", before_first, block_ms,
    )
    assert got.count() == len(facts)
    for row in got.collect():
        want = _asof(dim, row.k, row.t)
        if want is None and before_first == "first":
            own = [d for d in dim if d[0] == row.k]
            if own:
                first = min(d[1] for d in own)
                want = max((d for d in own if d[1] == first), key=lambda d: d[2])
        assert (row.d and (row.d.at, row.d.ver, row.d.x)) == (want and want[1:]), row


def test_asof_with_many_versions_of_one_day(spark):
    """Thousands of versions of one key within a day do not multiply its facts."""
    facts = spark.range(8_000).selectExpr("'hot' as k", "id * 10000 as t", "id as i")
    dim = spark.range(5_000).selectExpr("'hot' as k", "id * 17000 as at", "cast(id as int) as ver")
    steps = dim.selectExpr("k", "at as _t", "struct(at, ver) as _row")
    points = merge_points(facts.selectExpr("k", "t as _t"), steps, ["k"], 3_600_000)
    assert points.count() <= 2 * facts.count()
    got = asof_lookup(facts, dim, ["k"], "t", "at", "d", "ver")
    assert got.where("d.ver <> least(div(t, 17000), 4999)").count() == 0
    assert got.where("d is not null").count() == 8_000


def test_asof_of_nulls_and_empty_tables(spark):
    facts = spark.createDataFrame([(None, 5, 1), ("a", None, 2), ("a", 5, 3), ("a", 5, 3)], "k string, t long, i long")
    dim = spark.createDataFrame([(None, 1, 1), ("a", None, 2), ("a", 3, 3)], "k string, at long, ver long")
    got = sorted((r.i, r.d and r.d.ver) for r in asof_lookup(facts, dim, ["k"], "t", "at", "d", "ver", "first").collect())
    assert got == [(1, None), (2, None), (3, 3), (3, 3)]
    assert {r.d for r in asof_lookup(facts, dim.limit(0), ["k"], "t", "at", "d", "ver").collect()} == {None}
    assert asof_lookup(facts.limit(0), dim, ["k"], "t", "at", "d", "ver").count() == 0


def test_intervals_keep_the_highest_version(spark):
    dim = spark.createDataFrame(
        [("a", 10, 1), ("a", 10, 3), ("a", 20, 2)], "k string, at long, ver int"
    )
    got = sorted(map(tuple, intervals(dim, ["k"], "at", "ver").collect()))
    assert got == [("a", 10, 20, 3), ("a", 20, None, 2)]


@pytest.mark.parametrize("fanout", [2, 4, 64])
def test_last_below(spark, fanout):
    r = random.Random(9)
    points = [("hot", i, r.randrange(100)) for i in range(1, 60)] + [("k", i, 5) for i in range(1, 4)]
    cases = [("hot", r.randrange(0, 62), r.randrange(0, 40)) for _ in range(80)]
    cases += [("k", 2, 5), ("k", 2, 4), ("none", 3, 50)]
    got = last_below(
        spark.createDataFrame(sorted(set(cases)), "k string, pos long, bound long"),
        spark.createDataFrame(points, "k string, rank long, low long"),
        "k",
        fanout,
    )
    got = {(x.k, x.pos, x.bound): x["rank"] for x in got.collect()}
    want = {}
    for k, pos, bound in cases:
        fits = [i for k2, i, low in points if k2 == k and i <= pos and low <= bound]
        if fits:
            want[k, pos, bound] = max(fits)
    assert got == want
