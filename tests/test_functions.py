"""Column functions on literal rows."""

import pytest
from pyspark.sql import functions as F

from tillstream.functions import clock, money, text
from tillstream.operators import recon


def one(spark, column, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()] or [F.lit(1)])
    return row.select(column).first()[0]


@pytest.mark.parametrize(
    "amount, kind, pct, fixed, floor, cap, expected",
    [
        (9900, "percent", 0.03, 0, 0, 500000, 297),
        (100, "percent", 0.025, 0, 0, 500000, 3),
        (-100, "percent", 0.025, 0, 0, 500000, -2),
        (0, "percent", 0.03, 0, 100, 500000, 100),
        (99_999_999, "percent", 0.05, 0, 0, 500000, 500000),
        (99_999_999, "percent", 0.05, 0, 0, 0, 5_000_000),
        (5000, "fixed", 0.03, 50, 100, 500000, 100),
        (5000, "fixed", 0.03, 50, 0, 500000, 50),
        (5000, "tiered", 0.02, 7, 0, 500000, 107),
        (5000, "percent", 0.02, 0, 700, 500, 500),
        (5000, "percent", 0.02, 0, None, None, 100),
    ],
)
def test_fee(spark, amount, kind, pct, fixed, floor, cap, expected):
    col = money.fee(
        F.lit(amount), F.lit(kind), F.lit(pct), F.lit(fixed),
        F.lit(floor).cast("bigint"), F.lit(cap).cast("bigint"),
    )
    assert one(spark, col) == expected


@pytest.mark.parametrize(
    "count, amount, status, label",
    [
        (1, 5, 2, "data_loss"),
        (-1, -5, 2, "data_duplicate"),
        (0, 5, 2, "amount_mismatch"),
        (1, -5, 2, "unknown"),
        (1, 0, 2, "unknown"),
        (None, 5, 2, "unknown"),
        (1, -5, 0, "pending"),
    ],
)
def test_diff_analysis(spark, count, amount, status, label):
    col = recon.diff_analysis(F.lit(count).cast("bigint"), F.lit(amount), F.lit(status))
    assert one(spark, col) == label


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Tokyo"])
def test_wall_clock_ignores_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        ms = F.lit(1710576896007)
        row = spark.range(1).select(
            clock.clock_text(ms).alias("t"),
            clock.stat_date(ms).cast("string").alias("d"),
            clock.stat_minute(ms).cast("string").alias("m"),
            clock.stat_hour(ms).alias("h"),
            clock.clock_text_seconds(ms).alias("s"),
            # half past two does not exist on this day in New York
            clock.clock_text(F.lit(1710009000000)).alias("gap"),
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert row.t == "2024-03-16 16:14:56.007"
    assert row.d == "2024-03-16"
    assert row.m == "2024-03-16 16:14:00"
    assert row.h == 16
    assert row.s == "2024-03-16 16:14:56"
    assert row.gap == "2024-03-10 02:30:00.000"


def test_ntz_to_ms(spark):
    ts = F.expr("timestamp_ntz'2024-03-10 02:30:00.123987'")
    assert one(spark, clock.ntz_to_ms(ts)) == 1710037800123


def test_buckets_of_negative_times(spark):
    assert one(spark, clock.floor_ms(F.lit(-1), 1000)) == -1000
    assert one(spark, clock.bucket(F.lit(-1), 1000)) == -1


@pytest.mark.parametrize(
    "delay, tier",
    [(-5, "le_30s"), (30_000, "le_30s"), (30_001, "le_10m"), (600_000, "le_10m"),
     (21_600_000, "le_6h"), (172_800_000, "le_48h"), (172_800_001, "beyond"), (None, None)],
)
def test_delay_tier(spark, delay, tier):
    ingest = F.lit(None if delay is None else 1000 + delay).cast("bigint")
    assert one(spark, clock.delay_tier(F.lit(1000), ingest)) == tier


def test_corrected_time(spark):
    hour = 3_600_000
    cases = [
        (10 * hour, 10 * hour, "normal", 10 * hour),
        (18 * hour, 10 * hour, "normal", 10 * hour),
        (17 * hour, 10 * hour, "normal", 17 * hour),
        (10 * hour, 30 * hour, "suspect", 2 * hour),
        (10 * hour, None, None, 10 * hour),
    ]
    df = spark.createDataFrame(cases, "e long, i long, f string, want long")
    got = df.select(
        clock.corrected_time(F.col("e"), F.col("i"), F.col("f")).alias("got"), "want"
    ).collect()
    assert all(r.got == r.want for r in got)


def test_text_helpers(spark):
    df = spark.createDataFrame([(" a ",), ("",), (" \t\n",), (None,)], "c string")
    got = df.select(
        text.normalize(F.col("c"), "unknown").alias("n"),
        text.is_blank(F.col("c")).alias("b"),
        text.is_blank(F.col("c"), strict=True).alias("s"),
        text.first_non_blank(F.col("c"), F.lit(" z ")).alias("f"),
    ).collect()
    assert [r.n for r in got] == ["a", "unknown", "unknown", "unknown"]
    assert [r.b for r in got] == [False, True, True, True]
    assert [r.s for r in got] == [False, True, False, True]
    assert [r.f for r in got] == ["a", "z", "z", "z"]


def test_yuan_and_share(spark):
    assert str(one(spark, money.yuan(F.lit(210118581)))) == "2101185.81"
    assert str(one(spark, money.yuan(F.lit(-5)))) == "-0.05"
    assert one(spark, money.ppm(F.lit(1), F.lit(3))) == 333333
    assert one(spark, money.ppm(F.lit(1), F.lit(0))) is None


def test_correction_legs(spark):
    legs = one(spark, money.correction_legs(F.lit(9900), F.lit(297)))
    assert tuple(legs) == (-9900, -297, -9603)
