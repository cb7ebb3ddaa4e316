"""Order-dependent computations that never gather a key in one task.

Rows are first reduced to points (key, time); points are split into time blocks.
A block holds a bounded number of points, and only one carry row per block
crosses block borders, so a key with a third of all rows is still spread.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstream.functions import clock
from tillstream.operators.skew import fits_broadcast, lookup_join
from tillstream.session import stage


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per key: the one with the greatest ``order_by``.

    ``max`` of a struct merges on the map side, so many copies of one key
    shrink to one row per task before the shuffle. Columns outside
    ``order_by`` break ties, so the result is the same on every run.
    """
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    top = df.groupBy(*keys).agg(F.max(F.struct(*order_by, *rest)).alias("_top"))
    return top.select(
        *[F.col(c) if c in keys else F.col(f"_top.{c}").alias(c) for c in df.columns]
    )


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows whose key no other row has, and all others. ``df`` is computed three times.

    Only hashes of the keys are shuffled and counted, so rows that need no choice between them are neither
    sorted nor shuffled here; rows that only share a hash are among the others. Repeated hashes are broadcast
    when they measure small, else joined.
    """
    mark = F.xxhash64(*keys)
    more = df.groupBy(mark.alias("_mark")).agg(F.count("*").alias("_rows")).where("_rows > 1").select("_mark")
    more = stage(more, "repeated")
    known = F.broadcast(more) if fits_broadcast(more) else more
    marked = df.withColumn("_mark", mark)
    return tuple(marked.join(known, "_mark", kind).drop("_mark") for kind in ("left_anti", "left_semi"))


#: Blocks that :func:`running` adds up together.
GROUP_BLOCKS = 4_096

_MERGE = {"sum": F.sum, "max": F.max}


def _merge_values(kind: str, a: Column, b: Column) -> Column:
    if kind == "max":
        return F.greatest(a, b)
    return F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))


def running(
    df: DataFrame,
    keys: Sequence[str],
    at: str,
    values: dict[str, tuple[Column, str]],
    block: int = 10_000,
    levels: int = 1,
) -> DataFrame:
    """Running ``sum`` or ``max`` by ``keys`` in order of the whole number ``at``.

    What stands before a block is a running value over the blocks, found in the same way from groups of
    ``GROUP_BLOCKS`` blocks, so no task sorts all blocks of a key: one more of ``levels`` allows that many times as many.

    Result: one row per (keys, at) with each value of the point itself (``x``),
    over all strictly earlier points (``x_before``), and up to and including
    the point (``x_upto``).
    """
    keys = list(keys)
    points = (
        df.groupBy(*keys, at)
        .agg(*[_MERGE[kind](c).alias(n) for n, (c, kind) in values.items()])
        .withColumn("_block", clock.bucket(F.col(at), block))
    )
    per_block = points.groupBy(*keys, "_block").agg(
        *[_MERGE[kind](n).alias(n) for n, (_, kind) in values.items()]
    )
    if levels:
        same = {n: (F.col(n), kind) for n, (_, kind) in values.items()}
        groups = per_block.withColumnRenamed("_block", "_at")
        before_block = running(groups, keys, "_at", same, GROUP_BLOCKS, levels - 1)
        before_block = before_block.select(*keys, F.col("_at").alias("_block"), *[F.col(f"{n}_before").alias(n) for n in values])
    else:
        earlier = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
        before_block = per_block.select(
            *keys, "_block", *[_MERGE[kind](n).over(earlier).alias(n) for n, (_, kind) in values.items()]
        )
    carry = before_block.select(*keys, F.lit(None).cast("long").alias(at), *values, "_block")
    # The carry row sorts first in its block because its position is null.
    before = (
        Window.partitionBy(*keys, "_block")
        .orderBy(F.col(at).asc_nulls_first())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    result = points.unionByName(carry).select(
        *keys,
        at,
        *values,
        *[_MERGE[kind](n).over(before).alias(f"{n}_before") for n, (_, kind) in values.items()],
    )
    return result.where(F.col(at).isNotNull()).select(
        "*",
        *[
            _merge_values(kind, F.col(f"{n}_before"), F.col(n)).alias(f"{n}_upto")
            for n, (_, kind) in values.items()
        ],
    )


def following(
    df: DataFrame, keys: Sequence[str], at: str, name: str, block: int = clock.DAY_MS
) -> DataFrame:
    """Add ``name``: the next ``at`` of the same key, null for the last one.

    ``at`` is unique per key. The first time of the next block stands in each
    block as a marker row, so no key is sorted in one piece.
    """
    keys = list(keys)
    rows = df.withColumn("_block", clock.bucket(F.col(at), block))
    firsts = rows.groupBy(*keys, "_block").agg(F.min(at).alias("_first"))
    by_block = Window.partitionBy(*keys).orderBy("_block")
    markers = firsts.select(
        *keys, "_block", F.lead("_first").over(by_block).alias(at), F.lit(True).alias("_marker")
    ).where(F.col(at).isNotNull())
    within = Window.partitionBy(*keys, "_block").orderBy(at)
    return (
        rows.unionByName(markers, allowMissingColumns=True)
        .withColumn(name, F.lead(at).over(within))
        .where("_marker is null")
        .drop("_block", "_marker")
    )


def with_next_block(points: DataFrame, at: str, width: int) -> DataFrame:
    """Copy each point into its own block and, as history, into the next one."""
    own = clock.bucket(F.col(at), width)
    return points.select(
        "*", own.alias("_own"), F.explode(F.array(own, own + 1)).alias("_block")
    )


def _changes(spans: DataFrame, keys: Sequence[str], at: str, deltas: dict[str, Column]) -> DataFrame:
    """Entry at ``_from`` and exit at ``_until`` as signed changes, summed per time.

    Running sums of the changes give the state of a sliding window without
    visiting the window again for every row.
    """
    def edge(when: str, sign: int, asked: Column) -> Column:
        return F.struct(
            F.col(when).alias(at),
            *[(c * sign).alias(n) for n, c in deltas.items()],
            asked.alias("_asked"),
        )

    own = F.col("_own") == F.col("_block")
    edges = spans.select(
        *keys,
        "_block",
        F.inline(F.array(edge("_from", 1, own), edge("_until", -1, F.lit(False)))),
    )
    steps = edges.groupBy(*keys, "_block", at).agg(
        *[F.sum(n).alias(n) for n in deltas], F.max("_asked").alias("_asked")
    )
    w = (
        Window.partitionBy(*keys, "_block")
        .orderBy(at)
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        steps.select(
            *keys, at, "_asked", *[F.sum(n).over(w).cast("long").alias(n) for n in deltas]
        )
        .where("_asked")
        .drop("_asked")
    )


def rolling_sums(
    df: DataFrame, entity: str, at: str, width: int, sums: dict[str, Column]
) -> DataFrame:
    """Sums over ``[at - width, at]`` per entity, one row per (entity, at)."""
    points = df.groupBy(entity, at).agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    spans = with_next_block(points, at, width).select(
        entity,
        *sums,
        "_own",
        "_block",
        F.col(at).alias("_from"),
        (F.col(at) + width + 1).alias("_until"),
    )
    return _changes(spans, [entity], at, {n: F.col(n) for n in sums})


def rolling_distinct(
    df: DataFrame, entity: str, value: str, at: str, width: int, name: str
) -> DataFrame:
    """Exact distinct ``value`` per entity over ``[at - width, at]``.

    A value is present from each occurrence until ``width`` later or until its
    next occurrence. Presence changes add up as a running sum, without sets.
    """
    points = df.groupBy(entity, value, at).agg(F.lit(1).alias("_one"))
    seen = Window.partitionBy(entity, "_block", value).orderBy(at)
    spans = with_next_block(points, at, width).select(
        entity,
        "_own",
        "_block",
        F.col(at).alias("_from"),
        F.least(F.lead(at).over(seen), F.col(at) + width + 1).alias("_until"),
    )
    return _changes(spans, [entity], at, {name: F.lit(1)})


def quantiles(df: DataFrame, keys: Sequence[str], value: str, percents: Sequence[int]) -> DataFrame:
    """Exact discrete quantiles of a whole-number column per key.

    The p-quantile is the smallest value with at least ceil(p * n / 100) values
    up to it, read from running counts by value.
    """
    known = df.where(F.col(value).isNotNull())
    ranks = running(known, keys, value, {"n": (F.lit(1), "sum")})
    totals = known.groupBy(*keys).agg(F.count("*").alias("_total"))
    joined = lookup_join(ranks, totals, list(keys), derived=True)
    return joined.groupBy(*keys).agg(
        *[
            F.min(
                F.when(
                    F.col("n_upto") >= F.ceil(F.col("_total") * p / 100.0).cast("long"),
                    F.col(value),
                )
            ).alias(f"p{p}")
            for p in percents
        ]
    )
