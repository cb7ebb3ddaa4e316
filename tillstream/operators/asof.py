"""As-of lookup: the latest dimension row at or before the time of a fact."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillstream.functions import clock
from tillstream.operators.ordered import following
from tillstream.operators.skew import lookup_join, salted_join
from tillstream.session import stage


def intervals(
    dim: DataFrame, keys: Sequence[str], at: str, version: str | None = None
) -> DataFrame:
    """Validity ``[valid_from, valid_to)`` per key; ``valid_to`` null is open.

    Of rows of one key with the same time only the highest ``version`` stays.
    """
    others = [c for c in dim.columns if c not in keys and c != at]
    lead = [version] if version else []
    rest = [c for c in others if c not in lead]
    one = dim.groupBy(*keys, at).agg(F.max(F.struct(*lead, *rest)).alias("_row"))
    return following(one, keys, at, "valid_to").select(
        *keys,
        F.col(at).alias("valid_from"),
        "valid_to",
        *[F.col(f"_row.{c}").alias(c) for c in others],
    )


def merge_points(
    probes: DataFrame, steps: DataFrame, keys: Sequence[str], block_ms: int, before_first: str = "null"
) -> DataFrame:
    """Probes (``keys, _t``), steps (``keys, _t, _row``) and one carry row for each block of time, in one table.

    Within a block, sorted by ``_t`` with ``_order`` deciding ties, the last ``_row`` up to a probe is its answer: carry rows bring
    what was in force when the block began (with ``before_first="first"`` the first step of the key before there is any).
    There are as many rows as probes, steps and blocks together.
    """
    empty = F.lit(None).cast(steps.schema["_row"].dataType)
    points = steps.select(*keys, "_t", F.lit(1).alias("_order"), "_row").unionByName(
        probes.select(*keys, "_t", F.lit(2).alias("_order"), empty.alias("_row"))
    )
    points = points.withColumn("_block", clock.bucket(F.col("_t"), block_ms))
    step_time = F.when(F.col("_order") == 1, F.col("_t"))
    blocks = points.groupBy(*keys, "_block").agg(
        F.max_by("_row", step_time).alias("_last"), F.min_by("_row", step_time).alias("_first")
    )
    by_block = Window.partitionBy(*keys).orderBy("_block")
    row = F.last("_last", ignorenulls=True).over(by_block.rowsBetween(Window.unboundedPreceding, -1))
    if before_first == "first":
        every = by_block.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        row = F.coalesce(row, F.first("_first", ignorenulls=True).over(every))
    carry = blocks.select(
        *keys, F.lit(None).cast("bigint").alias("_t"), F.lit(0).alias("_order"), row.alias("_row"), "_block"
    )
    return points.unionByName(carry)


def asof_lookup(
    facts: DataFrame,
    dim: DataFrame,
    keys: Sequence[str],
    fact_time: str,
    dim_time: str,
    name: str,
    version: str | None = None,
    before_first: str = "null",
    block_ms: int = clock.HOUR_MS,
) -> DataFrame:
    """Add struct column ``name``: the dimension row in force at ``fact_time``.

    A merge: the distinct (keys, time) of the facts and the dimension rows are sorted together in blocks of time, so
    a fact meets one row whatever the number of versions, and a hot key is spread over its blocks. The answers, at most one for each
    distinct (keys, time), are joined back: broadcast when they measure small, else by a salted shuffle.
    Of dimension rows of one key and time the highest ``version`` counts; null keys and times find nothing.
    ``before_first`` is ``null`` or ``first``.
    """
    keys = list(keys)
    others = [c for c in dim.columns if c not in keys and c != dim_time]
    lead = [version] if version else []
    one = dim.where(F.col(dim_time).isNotNull()).groupBy(*keys, dim_time).agg(
        F.max(F.struct(*lead, *[c for c in others if c not in lead])).alias("_top")
    )
    row = F.struct(F.col(dim_time), *[F.col(f"_top.{c}").alias(c) for c in others])
    steps = stage(one.select(*keys, F.col(dim_time).cast("bigint").alias("_t"), row.alias("_row")), "steps")
    probes = facts.select(*keys, F.col(fact_time).cast("bigint").alias("_t")).dropna().distinct()
    points = merge_points(stage(probes, "probes"), steps, keys, block_ms, before_first)
    upto = (
        Window.partitionBy(*keys, "_block")
        .orderBy(F.col("_t").asc_nulls_first(), "_order")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    answers = points.withColumn(name, F.last("_row", ignorenulls=True).over(upto))
    answers = answers.where((F.col("_order") == 2) & F.col(name).isNotNull())
    answers = answers.select(*keys, F.col("_t").alias(fact_time), name)
    return lookup_join(facts, answers, [*keys, fact_time], derived=True).select(*facts.columns, name)


def last_below(
    cases: DataFrame, points: DataFrame, key: str, fanout: int = 64
) -> DataFrame:
    """For each case (key, pos, bound): the greatest ``rank <= pos`` with ``low <= bound``.

    ``points`` has (key, rank, low). Ranks are grouped by ``fanout`` into blocks,
    blocks into larger blocks, each with its smallest ``low``. A case looks at
    the ranks of its own block, then at whole blocks before it, level by level,
    and then down into the block it found. So it meets at most ``fanout`` rows
    per step and never all points of its key. Result: (key, pos, bound, rank).
    """
    case = [key, "pos", "bound"]
    group = F.call_function("div", F.col("rank"), F.lit(fanout))
    tree = [points.groupBy(key, "rank").agg(F.min("low").alias("low"))]
    top = points.agg(F.max("rank")).first()[0] or 0
    while fanout ** len(tree) <= top:
        tree.append(tree[-1].groupBy(key, group.alias("rank")).agg(F.min("low").alias("low")))

    def best(level: int, parents: DataFrame, limit: bool) -> DataFrame:
        members = tree[level].select(key, group.alias("parent"), "rank", "low")
        near = lookup_join(parents, members, [key, "parent"], "inner", derived=level > 0)
        fits = F.col("low") <= F.col("bound")
        if limit:
            fits = fits & (F.col("rank") < F.col("limit"))
        return near.where(fits).groupBy(*case).agg(F.max("rank").alias("rank"))

    open_cases = cases.select(*case, (F.col("pos") + 1).alias("limit")).withColumn(
        "parent", F.call_function("div", F.col("pos"), F.lit(fanout))
    )
    hits = []
    for level in range(len(tree)):
        hits.append(best(level, open_cases, limit=True))
        if level + 1 < len(tree):
            hits[level] = stage(hits[level], "hits")
            open_cases = stage(
                salted_join(open_cases, hits[level].select(*case), case, "left_anti").select(
                    *case,
                    F.col("parent").alias("limit"),
                    F.call_function("div", F.col("parent"), F.lit(fanout)).alias("parent"),
                ),
                "open",
            )
    found = hits.pop()
    while hits:
        inside = best(len(hits) - 1, found.withColumnRenamed("rank", "parent"), limit=False)
        found = inside.unionByName(hits.pop())
    return found
