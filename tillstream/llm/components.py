"""Connected components of a link table, as Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.llm import common


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for each node of ``links(a, b)``; the root is the smallest node reachable.

    Alternates two steps until nothing changes: every larger neighbour of a node is hung under the
    node's smallest neighbour, then every smaller one. Each step is a minimum per node, merged before
    the shuffle, and a join that adaptive execution may split, so a node with very many links is
    spread. Every step is written to the shared folder. Only a count and a sum reach the driver.
    """
    edges = common.stage(
        links.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).filter("hi > lo").distinct(),
        "links",
    )
    before = None
    while True:
        both = edges.select(F.col("hi").alias("node"), F.col("lo").alias("near")).union(
            edges.select(F.col("lo").alias("node"), F.col("hi").alias("near"))
        )
        least = both.groupBy("node").agg(F.least(F.min("near"), F.col("node")).alias("least"))
        large = (
            edges.select(F.col("lo").alias("node"), F.col("hi").alias("near"))
            .union(edges.select(F.col("hi").alias("node"), F.col("hi").alias("near")))
            .join(least, "node")
            .select(F.col("near").alias("hi"), F.col("least").alias("lo"))
            .filter("hi > lo")
            .distinct()
        )
        large = common.stage(large, "large")
        least = large.groupBy("hi").agg(F.min("lo").alias("least"))
        hung = large.join(least, "hi").select(F.col("lo").alias("hi"), F.col("least").alias("lo"))
        edges = common.stage(
            hung.union(least.select("hi", F.col("least").alias("lo"))).filter("hi > lo").distinct(), "small"
        )
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = edges.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
    return roots.union(roots.select(F.col("root").alias("node"), "root").distinct())
