"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.common import stage


def _minimum(both: DataFrame) -> DataFrame:
    """Each node and the least of itself and its neighbours. Staged, so that the join after it can split a hot node."""
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    return stage(least.select("u", F.least("u", "m").alias("m")))


def components(edges: DataFrame) -> DataFrame:
    """Labels (node, root) of every node in an edge table (u, v) of longs; root is the least node of the component.

    Every round joins the edges with each node's least neighbour and writes the
    new edges to the shared folder; the number of rounds grows as the logarithm
    of the longest path. No component is ever gathered in one task. An empty
    table gives an empty result; loops and repeated edges do no harm.
    """
    now = stage(edges.select("u", "v").where("u <> v").distinct())
    summary = F.struct(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")))
    seen = now.select(summary.alias("s")).first().s
    while seen[0]:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_minimum(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stage(large.where("u <> v").distinct())
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        joined = down.join(_minimum(down), "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(joined.select("u", F.col("m").alias("v")))
        now = stage(small.where("u <> v").distinct())
        new = now.select(summary.alias("s")).first().s
        if new == seen:
            break
        seen = new
    roots = now.groupBy("u").agg(F.min("v").alias("root"))
    return stage(
        roots.select(F.col("u").alias("node"), "root").union(
            now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
        )
    )
