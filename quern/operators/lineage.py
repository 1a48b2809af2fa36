"""Evidence graphs: closure of edges, and which inputs a derived row stands on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.session import staged


def closure(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(a, b, hops): every pair joined by a path, with its least length.

    Each round lengthens the pairs found in the last one by an edge and keeps those
    that no shorter path joins, until there are none: a pair is written once,
    however many paths join it, so diamonds and cycles do no harm. Rounds are as
    many as the longest least path, and each ends in the shared folder.
    """
    step = staged(edges.select(F.col(a).alias("_from"), F.col(b).alias("_to")).where("_from is not null and _to is not null").distinct())
    found = front = step.withColumn("hops", F.lit(1))
    while True:
        longer = front.select(F.col("_from").alias("_start"), F.col("_to").alias("_via"), "hops").join(step, F.col("_via") == F.col("_from"))
        longer = longer.select(F.col("_start").alias("_from"), "_to", (F.col("hops") + 1).alias("hops")).distinct()
        front = staged(longer.join(found.select("_from", "_to"), ["_from", "_to"], "left_anti"))
        if front.isEmpty():
            return found.select(F.col("_from").alias(a), F.col("_to").alias(b), "hops")
        found = found.unionByName(front)
