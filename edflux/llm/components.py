"""Connected components of a link table, on the executors only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edflux.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(a, b) links of ids (of any ordered type, not null) -> node, root (the smallest id reachable), for every linked node.

    Alternating stars: each round points the larger neighbours of every node, then the smaller
    ones, at the least id seen. Rounds grow with the logarithm of a component's size. All steps
    are hash aggregates and joins on stored tables; links are never gathered per node.
    """
    edges = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "links")
    sign = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))).alias("e"))
        edges = stored(small.select("e.u", F.col("e.m").alias("v")).where("u <> v").distinct(), "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == sign:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        sign = now
