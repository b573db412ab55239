"""Connected components of an edge table by alternating star contraction.

Large star: every node hands its larger neighbours to the smallest one it knows; small
star: it hands its smaller neighbours and itself over.  Every round is joins and
map-side combined minima on Spark; the rounds needed grow with the logarithm of the
longest chain.  Nothing is gathered per node, and the minimum of a hub with a third of
all edges is broadcast, so its edges stay where they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesforge.llm.common import join_groups, settled


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b; any orderable type) but the roots
    themselves; root is the smallest node of the component."""
    now = settled(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                  .distinct())
    before = _state(now)
    while before[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"), F.count(F.lit(1)).alias("edges"))
        # every larger neighbour v of u gets the smallest of u's neighbourhood
        large = (join_groups(now.select(F.col("b").alias("u"), F.col("a").alias("v")), least.withColumnRenamed("a", "u"), ["u"], "edges")
                 .select(F.col("v").alias("a"), F.col("m").alias("b")).distinct())
        large = settled(large)
        low = settled(large.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("edges")))
        small = (join_groups(large, low, ["a"], "edges").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(low.select("a", F.col("m").alias("b"))).distinct())
        now = settled(small)
        after = _state(now)
        if after == before:
            break
        before = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
