"""Connected components of a table of links: union-find as alternating large and small stars.

Each round is a few joins and aggregations on the links alone; nothing but two totals reaches the driver. The number of rounds
grows with the logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._tables import stored


def _least(edges: DataFrame) -> DataFrame:
    """Links (u, v) with m, the least of u and its neighbours."""
    return edges.join(edges.groupBy("u").agg(F.min("v").alias("m")), "u").withColumn("m", F.least("u", "m"))


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): the least node that each linked node reaches; nodes without links to others are left out."""
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u != v").distinct()
    edges, before = stored(edges, "links"), None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        own = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(own, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").union(own.select("u", "m")).distinct()
        edges = stored(small.toDF("u", "v"), "links", after=(edges,))
        # changed? the links' number and the sum of their hashes tell
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(edges.select("v", "v").distinct())
        before = now
