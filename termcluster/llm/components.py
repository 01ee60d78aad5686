"""Connected components of a link table, by alternating star contractions.

Each round points every node and its neighbours to their smallest common
neighbour, first among the larger nodes, then among the smaller ones. A round
is two pre-aggregated minima and two joins with files on either side, so a
node with very many links is split by adaptive execution. Rounds grow with
the logarithm of the longest chain; nothing but two numbers reaches the
driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termcluster.llm.shared import scratch


def components(links: DataFrame) -> DataFrame:
    """node, label (smallest node that it reaches) for the nodes of links (a, b)."""
    def state(e: DataFrame) -> tuple:
        r = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        return r[0], r[1]

    edges = scratch(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before = state(edges)
    while before[0]:
        both = edges.union(edges.select("v", "u").toDF("u", "v"))
        least = scratch(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = scratch(both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct(), "large")
        root = scratch(large.groupBy("u").agg(F.min("v").alias("m")), "root")
        small = large.join(root, "u").select("u", "v", "m")
        edges = scratch(small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", "m")).filter("u <> v").distinct(), "edges")
        after = state(edges)
        if after == before:
            break
        before = after
    roots = edges.select("v").distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).union(roots.select("v", "v"))
