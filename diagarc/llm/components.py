"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from diagarc.llm.common import discard, staged


def _stars(pairs: DataFrame) -> DataFrame:
    """Every pair (u, v) with the smallest of u and its neighbours."""
    least = pairs.groupBy("u").agg(F.least("u", F.min("v")).alias("least"))
    return pairs.join(least, "u")


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node that edges (u, v) lead to, for every node with an edge to another.

    Each step keeps at most as many edges as there were and hangs nodes below smaller neighbours;
    a logarithmic number of rounds ends with stars. Nodes are bigints; null ends and loops are
    ignored. Every round is written to the shared folder and the one before deleted; the driver only sees two sums.
    """
    edges = staged(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    seen = None
    while True:
        sums = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if sums == seen or not sums[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
        seen = sums
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _stars(both).filter("v > u").select(F.col("v").alias("u"), F.col("least").alias("v")).distinct()
        hung = _stars(large)
        small = hung.filter("v <> least").select(F.col("v").alias("u"), F.col("least").alias("v"))
        before, edges = edges, staged(small.unionByName(hung.select("u", F.col("least").alias("v"))).distinct(), "edges")
        discard(before)
