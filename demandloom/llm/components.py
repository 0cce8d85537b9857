"""Connected components of a graph of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.llm.common import drop_staged, staged


def _digest(edges: DataFrame) -> tuple:
    """Count and an order-free checksum, equal when nothing changes any more."""
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(links: DataFrame) -> DataFrame:
    """node and root (the smallest node of its component) for every node of the links (columns u, v).

    Each round ties the larger neighbours of every node to the smallest one, then the smaller ones; rounds grow with the
    logarithm of the longest path. Minima are pre-aggregated and the joins on a node can be split where it is a hub.
    """
    edges = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v").distinct()
    edges = staged(edges, "links")
    last = _digest(edges)
    while last[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = staged(large.distinct(), "links")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        new = staged(small, "links")
        drop_staged(edges)
        drop_staged(large)
        now = _digest(new)
        edges, done = new, now == last
        last = now
        if done:
            break
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
