"""Connected components of a distributed edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagtrend.llm.store import stage


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest of the node and its neighbours."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(lowest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    lowest = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(lowest, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(lowest.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, a: str, b: str, name: str) -> DataFrame:
    """(node, root): the smallest node reachable from each node that has a link to another.

    Nulls and self-links are ignored. Each round aggregates minima with map-side combining and joins them back, so a
    node with any number of links is no single task's burden; rounds are written to the shared folder and only a
    count and a checksum reach the driver.
    """
    pair = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct()
    pair = stage(pair, f"{name}-links")
    before = None
    while True:
        now = pair.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.hash("u", "v").cast("long"))).first()
        if now == before or not now[0]:
            return pair.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now
        pair = stage(_small_star(_large_star(pair)), f"{name}-links")
