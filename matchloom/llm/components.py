"""Connected components by alternating large and small stars, in rounds of grouped minima and joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Each node's larger (or else, its smaller) neighbours, linked with the least of its neighbourhood."""
    both = edges.union(edges.select("b", "a")).toDF("u", "v") if large else edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = stored(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
    linked = both.join(least, "u")
    out = linked.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")) if large else linked.select(F.col("v").alias("a"), F.col("m").alias("b")).union(linked.select("u", "m"))
    return out.filter("a != b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, component (its least node) of all nodes with edges; edges: (a, b) longs. Loops and repeated edges do no harm.

    Rounds are stored, and grow with the logarithm of the longest shortest path; a hub's edges are never in one group.
    """
    edges = stored(edges.toDF("a", "b").filter("a != b").distinct(), "edges")
    before = None
    while True:
        edges = stored(_star(stored(_star(edges, True), "large-star"), False), "small-star")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
