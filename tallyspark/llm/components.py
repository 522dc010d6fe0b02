"""Connected components of an edge table by large-star / small-star rounds.

Every round is two groupings by vertex with a minimum (partial sums before
the shuffle) and a join back; AQE splits the join of a vertex with many
edges.  Each round is stored in the shared folder, and the rounds end when the
edges stay as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import store


def _star(arcs: DataFrame) -> DataFrame:
    """Arcs ``u, v`` with the least vertex ``m`` among u and its v."""
    least = arcs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return arcs.join(least, "u")


def components(edges: DataFrame) -> DataFrame:
    """``vertex, component`` (its least vertex) for every vertex with an edge
    ``a, b`` to another; loops and repeated edges change nothing."""
    def stamp(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first())

    edges = store(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                  .distinct(), "cc")
    before = stamp(edges)
    while True:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        large = _star(both).where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b")
        down = large.distinct().select(F.col("a").alias("u"), F.col("b").alias("v"))
        small = _star(down)
        small = small.select(F.col("v").alias("a"), F.col("m").alias("b")).union(
            small.select(F.col("u").alias("a"), F.col("m").alias("b")))
        edges = store(small.where("a <> b").distinct(), "cc")
        now = stamp(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("vertex"), F.col("b").alias("component")).union(
        edges.select(F.col("b").alias("vertex"), F.col("b").alias("component")).distinct())
