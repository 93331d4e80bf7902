"""Connected components of links between ids, by alternating large and small stars (shuffled joins only)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tripweave.session import stored


def _mark(edges: DataFrame):
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame, u: str, v: str) -> DataFrame:
    """(id, root): every linked id with the smallest id of its component.

    Each round hangs ids nearer to their smallest known neighbour; the edges end
    as stars around the roots.  The rounds grow with the logarithm of the
    longest chain.  Every round is stored, none is collected.
    """
    edges = stored(links.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).filter("u <> v").distinct(), "edges")
    before = _mark(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        edges = stored(hung.filter("u <> v").distinct(), "edges")
        now = _mark(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("id"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("id"), F.col("v").alias("root")).distinct())
