"""Connected components by alternating large-star and small-star steps over an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a vertex is tied to the smallest vertex around it."""
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("x"), F.least("u", "m").alias("m"))
    return (both.join(least, F.col("u") == F.col("x")).filter(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """A vertex and its smaller neighbours are tied to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "x")
    down = edges.join(least, F.col("u") == F.col("x"))
    return (down.select(F.col("u"), F.col("m").alias("v"))
            .unionAll(down.filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct())


def connected_components(edges: DataFrame) -> DataFrame:
    """(u, v) pairs -> (vertex, component): the smallest vertex reachable, for every vertex of an edge.

    Loops, repeated and reversed edges and nulls are harmless (edges with a null are dropped).  Each round is
    aggregations and equi-joins over edges, cut by a reliable checkpoint, after which its shuffle files go; only two sums per round
    reach the driver.
    """
    ordered = edges.filter("u IS NOT NULL AND v IS NOT NULL").select("u", "v")
    e = ordered.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u != v").distinct()
    stars, before = cut(e), None
    while True:
        state = stars.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == before or state[0] == 0:
            break
        before = state
        stars = cut(_small_star(_large_star(stars)))
    roots = stars.select(F.col("v").alias("vertex"), F.col("v").alias("component")).distinct()
    return stars.select(F.col("u").alias("vertex"), F.col("v").alias("component")).unionAll(roots)
