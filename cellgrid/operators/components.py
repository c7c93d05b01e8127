"""Connected components by alternating large-star and small-star steps over an edge table."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: vertices that a task remembers while it ties its own edges together
LOCAL_VERTICES = 1_000_000


def _stars(parent: dict, schema: pa.Schema) -> pa.RecordBatch:
    """Every vertex with the smallest one that it is tied to."""
    for x in parent:
        root = x
        while parent[root] != root:
            root = parent[root]
        while parent[x] != root:
            parent[x], x = root, parent[x]
    pairs = [(x, root) for x, root in parent.items() if x != root]
    return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], schema.field(k).type) for k in (0, 1)], schema=schema)


def _within_tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edges of a task replaced by stars that connect the same vertices, ``LOCAL_VERTICES`` and a batch at a time."""
    parent, schema = {}, None
    for b in batches:
        schema = b.schema
        for u, v in zip(b.column("u").to_pylist(), b.column("v").to_pylist(), strict=True):
            u, v = parent.setdefault(u, u), parent.setdefault(v, v)
            while parent[u] != u:
                parent[u] = u = parent[parent[u]]
            while parent[v] != v:
                parent[v] = v = parent[parent[v]]
            if u < v:
                parent[v] = u
            else:
                parent[u] = v
        if len(parent) > LOCAL_VERTICES:
            yield _stars(parent, schema)
            parent = {}
    if parent:
        yield _stars(parent, schema)


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

    Loops, repeated and reversed edges and nulls are harmless (edges with a null are dropped).  Edges of neighbouring vertices meet in
    one task, which first ties them together as stars, so that rounds are needed for what lies between tasks only.  Each round is
    aggregations and equi-joins over edges, cut by a reliable checkpoint; only two sums per round reach the driver.
    """
    ordered = edges.filter("u IS NOT NULL AND v IS NOT NULL").select("u", "v")
    e = ordered.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u != v").distinct()
    near = e.repartitionByRange("u", "v").mapInArrow(_within_tasks, e.schema)
    near = near.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    stars, before = near.checkpoint(), None
    while True:
        state = stars.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == before or state[0] == 0:
            break
        before = state
        stars = _small_star(_large_star(stars)).checkpoint()
    roots = stars.select(F.col("v").alias("vertex"), F.col("v").alias("component")).distinct()
    return stars.select(F.col("u").alias("vertex"), F.col("v").alias("component")).unionAll(roots)
