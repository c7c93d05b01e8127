"""Neighbour graph: lattice edges, degree, PageRank, betweenness, drill-in.

All algorithms are DataFrame loops (join + aggregate per round), so vertex and
edge tables stay partitioned across the cluster; only one number per round
(convergence error, frontier size) reaches the driver.  Lineage is cut with
reliable ``checkpoint()`` into ``spark.checkpoint.dir`` so a lost executor
recomputes at most a few rounds.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import opposite_endpoint
from ..session import delete_path, ensure_checkpoint_dir, scratch_path
from .components import connected_components
from .prefix import global_row_number

CHECKPOINT_EVERY = 4


def neighbor_lattice(cells: DataFrame, k: int = 2) -> DataFrame:
    """Path lattice per region: each cell links to the next ``k`` cells in sorted id order.

    Distributed: a global row number over (region, cell_id) from range-partitioned
    running counts, then an equi-join on (region, idx + d) for d = 1..k.  No window
    holds a whole region, so a region with a third of all cells is still spread out.
    """
    c = cells.select(F.col("region").cast("string").alias("region"),
                     F.col("cell_id").cast("string").alias("cell_id")).dropna(subset=["cell_id"]).distinct()
    ranked = global_row_number(c, [F.col("region").asc_nulls_first(), F.col("cell_id").asc()], "idx")
    src = ranked.select("region", F.col("cell_id").alias("src_cell_id"),
                        F.explode(F.sequence(F.lit(1), F.lit(k))).alias("d"), "idx")
    src = src.withColumn("tgt_idx", F.col("idx") + F.col("d"))
    dst = ranked.select("region", F.col("cell_id").alias("dst_cell_id"), F.col("idx").alias("tgt_idx"))
    edges = src.join(dst, ["region", "tgt_idx"], "inner")
    return edges.select("src_cell_id", "dst_cell_id").distinct()


def undirected(edges: DataFrame, src: str = "src_cell_id", dst: str = "dst_cell_id") -> DataFrame:
    """Simple undirected graph as both directions (u, v): duplicates and reversed pairs collapse, no self loops."""
    e = edges.select(F.col(src).cast("string").alias("a"), F.col(dst).cast("string").alias("b")) \
        .dropna().filter(F.col("a") != F.col("b"))
    canon = e.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct()
    return canon.unionByName(canon.select(F.col("v").alias("u"), F.col("u").alias("v")))


def degree(edges: DataFrame) -> DataFrame:
    adj = undirected(edges)
    return adj.groupBy(F.col("u").alias("cell_id")).agg(F.count(F.lit(1)).alias("neighbor_degree"))


def pagerank(edges: DataFrame, d: float = 0.85, tol: float = 1e-6, max_iter: int = 100) -> DataFrame:
    """PageRank of the undirected graph: start 1/n, stop when the L1 change < n * tol.

    Every vertex has degree >= 1 (vertices come from edges), so there is no dangling mass.
    Per round: join ranks to the adjacency, sum contributions per target, measure the change.
    """
    ensure_checkpoint_dir(edges.sparkSession)
    adj = undirected(edges).cache()
    deg = adj.groupBy("u").agg(F.count(F.lit(1)).cast("double").alias("deg"))
    n = deg.count()
    if n == 0:
        return deg.select(F.col("u").alias("cell_id"), F.lit(0.0).alias("pagerank")).limit(0)
    # cached once, without a fixed partitioning by source: a hub's edges stay where the join left
    # them, and AQE may split a hub in the joins of each round
    out_w = adj.join(deg, "u").select("u", "v", (F.lit(1.0) / F.col("deg")).alias("w")).cache()
    ranks = deg.select("u", F.lit(1.0 / n).alias("rank"))
    base = (1.0 - d) / n
    for i in range(1, max_iter + 1):
        # one aggregate gives the new rank and (through the vertex's own row) the previous one
        sent = out_w.join(ranks, "u").select(F.col("v").alias("u"), (F.col("rank") * F.col("w")).alias("c"),
                                             F.lit(None).cast("double").alias("prev"))
        own = ranks.select("u", F.lit(None).cast("double").alias("c"), F.col("rank").alias("prev"))
        step = sent.unionByName(own).groupBy("u").agg(
            (F.lit(base) + F.lit(d) * F.coalesce(F.sum("c"), F.lit(0.0))).alias("rank"), F.max("prev").alias("prev"))
        # cache every round, reliable checkpoint every few rounds to bound recomputation
        step = step.checkpoint(eager=True) if i % CHECKPOINT_EVERY == 0 else step.cache()
        err = step.agg(F.sum(F.abs(F.col("rank") - F.col("prev")))).first()[0]
        ranks.unpersist()
        ranks = step.select("u", "rank")
        if err < n * tol:
            break
    adj.unpersist()
    out_w.unpersist()
    return ranks.select(F.col("u").alias("cell_id"), F.col("rank").alias("pagerank"))


#: edge visits (sources times edges) that one task of the betweenness takes
BLOCK_WORK = 200_000_000
#: edges (both directions) of the largest component that a task takes whole; larger ones go level by level
TASK_EDGES = 1_000_000
#: rows (source, vertex) of one block of sources in the level-by-level search, over all tasks together
STATE_ROWS = 2_000_000_000
#: states (source, vertex) and edge visits of the sources that a task searches from at once
BATCH_STATES = 6_000_000
BATCH_VISITS = 40_000_000
#: edge visits of one step of such a search
STEP_VISITS = 2_000_000
#: numbers of shortest paths above this are kept as a number and a power of two, in steps of so many bits
MANY_PATHS = 1e200
PATH_BITS = 600


def _brandes(u: np.ndarray, v: np.ndarray, n: int, sources: np.ndarray) -> np.ndarray:
    """Dependencies of the vertices 0 .. n - 1 of one component, summed over ``sources`` (Brandes 2001).

    Several sources are searched from at once, level by level, so that a level is one step of array operations.
    """
    heads = v[np.argsort(u, kind="stable")].astype(np.int64)
    ends = np.searchsorted(np.sort(u), np.arange(n + 1))
    width = max(1, min(BATCH_STATES // n, BATCH_VISITS // max(1, len(heads))))
    total = np.zeros(n)
    for start in range(0, len(sources), width):
        _add_dependencies(heads, ends, sources[start:start + width], total)
    return total


def _unseen(heads: np.ndarray, ends: np.ndarray, x: np.ndarray, base: np.ndarray, slot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place in ``x``, state) of the edges from the states ``base + x`` to unseen ones (``slot`` < 0), some edges at a time."""
    start = ends.take(x)
    degree = ends.take(x + 1) - start
    before = np.cumsum(degree) - degree
    shift = start - before
    cuts = [0, len(x)] if before[-1] < STEP_VISITS else np.append(np.unique(np.searchsorted(before, np.arange(0, before[-1] + 1, STEP_VISITS))), len(x))
    found = []
    for i, j in zip(cuts[:-1], cuts[1:], strict=True):
        place = np.repeat(np.arange(i, j), degree[i:j])
        edge = shift.take(place)
        edge += np.arange(before[i], before[i] + len(place))
        to = heads.take(edge)
        to += base.take(place)
        on = np.flatnonzero(slot.take(to) < 0)
        found.append((place.take(on), to.take(on)))
    return tuple(np.concatenate(c) for c in zip(*found, strict=True)) if len(found) > 1 else found[0]


def _add_dependencies(heads: np.ndarray, ends: np.ndarray, sources: np.ndarray, total: np.ndarray) -> None:
    """Add the dependencies of all vertices on ``sources`` to ``total``.  A state is source number * n + vertex.

    Numbers of paths are ``paths * 2 ** power``; ``power`` is one number as long as all states of a level share it.
    """
    n = len(ends) - 1
    slot = np.full(len(sources) * n, -1, np.int32)
    x, base, paths, power = sources, np.arange(len(sources)) * n, np.ones(len(sources)), 0
    slot[base + x] = 0
    levels = []
    while True:
        place, to = _unseen(heads, ends, x, base, slot)
        if not len(to):
            levels.append((x, paths, power, None, None))
            break
        order = np.arange(len(to), dtype=np.int32)
        slot[to] = order
        first = np.flatnonzero(slot.take(to) == order)  # one edge into each new state
        new = to.take(first)
        slot[new] = order[:len(new)]
        into = slot.take(to)
        levels.append((x, paths, power, place.astype(np.int32), into))
        more = paths.take(place)
        if isinstance(power, np.ndarray):
            came = power.take(place)
            power = np.zeros(len(new), came.dtype)
            np.maximum.at(power, into, came)
            more = np.ldexp(more, came - power.take(into))
        more = np.bincount(into, more, len(new))
        many = more > MANY_PATHS
        if many.any():
            more = np.where(many, np.ldexp(more, -PATH_BITS), more)
            power = power + np.where(many, PATH_BITS, 0).astype(np.int32)
        if isinstance(power, np.ndarray) and (power == power[0]).all():
            power = int(power[0])
        base = base.take(place.take(first))
        x, paths = new - base, more
    _, below, below_power, _, _ = levels.pop()
    credit = np.zeros(len(below))
    while len(levels) > 1:  # the sources themselves get nothing
        x, paths, power, place, into = levels.pop()
        share = ((1 + credit) / below).take(into)
        if isinstance(power, np.ndarray) or isinstance(below_power, np.ndarray):
            shift = np.broadcast_to(power, len(x)).take(place) - np.broadcast_to(below_power, len(below)).take(into)
            credit = np.bincount(place, np.ldexp(paths.take(place) * share, shift), len(x))
        else:
            credit = paths * np.bincount(place, share, len(x))
            if power != below_power:
                credit = np.ldexp(credit, power - below_power)
        np.add.at(total, x, credit)
        below, below_power = paths, power


def _levels(adj: DataFrame, sources: DataFrame, folder: str) -> int:
    """Breadth-first levels of all sources at once: level d holds (s, v, paths) of the vertices d steps from s.

    A neighbour of a vertex is in its own level or in one of the two next to it, so the next level is what the last
    one reaches without itself and the one before.  Each level is written once, whence later steps and lost tasks read it.
    """
    spark = adj.sparkSession
    sources.select(F.col("u").alias("s"), F.col("u").alias("v"), F.lit(1.0).alias("paths")).write.parquet(f"{folder}/level-0")
    depth = 0
    while True:
        last = spark.read.parquet(f"{folder}/level-{depth}")
        seen = last.select("s", "v")
        if depth:
            seen = seen.unionByName(spark.read.parquet(f"{folder}/level-{depth - 1}").select("s", "v"))
        step = (last.join(adj.withColumnRenamed("v", "w"), last["v"] == F.col("u")).groupBy("s", F.col("w").alias("v")).agg(F.sum("paths").alias("paths"))
                .join(seen, ["s", "v"], "left_anti"))
        step.write.parquet(f"{folder}/level-{depth + 1}")
        if spark.read.parquet(f"{folder}/level-{depth + 1}").isEmpty():
            return depth
        depth += 1


def _by_levels(adj: DataFrame, sources: DataFrame, n_blocks: int) -> DataFrame:
    """(u, b): dependencies summed over the sources, by joins with the distributed edge table, one block of sources after the other.

    State is keyed by (source, vertex), so neither a component nor a hub's neighbours need fit in a task.  A block's levels are
    deleted when its sums are written.
    """
    spark = adj.sparkSession
    root = scratch_path(spark, f"betweenness-{uuid.uuid4().hex[:12]}")
    for block in range(n_blocks):
        folder = f"{root}/block-{block}"
        depth = _levels(adj, sources.filter(F.pmod(F.xxhash64("u"), F.lit(n_blocks)) == block), folder)
        below = None
        for d in range(depth, 0, -1):
            here = spark.read.parquet(f"{folder}/level-{d}")
            mine = here.withColumn("credit", F.lit(0.0)) if below is None else (
                here.join(below, ["s", "v"], "left").select("s", "v", "paths", F.coalesce("credit", F.lit(0.0)).alias("credit")))
            mine.write.parquet(f"{folder}/credit-{d}")
            mine = spark.read.parquet(f"{folder}/credit-{d}")
            share = mine.select("s", F.col("v").alias("w"), ((1 + F.col("credit")) / F.col("paths")).alias("share"))
            up = spark.read.parquet(f"{folder}/level-{d - 1}")
            below = (share.join(adj, F.col("w") == F.col("u")).select("s", "v", "share").groupBy("s", "v").agg(F.sum("share").alias("share"))
                     .join(up, ["s", "v"]).select("s", "v", (F.col("paths") * F.col("share")).alias("credit")))
        found = (spark.read.parquet(*[f"{folder}/credit-{d}" for d in range(1, depth + 1)]) if depth
                 else spark.createDataFrame([], "v string, credit double"))
        found.groupBy(F.col("v").alias("u")).agg(F.sum("credit").alias("b")).write.parquet(f"{root}/sums/block={block}")
        delete_path(spark, folder)
    return spark.read.parquet(f"{root}/sums").groupBy("u").agg(F.sum("b").alias("b"))


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packed components (edges as from * 2^32 + to, first id, vertices, sources) -> (id, sum of dependencies)."""
    for b in batches:
        for i in range(b.num_rows):
            edges, sources = (np.asarray(b.column(c)[i].values) for c in ("edges", "sources"))
            low, n = b.column("low")[i].as_py(), b.column("n")[i].as_py()
            total = _brandes(edges >> 32, edges & 0xFFFFFFFF, n, sources)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(low, low + n)), pa.array(total)], names=["id", "b"])


def betweenness(edges: DataFrame, normalized: bool = True, source_fraction: float | None = None,
                seed: int = 7, block_work: int = BLOCK_WORK, task_edges: int = TASK_EDGES, state_rows: int = STATE_ROWS) -> DataFrame:
    """Exact betweenness.  Shortest paths stay inside a component, so work is dealt by component.

    Vertices are numbered.  A component of up to ``task_edges`` edges is packed into one row and goes whole to as many tasks as its work
    needs, each with a block of sources (as many as ``block_work`` edge visits allow), and comes back as one partial sum per vertex.  Larger
    components are searched level by level with joins (``_by_levels``), so a task's memory is bounded whatever the graph; both give the same
    numbers.  Nothing is collected or broadcast.  ``source_fraction`` takes a share of the sources by
    hash and scales by n/s (Brandes and Pich 2007), the only and explicit approximation.  Normalised by 1/((n-1)(n-2))
    over ordered pairs, as the reference does.
    """
    spark = edges.sparkSession
    ensure_checkpoint_dir(spark)
    adj = undirected(edges).checkpoint()
    part = connected_components(adj).select(F.col("vertex").alias("u"), "component")
    part = global_row_number(part, [F.col("component"), F.col("u")], "id").select("u", "component", "id").checkpoint()
    n = part.count()
    chosen = part if source_fraction is None else part.filter(
        F.pmod(F.xxhash64("u", F.lit(seed)), F.lit(1_000_000)) < int(source_fraction * 1_000_000))
    n_sources = n if source_fraction is None else chosen.count()
    size = (adj.join(part, "u").groupBy("component").agg(F.count("*").alias("e"))
            .join(part.groupBy("component").agg(F.min("id").alias("low"), F.count("*").alias("n")), "component")
            .join(chosen.groupBy("component").agg(F.count("*").alias("s")), "component")
            .withColumn("take", F.greatest(F.lit(1), F.floor(F.lit(block_work) / F.col("e"))).cast("int"))
            .withColumn("blocks", F.ceil(F.col("s") / F.col("take")).cast("int")).checkpoint())
    small, large = size.filter(F.col("e") <= task_edges), size.filter(F.col("e") > task_edges)
    packed = (adj.join(part, "u").join(part.select(F.col("u").alias("v"), F.col("id").alias("w")), "v").join(small.select("component", "low"), "component")
              .groupBy("component").agg(F.collect_list(F.shiftleft(F.col("id") - F.col("low"), 32) + F.col("w") - F.col("low")).alias("edges")))
    sources = (chosen.join(small, "component").groupBy("component", "low", "n", "take", "blocks")
               .agg(F.array_sort(F.collect_list(F.col("id") - F.col("low"))).alias("sources")))
    dealt = (packed.join(sources, "component")
             .select("edges", "low", "n", "sources", "take", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
             .select("edges", "low", "n", F.slice("sources", F.col("block") * F.col("take") + 1, F.col("take")).alias("sources")))
    load = small.agg(F.sum("blocks"), F.sum(F.col("e") * F.col("s") / block_work), F.sum(F.col("e") * F.col("blocks") / task_edges)).first()
    found = spark.createDataFrame([], "u string, b double")
    if load[0]:
        # a number of partitions of its own: blocks must not be merged into one task
        dealt = dealt.repartition(min(load[0], int(load[1] + load[2]) + int(spark.conf.get("spark.sql.shuffle.partitions"))))
        found = (dealt.mapInArrow(_search, "id long, b double").groupBy("id").agg(F.sum("b").alias("b"))
                 .join(part, "id").select("u", "b"))
    rows = large.agg(F.sum(F.col("s") * F.col("n"))).first()[0]
    if rows:
        inside = part.join(large.select("component"), "component", "left_semi")
        found = found.unionByName(_by_levels(adj.join(inside, "u", "left_semi").select("u", "v").checkpoint(),
                                             chosen.join(large.select("component"), "component", "left_semi"), -(-rows // state_rows)))
    scale = (1.0 / ((n - 1) * (n - 2)) if n > 2 else 1.0) if normalized else 0.5
    scale *= n / n_sources if n_sources else 0.0
    return part.join(found, "u", "left").select(F.col("u").alias("cell_id"),
                                                (F.coalesce("b", F.lit(0.0)) * F.lit(scale)).alias("betweenness"))


def centrality(edges: DataFrame, ranks: DataFrame | None = None, between: DataFrame | None = None) -> DataFrame:
    """Degree, PageRank and betweenness per vertex (vertices come from the edge list); the latter two may be given."""
    deg = degree(edges)
    pr = pagerank(edges) if ranks is None else ranks
    bt = betweenness(edges) if between is None else between
    return deg.join(pr, "cell_id").join(bt, "cell_id").select(
        "cell_id", "neighbor_degree", "pagerank", "betweenness")


def neighbors_of(edges: DataFrame, cell: str, cent: DataFrame | None = None, n: int = 25) -> DataFrame:
    """One cell's immediate neighbours (either endpoint), weight default 1.0, heaviest first."""
    e = edges
    weight = F.col("weight") if "weight" in e.columns else F.lit(1.0)
    sel = e.filter((F.col("src_cell_id") == cell) | (F.col("dst_cell_id") == cell)).select(
        opposite_endpoint("src_cell_id", "dst_cell_id", F.lit(cell)).alias("neighbor"),
        weight.cast("double").alias("weight"))
    if cent is not None:
        sel = sel.join(cent.withColumnRenamed("cell_id", "neighbor"), "neighbor", "left")
    return sel.orderBy(F.col("weight").desc(), F.col("neighbor").asc()).limit(n)
