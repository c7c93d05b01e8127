"""Approximate nearest neighbours on shifted Hilbert curves.

Vectors are normalised and projected on a few random orthonormal directions, a random shift is added, and the
Hilbert index of the resulting grid cell orders them; ``CURVES`` such orders use different directions and
shifts.  Each order is cut into blocks of equal size (percentiles of its keys), which Spark spreads over the tasks.  A query
visits the block it lies in and the neighbouring blocks that hold ``window`` of the order on each side, as a matrix product
per block; the best of all curves are merged and reranked by the exact cosine.

The window is a share of the order, not a number of rows, so recall does not fall as the table grows: vectors
without structure have no short neighbourhoods.  The keys end in a hash of the id and the curve, so equal vectors
spread over several blocks, in another order on each curve.  Of equal vectors only the ``k`` + 1 smallest ids can be among
the nearest of any query, so no others are candidates.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bytescan import mix

CURVES = 8
DIMS = 3
BITS = 15
TIE_BITS = 16
WINDOW = 0.11
BLOCK_ROWS = 2048
LEAST_BLOCKS = 24
LEAST_ROWS = 128


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position on the Hilbert curve of each row of grid coordinates (Skilling's transposition, vectorised)."""
    x = [c.astype(np.int64) for c in cells.T]
    n = len(x)
    for level in range(bits - 1, 0, -1):
        q = 1 << level
        for i in range(n):
            flip = (x[i] & q) != 0
            swap = np.where(flip, 0, (x[0] ^ x[i]) & (q - 1))
            x[0] = np.where(flip, x[0] ^ (q - 1), x[0] ^ swap)
            x[i] = x[i] ^ swap
    for i in range(1, n):
        x[i] = x[i] ^ x[i - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        turn = np.where((x[n - 1] >> level) & 1, turn ^ ((1 << level) - 1), turn)
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | (((x[i] ^ turn) >> level) & 1)
    return key


def curve_keys(unit: np.ndarray, ids: np.ndarray, seed: int) -> np.ndarray:
    """(rows, CURVES) keys: Hilbert index, then the id hashed with the curve's number."""
    rng = np.random.default_rng(seed)
    hashed = mix(ids.astype(np.int64).view(np.uint64))
    out = np.empty((len(unit), CURVES), np.int64)
    width = unit.shape[1]
    for c in range(CURVES):
        axes = np.linalg.qr(rng.normal(size=(width, min(DIMS, width))))[0]
        shift = 0.5 * rng.random(axes.shape[1])
        place = 0.25 * (1 + np.tanh(0.8 * np.sqrt(width) * (unit @ axes))) + shift  # in [0, 1)
        cell = np.minimum((place * (1 << BITS)).astype(np.int64), (1 << BITS) - 1)
        tie = (mix(hashed + np.uint64(c)) >> np.uint64(64 - TIE_BITS)).astype(np.int64)
        out[:, c] = (hilbert_index(cell, BITS) << TIE_BITS) | tie
    return out


def _matrix(lists: pa.Array) -> np.ndarray:
    return np.asarray(lists.flatten(), dtype=np.float64).reshape(len(lists), -1)


def _orders(seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            v = _matrix(b.column("vector"))
            v = v / np.abs(v).max(axis=1, keepdims=True)
            keys = curve_keys(v / np.linalg.norm(v, axis=1, keepdims=True), np.asarray(b.column("vec_id")), seed)
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), b.column("vector"), b.column("is_query"),
                 pa.ListArray.from_arrays(pa.array(np.arange(b.num_rows + 1, dtype=np.int32) * CURVES), pa.array(keys.ravel()))],
                names=["vec_id", "vector", "is_query", "keys"])
    return run


def exact_cosine(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Cosine of the vector q with each row of c; every row is summed by itself, so equal rows score equally."""
    q, c = q / np.abs(q).max(), c / np.abs(c).max(axis=1, keepdims=True)  # keeps squares in range
    return (c * q).sum(axis=1) / (np.sqrt((c * c).sum(axis=1)) * np.sqrt((q * q).sum()))


def _best_of_block(k: int):
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def run(table: pa.Table) -> pa.Table:
        asks = np.asarray(table.column("is_query"))
        if not asks.any() or asks.all():
            return schema.empty_table()
        ids = np.asarray(table.column("vec_id"))
        v = _matrix(table.column("vector").combine_chunks())
        unit = v / np.abs(v).max(axis=1, keepdims=True)
        unit = unit / np.linalg.norm(unit, axis=1, keepdims=True)
        queries, rows = np.flatnonzero(asks), np.flatnonzero(~asks)
        out: list[tuple[int, int, float]] = []
        for start in range(0, len(queries), 512):
            part = queries[start:start + 512]
            score = unit[part] @ unit[rows].T
            score[ids[part][:, None] == ids[rows][None, :]] = -np.inf
            keep = min(k, len(rows))
            least = np.partition(score, len(rows) - keep, axis=1)[:, len(rows) - keep]
            for i, q in enumerate(part):
                near = rows[np.flatnonzero(score[i] >= max(least[i] - 1e-12, -2.0))]
                if not len(near):
                    continue
                exact = exact_cosine(v[q], v[near])
                order = np.lexsort((ids[near], -exact))[:k]
                out += [(int(ids[q]), int(ids[near[j]]), float(exact[j])) for j in order]
        if not out:
            return schema.empty_table()
        a, b, s = zip(*out, strict=True)
        return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(s)], schema=schema)
    return run


def nearest(vectors: DataFrame, k: int = 5, query_step: int = 50, window: float = WINDOW, id_col: str = "vec_id",
            vector_col: str = "embedding", seed: int = 17) -> DataFrame:
    """For each row whose id is divisible by ``query_step``, its ``k`` nearest other rows found: query_id, rank, vec_id, score.

    Nearness is the cosine in double precision, ties go to the smaller id.  Rows with a null id, and vectors that are null, empty,
    zero or hold a null or non-finite component, take no part; vectors of another length than the most
    common one (the shorter of two equally common) neither.  Rows that share an id are one vector (the smallest).  Other columns
    are not read.
    """
    from pyspark.sql import Window

    from ..session import ensure_checkpoint_dir
    spark = vectors.sparkSession
    ensure_checkpoint_dir(spark)
    v = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vector_col}`").cast("array<double>").alias("vector"))
    good = v.filter(F.col("vec_id").isNotNull() & (F.size("vector") > 0)
                    & F.forall("vector", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
                    & F.exists("vector", lambda x: x != 0))
    good = good.groupBy("vec_id").agg(F.min("vector").alias("vector"))
    common = good.groupBy(F.size("vector").alias("d")).agg(F.count("*").alias("c")).orderBy(F.desc("c"), "d").first()
    result = T.StructType([T.StructField("query_id", T.LongType()), T.StructField("vec_id", T.LongType()), T.StructField("score", T.DoubleType())])
    if common is None:
        return spark.createDataFrame([], result).select("query_id", F.lit(1).alias("rank"), "vec_id", "score")
    usual = good.filter(F.size("vector") == common["d"])
    # of equal vectors, those that can be among the k nearest of any query: the k + 1 smallest ids
    equal = Window.partitionBy("vector").orderBy("vec_id")
    least = usual.withColumn("r", F.row_number().over(equal)).filter(F.col("r") <= k + 1).drop("r")
    rows = least.withColumn("is_query", F.lit(False)).unionByName(
        usual.filter(F.col("vec_id") % query_step == 0).withColumn("is_query", F.lit(True)))
    keyed = rows.mapInArrow(_orders(seed), T.StructType([*rows.schema.fields, T.StructField("keys", T.ArrayType(T.LongType()))])).checkpoint()

    candidates = keyed.filter(~F.col("is_query"))
    n = candidates.count()
    # blocks fine enough for the window, but of no less than LEAST_ROWS rows: a small table is one block
    blocks = max(-(-n // BLOCK_ROWS), min(LEAST_BLOCKS, n // LEAST_ROWS), 1)
    reach = int(np.ceil(window * blocks))
    # the cut points of each order: one row of CURVES * (blocks - 1) numbers
    shares = [i / blocks for i in range(1, blocks)]
    cuts = candidates.agg(*[F.percentile_approx(F.col("keys")[c], shares or [0.5], 10_000).alias(f"c{c}") for c in range(CURVES)]).first()
    shared = spark.sparkContext.broadcast([np.array(cuts[f"c{c}"][:len(shares)], np.int64) for c in range(CURVES)])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            keys = np.asarray(b.column("keys").flatten()).reshape(b.num_rows, CURVES)
            at = np.stack([np.searchsorted(cut, keys[:, c], side="right") for c, cut in enumerate(shared.value)], axis=1)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(b.num_rows + 1, dtype=np.int32) * CURVES), pa.array(at.ravel().astype(np.int32)))
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("vector"), b.column("is_query"), lists],
                                             names=["vec_id", "vector", "is_query", "blocks"])

    placed = keyed.mapInArrow(place, T.StructType([*rows.schema.fields, T.StructField("blocks", T.ArrayType(T.IntegerType()))]))
    on_curve = placed.select("vec_id", "vector", "is_query", F.posexplode("blocks").alias("curve", "block"))
    asked = on_curve.filter("is_query").select(
        "vec_id", "vector", "curve", F.explode(F.sequence(F.greatest(F.col("block") - reach, F.lit(0)),
                                                          F.least(F.col("block") + reach, F.lit(blocks - 1)))).alias("block"),
        "is_query")
    both = on_curve.filter(~F.col("is_query")).select("vec_id", "vector", "curve", "block", "is_query").unionByName(asked)
    found = both.groupBy("curve", "block").applyInArrow(_best_of_block(k), result)
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
            .withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))
