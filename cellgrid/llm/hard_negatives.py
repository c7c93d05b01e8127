"""Hard negatives by vertical scans of integer vectors (branch and bound on single dimensions).

Vectors become integers (``floor(scale * x)``), so every score is an exact integer inner product.  For each anchor a block of rows
is read dimension by dimension, in the descending order of the anchor's magnitudes.  After a few dimensions each row has a partial
score, and the least and greatest that the remaining dimensions can add are known from the block's column minima and maxima; rows
whose bounds cannot reach the result any more leave the candidate bitmap, and only the others are read on.

* Positives: rows of the anchor's label.  A row leaves when its upper bound is below the k-th best lower bound.
* Negatives: rows of other labels.  A row leaves when its bounds miss every window ``[low% of p, p]`` of the anchor's positive scores p;
  what remains has exact scores, from which each window takes its first ``k``.

Spark places rows and anchors in blocks by hash of the id and meets each block of anchors with each block of rows in one task, so blocks do
not depend on labels or copies and a task's memory is bounded by two block sizes.  Each task returns at most k rows per anchor (and
positive), merged by a window.  The two phases read the same checkpointed blocks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SCALE = 256
POSITIVES = 5
NEGATIVES = 5
LOW, HIGH = 80, 100  # percent of the positive score
ANCHOR_STEP = 100
BLOCK_ROWS = 16_384
LEAST_BLOCKS = 24
LEAST_ROWS = 512
STEP = 8  # dimensions between two looks at the bounds
LARGEST = 1 << 22  # magnitude of an integer component


def integer_rows(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                 scale: int = SCALE) -> DataFrame:
    """(vec_id, label, q) of the rows that take part.

    Rows with a null id or label, a null or empty vector, or a null or non-finite component take no part, neither do vectors with an integer
    component of ``LARGEST`` or more in magnitude (products would not stay exact) or of another length than the most common one (the
    shorter of two equally common).  Rows that share an id are one row (the smallest label, then vector).
    """
    v = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{label_col}`").cast("long").alias("label"),
                       F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    good = v.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("v") > 0)
                    & F.forall("v", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < LARGEST / scale), F.lit(False))))
    whole = good.select("vec_id", "label", F.transform("v", lambda x: F.floor(scale * x).cast("int")).alias("q"))
    one = whole.groupBy("vec_id").agg(F.min(F.struct("label", "q")).alias("r")).select("vec_id", "r.label", "r.q").checkpoint()
    common = one.groupBy(F.size("q").alias("d")).agg(F.count("*").alias("c")).orderBy(F.desc("c"), "d").first()
    return one if common is None else one.filter(F.size("q") == common["d"])


class Block:
    """Rows by label, one array per dimension, with the minima and maxima of each label's columns."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, q: np.ndarray):
        order = np.lexsort((ids, labels))
        self.ids, self.labels = ids[order], labels[order]
        exact = np.float64 if q.shape[1] * float(max(1, np.abs(q).max())) ** 2 < 2 ** 53 else np.int64
        self.columns = np.ascontiguousarray(q[order].T.astype(exact))
        self.low, self.high = self.columns.min(axis=1), self.columns.max(axis=1)
        edges = np.flatnonzero(np.concatenate([[True], self.labels[1:] != self.labels[:-1], [True]]))
        self.span = {int(self.labels[a]): (int(a), int(b)) for a, b in zip(edges[:-1], edges[1:], strict=True)}

    def _remaining(self, a: np.ndarray, low: np.ndarray, high: np.ndarray):
        """The dimensions by descending magnitude, and what those from the i-th on can add at least and at most."""
        order = np.argsort(-np.abs(a), kind="stable")
        one, two = a[order] * low[order], a[order] * high[order]
        tail = lambda x: np.append(np.cumsum(x[::-1])[::-1], 0)
        return order, tail(np.minimum(one, two)), tail(np.maximum(one, two))

    def scan(self, a: np.ndarray, alive: np.ndarray, keep, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rows, exact scores) of what is left of the rows ``alive`` when ``keep(partial, least, most)`` has judged all dimensions."""
        a = a.astype(self.columns.dtype)
        order, least, most = self._remaining(a, low, high)
        score = np.zeros(len(alive), self.columns.dtype)
        for i in range(0, len(order), STEP):
            if not len(alive):
                break
            dims = order[i:i + STEP]
            score += a[dims] @ self.columns[np.ix_(dims, alive)]
            bitmap = keep(score, least[min(i + STEP, len(order))], most[min(i + STEP, len(order))])
            if not bitmap.all():
                alive, score = alive[bitmap], score[bitmap]
        return alive, score.astype(np.int64)

    def _first(self, rows: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
        """Positions of the k highest scores, ties by smaller id."""
        if len(rows) > k:
            some = np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k])
        else:
            some = np.arange(len(rows))
        return some[np.lexsort((self.ids[rows[some]], -score[some]))[:k]]

    def positives(self, anchor_id: int, label: int, a: np.ndarray, k: int) -> list[tuple[int, int]]:
        """(vec_id, score) of the k best other rows of the label."""
        begin, end = self.span.get(label, (0, 0))
        alive = np.arange(begin, end)
        alive = alive[self.ids[alive] != anchor_id]
        if not len(alive):
            return []
        part = self.columns[:, begin:end]

        def keep(score, least, most):
            if len(score) <= k:
                return np.ones(len(score), bool)
            return score + most >= np.partition(score, len(score) - k)[len(score) - k] + least

        rows, score = self.scan(a, alive, keep, part.min(axis=1), part.max(axis=1))
        return [(int(self.ids[rows[i]]), int(score[i])) for i in self._first(rows, score, k)]

    def negatives(self, label: int, a: np.ndarray, scores: list[int], k: int, low: int, high: int) -> dict[int, list[tuple[int, int]]]:
        """For each positive score, (vec_id, score) of the k best rows of other labels in its window."""
        begin, end = self.span.get(label, (0, 0))
        alive = np.concatenate([np.arange(begin), np.arange(end, len(self.ids))])
        windows = [(low * p, high * p) for p in scores if low * p <= high * p]
        if not windows or not len(alive):
            return {}
        bottom, top = min(x[0] for x in windows) / 100, max(x[1] for x in windows) / 100

        def keep(score, least, most):
            # bounds in doubles are exact far beyond these magnitudes; half a unit of room costs nothing
            return (score + most >= bottom - 0.5) & (score + least <= top + 0.5)

        rows, score = self.scan(a, alive, keep, self.low, self.high)
        out = {}
        for p in scores:
            inside = np.flatnonzero((100 * score >= low * p) & (100 * score <= high * p))
            out[p] = [(int(self.ids[rows[inside[i]]]), int(score[inside[i]])) for i in self._first(rows[inside], score[inside], k)]
        return out


def _matrix(column) -> np.ndarray:
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(lists.flatten(), dtype=np.int64).reshape(len(lists), -1)


def _long(x: int) -> Column:
    return F.lit(x).cast("long")


def _split(table: pa.Table):
    asks = np.asarray(table.column("is_anchor"))
    if not asks.any() or asks.all():
        return None
    rows, anchors = table.filter(pa.array(~asks)), table.filter(pa.array(asks))
    block = Block(np.asarray(rows.column("vec_id")), np.asarray(rows.column("label")), _matrix(rows.column("q")))
    return block, np.asarray(anchors.column("vec_id")), np.asarray(anchors.column("label")), _matrix(anchors.column("q")), anchors


def _positives_of_block(k: int):
    schema = pa.schema([("anchor_id", pa.int64()), ("positive_id", pa.int64()), ("positive_score", pa.int64())])

    def run(table: pa.Table) -> pa.Table:
        parts = _split(table)
        if parts is None:
            return schema.empty_table()
        block, ids, labels, q, _ = parts
        out = [(int(i), *found) for i, label, a in zip(ids, labels, q, strict=True) for found in block.positives(int(i), int(label), a, k)]
        return pa.table([pa.array(c, pa.int64()) for c in (zip(*out, strict=True) if out else [()] * 3)], schema=schema)
    return run


def _negatives_of_block(k: int, low: int, high: int):
    schema = pa.schema([(c, pa.int64()) for c in ("anchor_id", "positive_id", "negative_id", "positive_score", "negative_score")])

    def run(table: pa.Table) -> pa.Table:
        parts = _split(table)
        if parts is None:
            return schema.empty_table()
        block, ids, labels, q, anchors = parts
        out = []
        for i, label, a, known in zip(ids, labels, q, anchors.column("positives").to_pylist(), strict=True):
            found = block.negatives(int(label), a, sorted({p["s"] for p in known}), k, low, high)
            out += [(int(i), p["i"], n, p["s"], s) for p in known for n, s in found.get(p["s"], [])]
        return pa.table([pa.array(c, pa.int64()) for c in (zip(*out, strict=True) if out else [()] * 5)], schema=schema)
    return run


def mine(vectors: DataFrame, anchor_step: int = ANCHOR_STEP, n_positives: int = POSITIVES, n_negatives: int = NEGATIVES, low: int = LOW,
         high: int = HIGH, scale: int = SCALE, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
         block_rows: int = BLOCK_ROWS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score (long, rank int).

    Anchors are the rows whose id is divisible by ``anchor_step``; an anchor's positives are its first ``n_positives`` other rows of
    the same label by score, ties by smaller id.  For each, the first ``n_negatives`` rows of other labels whose score s
    satisfies ``low * positive_score <= 100 * s <= high * positive_score``.  An anchor without positives, and a positive
    whose window is empty, gives no rows.  ``integer_rows`` says which rows take part; other columns are not read.
    """
    from ..session import ensure_checkpoint_dir
    ensure_checkpoint_dir(vectors.sparkSession)
    rows = integer_rows(vectors, id_col, vector_col, label_col, scale)
    is_anchor = F.col("vec_id") % anchor_step == 0
    size = rows.agg(F.count("*").alias("n"), F.count_if(is_anchor).alias("a")).first()
    # blocks of bounded size, small ones on a small table so that all cores have some
    blocks = max(-(-size["n"] // block_rows), min(LEAST_BLOCKS, size["n"] // LEAST_ROWS), 1)
    groups = max(-(-size["a"] // block_rows), 1)
    none = F.lit(None).cast("array<struct<i:bigint,s:bigint>>").alias("positives")
    side = lambda what: F.lit(what).alias("is_anchor")
    dealt = rows.select("vec_id", "label", "q", F.pmod(F.xxhash64("vec_id"), _long(blocks)).alias("block"),
                        F.explode(F.sequence(_long(0), _long(groups - 1))).alias("group"), side(False), none)
    own_group = F.pmod(F.xxhash64("vec_id", F.lit(1)), _long(groups)).alias("group")
    every_block = F.explode(F.sequence(_long(0), _long(blocks - 1))).alias("block")
    anchors = rows.filter(is_anchor)

    first = anchors.select("vec_id", "label", "q", every_block, own_group, side(True), none)
    near = dealt.unionByName(first).groupBy("block", "group").applyInArrow(
        _positives_of_block(n_positives), "anchor_id long, positive_id long, positive_score long")
    best = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    positives = (near.withColumn("r", F.row_number().over(best)).filter(F.col("r") <= n_positives)
                 .groupBy("anchor_id").agg(F.collect_list(F.struct(F.col("positive_id").alias("i"), F.col("positive_score").alias("s"))).alias("positives"))
                 .checkpoint())

    second = (anchors.join(positives, F.col("vec_id") == F.col("anchor_id"))
              .select("vec_id", "label", "q", every_block, own_group, side(True), "positives"))
    found = dealt.unionByName(second).groupBy("block", "group").applyInArrow(
        _negatives_of_block(n_negatives, low, high),
        "anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long")
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n_negatives)
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))


#: The same for a table ``embeddings`` with the labels that the query gives every seventh row; all anchors against all rows.
ORACLE_SQL = f"""
WITH clean AS (SELECT vec_id, (CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END)::BIGINT AS label,
                      list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS q
               FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
               AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
score AS (SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, list_dot_product(a.q::DOUBLE[], r.q::DOUBLE[])::BIGINT AS s
          FROM clean a JOIN clean r ON a.vec_id % {ANCHOR_STEP} = 0 AND a.vec_id <> r.vec_id),
positive AS (SELECT anchor_id, vec_id AS positive_id, s AS positive_score FROM score WHERE same
             QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY s DESC, vec_id) <= {POSITIVES})
SELECT p.anchor_id, p.positive_id, row_number() OVER d::INTEGER AS rank, n.vec_id AS negative_id, p.positive_score, n.s AS negative_score
FROM positive p JOIN score n ON p.anchor_id = n.anchor_id AND NOT n.same
     AND {LOW} * p.positive_score <= 100 * n.s AND 100 * n.s <= {HIGH} * p.positive_score
WINDOW d AS (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.s DESC, n.vec_id)
QUALIFY row_number() OVER d <= {NEGATIVES}
"""
