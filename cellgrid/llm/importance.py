"""Importance resampling of documents towards a target text distribution.

Features are all runs of one to ``LONGEST`` consecutive words (``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z), joined by one
blank; a feature's bucket is the CRC-32 of its bytes modulo ``BUCKETS``, computed for all features of a slice at once by
``crc_table``.  A bucket's gain is the logarithm of how much more frequent it is in the target than in the corpus (add-one
smoothing); a document's weight is the mean gain of its features.  Gumbel noise drawn from a hash of the id turns the ranking by
score into a draw without replacement, in proportion to the exponential of the weight.

Counting: each task adds up its own ``BUCKETS`` numbers over all its rows and hands on one row per bucket, so a shuffle of
tasks x buckets small rows suffices however frequent a feature is.  The gains, ``BUCKETS`` numbers, are the only thing that passes
the driver.  The ranking is a range-partitioned row number over narrow rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bytescan import ALNUM, slices, utf8, words
from .crc_table import crc32

BUCKETS = 10_000
LONGEST = 2
LEAST_WORDS = 20
PERCENT = 25
SEED = 7
UNIT = 1000  # gains and scores are whole thousandths


def buckets(texts: pa.Array, longest: int = LONGEST, n_buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of each feature, its bucket, words of each row) of a few texts."""
    low, starts, ends, first = words(*utf8(texts), ALNUM)
    count = np.diff(first)
    row = np.repeat(np.arange(len(count)), count)
    size = ends - starts
    begin = np.cumsum(size + 1) - size - 1  # the words side by side, one blank after each
    data = np.full(int((size + 1).sum()), 32, np.uint8)
    if len(size):
        at = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        data[np.repeat(begin, size) + at] = low[np.repeat(starts, size) + at]
    rows, found = [], []
    for n in range(1, longest + 1):
        if len(row) < n:
            break
        head = np.flatnonzero(row[:len(row) - n + 1] == row[n - 1:])
        rows.append(row[head])
        found.append(crc32(data, begin[head], begin[head + n - 1] + size[head + n - 1]) % np.uint32(n_buckets))
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), count
    return np.concatenate(rows), np.concatenate(found).astype(np.int64), count


def bucket_counts(docs: DataFrame, text_col: str = "text", longest: int = LONGEST, n_buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) over all features of all texts; buckets without any are absent."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_buckets, np.int64)
        for whole in batches:
            for b in slices(whole, "text", 4 << 20):
                total += np.bincount(buckets(b.column("text"), longest, n_buckets)[1], minlength=n_buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    return (docs.select(F.col(f"`{text_col}`").alias("text")).mapInArrow(run, "bucket long, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")))


def gains(docs: DataFrame, target: DataFrame, text_col: str = "text", target_col: str = "text", longest: int = LONGEST,
          n_buckets: int = BUCKETS) -> np.ndarray:
    """Gain of each bucket, in whole thousandths of a natural logarithm, rounded down."""
    seen = (bucket_counts(docs, text_col, longest, n_buckets).withColumn("side", F.lit(0))
            .unionByName(bucket_counts(target, target_col, longest, n_buckets).withColumn("side", F.lit(1))).toArrow())
    counts = np.zeros((2, n_buckets), np.int64)
    counts[np.asarray(seen["side"]), np.asarray(seen["bucket"])] = np.asarray(seen["n"])
    whole = counts.sum(axis=1)
    top, bottom = float(whole[0] + n_buckets), float(whole[1] + n_buckets)
    return np.array([math.floor(UNIT * math.log((float(t + 1) * top) / (float(s + 1) * bottom)))
                     for s, t in zip(counts[0].tolist(), counts[1].tolist(), strict=True)], np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text", longest: int = LONGEST,
          seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight and score of every document.

    A null or empty text, or one without words, has no features and weight 0.  A null id is drawn as an empty one.
    """
    shared = docs.sparkSession.sparkContext.broadcast(gain)  # one number per bucket

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, "text", 4 << 20):
                row, bucket, n_words = buckets(b.column("text"), longest, len(shared.value))
                n = np.bincount(row, minlength=b.num_rows).astype(np.int64)
                total = np.zeros(b.num_rows, np.int64)
                np.add.at(total, row, shared.value[bucket])
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n), pa.array(total // np.maximum(n, 1))],
                    names=["doc_id", "n_words", "n_features", "weight"])

    narrow = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    weighed = narrow.mapInArrow(run, T.StructType([narrow.schema["doc_id"], *T._parse_datatype_string(
        "n_words long, n_features long, weight long").fields]))
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-UNIT * F.log(-F.log((h + 0.5) / 4294967296.0)))
    return weighed.withColumn("score", F.col("weight") + noise)


def ranked(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text",
           percent: int = PERCENT, least_words: int = LEAST_WORDS, longest: int = LONGEST, n_buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """Every document's doc_id, n_words, n_features, weight, score and rank.

    Of the N documents with at least ``least_words`` words, the floor(percent * N / 100) with the highest scores are drawn and
    ranked from 1; ties go to the smaller id (null first), then to more features.  The others' rank is null.  Repeated rows are documents of their
    own; an empty table gives an empty result; other columns are not read.
    """
    from ..operators.prefix import global_row_number
    from ..session import ensure_checkpoint_dir
    ensure_checkpoint_dir(docs.sparkSession)
    gain = gains(docs, target, text_col, target_col, longest, n_buckets)
    scored = weigh(docs, gain, id_col, text_col, longest, seed).checkpoint()
    n = scored.filter(F.col("n_words") >= least_words).count() * percent // 100
    order = [F.col("n_words") < least_words, F.desc("score"), F.asc("doc_id"), F.desc("n_features"), F.desc("weight")]
    placed = global_row_number(scored, order, name="row_idx")
    return placed.select("doc_id", "n_words", "n_features", "weight", "score",
                         F.when(F.col("row_idx") <= n, F.col("row_idx")).cast("long").alias("rank"))


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` whose id was drawn, with all their columns; a row without an id is never drawn."""
    drawn = ranked(docs, target, id_col, **options).filter(F.col("rank").isNotNull()).select(F.col("doc_id").alias("_drawn")).distinct()
    return docs.join(drawn, docs[id_col] == drawn["_drawn"], "left_semi")


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: The same for tables ``documents`` and ``benchmark``; the checksum of each distinct feature byte by byte.
ORACLE_SQL = rf"""
WITH RECURSIVE byte(i, c, k) AS (SELECT i::BIGINT, i::BIGINT, 0 FROM range(256) t(i)
    UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, {0xEDB88320}) ELSE c >> 1 END, k + 1 FROM byte WHERE k < 8),
tab AS (SELECT list(c ORDER BY i) AS t FROM byte WHERE k = 8),
doc AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item AS (SELECT regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
df AS (SELECT r, unnest(list_concat(w, list_transform(generate_series(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM doc),
tf AS (SELECT unnest(list_concat(w, list_transform(generate_series(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM item),
feature AS (SELECT f, hex(encode(f)) AS x FROM (SELECT f FROM df UNION SELECT f FROM tf)),
crc(f, x, p, c) AS (SELECT f, x, 1, 4294967295::BIGINT FROM feature
    UNION ALL SELECT f, x, p + 2, xor(c >> 8, t[(xor(c, ('0x' || substr(x, p, 2))::BIGINT) & 255) + 1]) FROM crc, tab WHERE p < length(x)),
bucket AS (SELECT f, xor(c, 4294967295) % {BUCKETS} AS b FROM crc WHERE p > length(x)),
s AS (SELECT b, count(*) AS s FROM df JOIN bucket USING (f) GROUP BY b),
t AS (SELECT b, count(*) AS t FROM tf JOIN bucket USING (f) GROUP BY b),
total AS (SELECT (SELECT count(*) FROM df) AS s, (SELECT count(*) FROM tf) AS t),
gain AS (SELECT b, floor({UNIT} * ln(((coalesce(t.t, 0) + 1)::DOUBLE * (total.s + {BUCKETS})::DOUBLE)
                / ((coalesce(s.s, 0) + 1)::DOUBLE * (total.t + {BUCKETS})::DOUBLE)))::BIGINT AS g
         FROM (SELECT DISTINCT b FROM bucket) LEFT JOIN s USING (b) LEFT JOIN t USING (b), total),
weighed AS (SELECT r, count(*) AS n, floor(sum(g)::DOUBLE / count(*))::BIGINT AS weight FROM df JOIN bucket USING (f) JOIN gain USING (b) GROUP BY r),
scored AS (SELECT doc_id, len(w) AS n_words, coalesce(n, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
           (coalesce(weight, 0) + floor(-{UNIT} * ln(-ln((('0x' || substr(sha256('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE)
                                                   / 4294967296::DOUBLE))))::BIGINT AS score
           FROM doc LEFT JOIN weighed USING (r)),
placed AS (SELECT *, row_number() OVER (ORDER BY n_words < {LEAST_WORDS}, score DESC, doc_id NULLS FIRST, n_features DESC) AS p,
           (SELECT count(*) FROM scored WHERE n_words >= {LEAST_WORDS}) * {PERCENT} // 100 AS k FROM scored)
SELECT doc_id, n_words::BIGINT AS n_words, n_features, weight, score, CASE WHEN p <= k THEN p END::BIGINT AS rank FROM placed
"""
