"""Near-duplicate documents by one-permutation MinHash.

One hash of each shingle sorts a document's set into ``BANDS * ROWS`` bins; the smallest of each bin is kept, and an
empty bin takes the value of the first non-empty one on its own random sequence (optimal densification).
``ROWS`` bins make a band, equal bands a bucket.  Documents with equal sets are collapsed first, so only different sets
meet.  Two sets of similarity 0.8 miss each other in all bands with a probability below 1e-8.

Candidates are stars: each member of a bucket is paired with two centres of the bucket, the member that shares the most
buckets with others and a random one; the number of pairs is linear in the members.  Pairs are confirmed on the full
sets.  A star may leave members apart that only resemble each other, so members of a bucket that
are still in different components are then compared with each other; those already connected never are.  Small buckets
do that by a join, large ones block by block, where only links come out.

Sets are never gathered by bucket: tasks see bucket keys and ids, and texts meet pair by pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut, ensure_checkpoint_dir
from .bytescan import SPACED, mix, range_hashes, slices, utf8, words
from .components import connected_components

SHINGLE = 5
PERCENT = 80
ROWS, BANDS = 5, 48
BINS = ROWS * BANDS
#: buckets up to this size pair their open members by a join, larger ones compare them block by block
DIRECT = 32
BLOCK = 1024
_C = np.uint64(0x9E3779B97F4A7C15)
_EDGES = np.array([-(-(k << 64) // BINS) for k in range(BINS)], np.uint64)


def shingle_sets(texts: pa.Array, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a text of fewer words has its whole sequence as one shingle."""
    low, starts, ends, first = words(*utf8(texts), SPACED)
    w = range_hashes(low, starts, ends)
    full = np.full(max(len(w) - size + 1, 0), size, np.uint64)
    for k in range(size):
        full = mix(full * _C + w[k:k + len(full)])
    out = []
    for a, b in zip(first.tolist(), first[1:].tolist(), strict=False):
        if b - a >= size:
            out.append(np.unique(full[a:b - size + 1]))
        elif b > a:
            h = np.array([b - a], np.uint64)
            for k in range(a, b):
                h = mix(h * _C + w[k:k + 1])
            out.append(h)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def band_keys(sets: list[np.ndarray]) -> np.ndarray:
    """Bucket keys of each non-empty set, one a band."""
    value = np.zeros((len(sets), BINS), np.uint64)
    filled = np.zeros((len(sets), BINS), bool)
    for r, s in enumerate(sets):
        at = np.searchsorted(s, _EDGES)
        ends = np.append(at[1:], len(s))
        has = at < ends
        filled[r] = has
        value[r, has] = s[at[has]]
    row, bin_ = np.nonzero(~filled)
    dense = value.copy()
    attempt = 1
    while len(row):
        to = (mix(bin_.astype(np.uint64) * _C + np.uint64(attempt)) % np.uint64(BINS)).astype(np.int64)
        ok = filled[row, to]
        dense[row[ok], bin_[ok]] = value[row[ok], to[ok]]
        row, bin_ = row[~ok], bin_[~ok]
        attempt += 1
    key = np.tile(np.arange(BANDS, dtype=np.uint64), (len(sets), 1))
    for k in range(ROWS):
        key = mix(key * _C + dense[:, k::ROWS])
    return key


def _sketch(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, "text"):
                sets = shingle_sets(b.column("text"), size)
                some = [r for r, s in enumerate(sets) if len(s)]
                keys = band_keys([sets[r] for r in some]).view(np.int64)
                length = np.zeros(len(sets), np.int64)
                length[some] = BANDS
                offsets = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
                bands = pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.ravel()))
                with np.errstate(over="ignore"):
                    s1 = np.array([s.sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)
                    s2 = np.array([mix(s).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [b.column("id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(s1), pa.array(s2), bands],
                    names=["id", "n", "s1", "s2", "bands"])
    return run


def _confirm(size: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for half in slices(whole, "ta"):
                for b in slices(half, "tb"):
                    left, right = shingle_sets(b.column("ta"), size), shingle_sets(b.column("tb"), size)
                    keep = []
                    for x, y in zip(left, right, strict=True):
                        common = len(np.intersect1d(x, y, assume_unique=True))
                        keep.append(100 * common >= percent * (len(x) + len(y) - common))
                    yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


def _pairs(left, right):
    return F.least(left, right).alias("a"), F.greatest(left, right).alias("b")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the smallest id reachable over confirmed links), kept.

    Words are runs of non-blank characters, A-Z lower-cased.  Null texts and texts without words have an empty set and stay
    alone; so do rows with a null id, whose component is null and which are kept.  Rows that share an id are one document,
    linked if any of their texts is.  Other columns are not read.
    """
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    narrow = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    schema = T.StructType([narrow.schema["id"], T.StructField("n", T.LongType()), T.StructField("s1", T.LongType()),
                           T.StructField("s2", T.LongType()), T.StructField("bands", T.ArrayType(T.LongType()))])
    sketch = narrow.mapInArrow(_sketch(shingle), schema).checkpoint()

    # equal sets: the smallest id stands for its class
    usable = sketch.filter("n > 0 AND id IS NOT NULL")
    classes = usable.groupBy("s1", "s2", "n").agg(F.min("id").alias("rep"))
    member = (usable.join(classes, ["s1", "s2", "n"]).filter("id = rep")
              .select("id", "n", F.explode("bands").alias("key")))
    crowded = member.groupBy("key").agg(F.count("*").alias("c")).filter("c > 1")
    met = cut(member.join(crowded, "key").select("key", "id", "n", "c"))

    popular = met.groupBy("id").agg(F.sum("c").alias("p"))
    ranked = met.join(popular, "id")
    centres = ranked.groupBy("key").agg(F.max(F.struct("p", F.xxhash64("id").alias("h"), "id", "n")).alias("c1"),
                                        F.min(F.struct(F.xxhash64("key", "id").alias("h"), "id", "n")).alias("c2"))
    # sets of a similarity of percent differ in size by no more than that
    alike = lambda x, y: F.least(x, y) * 100 >= F.greatest(x, y) * percent
    star = met.join(centres, "key").select("id", "n", F.explode(F.array(
        F.struct("c1.id", "c1.n"), F.struct("c2.id", "c2.n"))).alias("c"))
    first = cut(star.filter((F.col("id") != F.col("c.id")) & alike(F.col("n"), F.col("c.n")))
                .select(*_pairs(F.col("id"), F.col("c.id"))).distinct())

    texts = cut(narrow.join(met.select("id").distinct(), "id", "left_semi"))
    links = cut(_links(first, texts, shingle, percent))
    component = cut(connected_components(links.select(F.col("a").alias("u"), F.col("b").alias("v"))))

    placed = (met.join(component, F.col("id") == F.col("vertex"), "left")
              .select("key", "id", "n", F.coalesce("component", "id").alias("k")))
    split = (placed.groupBy("key").agg(F.min("k").alias("lo"), F.max("k").alias("hi"), F.count("*").alias("size"), F.min("n").alias("least"))
             .filter("lo != hi").select("key", "size", "least"))
    open_ = cut(placed.join(split, "key"))
    few = _apart(open_.filter(F.col("size") <= DIRECT), percent).distinct().join(first, ["a", "b"], "left_anti")
    many = open_.filter(F.col("size") > DIRECT).join(centres.select("key", F.col("c1.id").alias("c")), "key")
    more = _links(few, texts, shingle, percent).unionAll(_against_the_rest(many, texts, shingle, percent))
    edges = links.unionAll(more).select(F.col("a").alias("u"), F.col("b").alias("v"))
    final = connected_components(edges)

    named = (sketch.join(classes, ["s1", "s2", "n"], "left").join(final, F.col("rep") == F.col("vertex"), "left"))
    own = F.when(F.col("n") > 0, F.coalesce("component", "rep")).otherwise(F.col("id"))
    return named.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
                        F.when(F.col("id").isNotNull(), own).alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _apart(members: DataFrame, percent: int) -> DataFrame:
    """Pairs of a bucket in different components whose sizes allow a link."""
    x = members.select("key", "id", "n", "k")
    y = x.select(F.col("key").alias("key2"), F.col("id").alias("id2"), F.col("n").alias("n2"), F.col("k").alias("k2"))
    alike = F.least("n", "n2") * 100 >= F.greatest("n", "n2") * percent
    return (x.join(y, (F.col("key") == F.col("key2")) & (F.col("id") < F.col("id2")) & (F.col("k") != F.col("k2")) & alike)
            .select(F.col("id").alias("a"), F.col("id2").alias("b")))


def _against_the_rest(members: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Links between members of large buckets that their centre left in different components.

    Members of buckets with the same centre ``c`` form a group.  Those outside its largest component are the queries; they are
    compared with every member in blocks of at most BLOCK queries and BLOCK members, a block being one task's work, and
    only links come out.  Queries are few where a centre ties most of its group together.
    """
    m = members.select("c", "id", "k").distinct()
    parts = m.groupBy("c", "k").agg(F.count("*").alias("s"))
    main = parts.groupBy("c").agg(F.max_by("k", F.struct("s", "k")).alias("main"), F.sum("s").alias("all"), F.max("s").alias("most"))
    sized = m.join(main, "c").withColumns({
        "mb": F.ceil(F.col("all") / BLOCK).cast("int"), "qb": F.ceil((F.col("all") - F.col("most")) / BLOCK).cast("int"),
        "h": F.xxhash64("id")})
    count = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    asked = sized.filter(F.col("k") != F.col("main")).select(
        "c", count("mb").alias("mb"), F.pmod("h", "qb").cast("int").alias("qb"), "id", "k", F.lit(True).alias("asks"))
    all_ = sized.filter("qb > 0").select(
        "c", F.pmod("h", "mb").cast("int").alias("mb"), count("qb").alias("qb"), "id", "k", F.lit(False).alias("asks"))
    work = asked.unionByName(all_).join(texts, "id")
    result = T.StructType([T.StructField("a", texts.schema["id"].dataType), T.StructField("b", texts.schema["id"].dataType)])
    return work.groupBy("c", "mb", "qb").applyInArrow(_compare_block(shingle, percent, result), result)


def _compare_block(size: int, percent: int, result: T.StructType):
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        asks = np.asarray(table.column("asks"))
        ids, part = table.column("id").to_pylist(), table.column("k").to_pylist()
        sets = [s for whole in table.select(["text"]).to_batches() for b in slices(whole, "text") for s in shingle_sets(b.column("text"), size)]
        rows = np.flatnonzero(~asks)
        out: list[tuple] = []
        if len(rows) and asks.any():
            kinds, code = np.unique(np.concatenate([sets[r] for r in rows]), return_inverse=True)
            length = np.array([len(sets[r]) for r in rows])
            starts = np.cumsum(length) - length
            for q in np.flatnonzero(asks).tolist():
                at = np.searchsorted(kinds, sets[q])
                at[at == len(kinds)] = 0
                mine = np.zeros(len(kinds), np.int32)
                mine[at[kinds[at] == sets[q]]] = 1
                common = np.add.reduceat(mine[code], starts)
                near = 100 * common >= percent * (length + len(sets[q]) - common)
                out += [tuple(sorted((ids[q], ids[rows[j]]))) for j in np.flatnonzero(near).tolist() if part[rows[j]] != part[q]]
        a, b = zip(*out, strict=True) if out else ((), ())
        kind = table.schema.field("id").type
        return pa.table([pa.array(a, kind), pa.array(b, kind)], names=["a", "b"])
    return run


def _links(pairs: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    a = texts.select(F.col("id").alias("a"), F.col("text").alias("ta"))
    b = texts.select(F.col("id").alias("b"), F.col("text").alias("tb"))
    return pairs.join(a, "a").join(b, "b").select("a", "b", "ta", "tb").mapInArrow(
        _confirm(shingle, percent), T.StructType([pairs.schema["a"], pairs.schema["b"]])).distinct()


def keep_one(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """``docs`` without the documents whose component has a smaller id; the columns stay as they are."""
    gone = near_duplicates(docs, id_col=id_col, **options).filter(~F.col("kept")).select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, F.col(f"`{id_col}`") == F.col("_gone"), "left_anti")
