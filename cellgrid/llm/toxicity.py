"""Toxicity by two class-conditional Kneser-Ney models over words and word pairs.

In each class P(w | v) = own(v, w) + rest(v) * P(w), and P(w) = own(w) + rest * shared(w).  Pairs are counted by distinct texts;
words by their Kneser-Ney continuation counts, the number of distinct words that they follow, so that copies do not add up: ``own`` is
the class's relative count after absolute discounting, ``shared`` the relative count over both classes together.
The discount is the same rate in both classes (``RARE`` in the smaller one).  So an expression that is rare in
either falls back on the counts below it in both, where the two probabilities are proportional and it decides nothing.

The log ratio log P(w | v, toxic) - log P(w | v, ordinary) is the sum of a part of the word, one of the context v (the ratio
of the two rests) and one of the pair.  Each is told apart into what exceeds ``MARGIN`` on either side, strong evidence, and the rest,
faint evidence (classes that mix languages or topics differently shift many words a little).  Nothing of it is dropped: a document has four
means over its words, strong and faint, of the word's part and of the two others.  A logistic curve over the means and their multiples by
the square root of the length (short texts vary more) makes them a score; where a mean tells nothing, it gives it no weight.

Rows for learning have crc32(id) mod 3 != 1.  Equal texts are one (toxic if one of them is).  The distinct texts fall in two halves by
hash; each half gives the counts under which the curve sees the other half, and the counts that are used in the end are
those of both.  They cover all such rows.  ``RARE`` and ``MARGIN`` were chosen by the log loss of this cross-fit on learning rows.

Words are told apart by 32 bits of their hash, so a pair is one 64-bit number.  Pairs are counted by partial aggregation and stored;
from them one further aggregation yields words and contexts, and a filter the pairs that exceed the discount.  What is kept
has the size of the vocabulary; the counted pairs are deleted.

The table of strong evidence stays distributed: the tasks receive a bitmap of 2 ** ``BITMAP`` bits of key hash, of one size, and what
passes it in the texts is joined with the table.  Faint evidence, which every word of every text has, is read from a table of one
size as well: 2 ** ``FAINT`` bytes by key hash, where keys that share a place hold their mean by occurrence.  The curve is fitted on about ``CURVE_ROWS`` rows (those whose id hash is
below a threshold that follows from their number), the only sample taken.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bytescan import ALNUM, mix, range_hashes, slices, utf8, words

CURVE_ROWS = 10_000
THRESHOLD = 0.7
RARE = 1.5
MARGIN = 2.0
BITMAP = 26
FAINT = 23
_STEP = 2 * MARGIN / 127  # of faint evidence; that of a pair is a difference of two parts
FILTER = 18  # 2 ** FILTER rows of 64 bits tell which ids may have a label
_BEGIN = np.uint64(0)  # stands before the first word of a text
_SUMS = 5
_MEANS = ("x0", "x1", "y0", "y1")  # strong and faint evidence


@dataclass
class KneserNey:
    """Strong evidence (key, word, pair; one row per key), a bitmap of its keys, faint evidence by key hash, and the logistic curve."""

    entries: DataFrame | None = None
    bits: np.ndarray = field(default_factory=lambda: np.zeros(1 << (BITMAP - 6), np.uint64))
    faint: np.ndarray = field(default_factory=lambda: np.zeros(1 << FAINT, np.int8))
    curve: np.ndarray = field(default_factory=lambda: np.zeros(9))
    center: np.ndarray = field(default_factory=lambda: np.zeros(8))
    scale: np.ndarray = field(default_factory=lambda: np.ones(8))


def _stored(df: DataFrame, path: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back; shuffle files that it took are given back."""
    from ..session import free_shuffles
    df.write.parquet(path)
    free_shuffles(df.sparkSession)
    return df.sparkSession.read.parquet(path)


def _folder(df: DataFrame) -> str:
    from ..session import scratch_path
    return scratch_path(df.sparkSession, f"toxicity-{uuid.uuid4().hex[:12]}")


def entry_keys(tag: int, x: np.ndarray) -> np.ndarray:
    """Key of evidence: tag 0 of a word, 1 of a context, 2 of a pair."""
    return mix(mix(x.view(np.uint64)) + np.uint64(tag)).view(np.int64)


def _word_pairs(texts: pa.Array):
    """(word, word before it, both as one number, first word of each text); words are 32 bits of hash."""
    low, starts, ends, first = words(*utf8(texts), ALNUM)
    w = range_hashes(low, starts, ends) >> np.uint64(32)
    v = np.concatenate([[_BEGIN], w[:-1]])[:len(w)]
    v[first[:-1][first[:-1] < first[1:]]] = _BEGIN
    return w.view(np.int64), v.view(np.int64), ((w << np.uint64(32)) | v).view(np.int64), first


def _find(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Index of each wanted key, -1 where it is absent."""
    if not len(keys):
        return np.full(len(wanted), -1, np.int64)
    at = np.searchsorted(keys, wanted)
    at[at == len(keys)] = 0
    return np.where(keys[at] == wanted, at, -1)


def _hits(bits: np.ndarray, texts: pa.Array):
    """(text, key, times) of the keys that the bitmap lets through, and the number of words of each text."""
    *parts, first = _word_pairs(texts)
    row = np.repeat(np.arange(len(texts)), np.diff(first))
    key, row = np.concatenate([entry_keys(tag, x) for tag, x in enumerate(parts)]), np.tile(row, 3)
    at = key.view(np.uint64) >> np.uint64(64 - BITMAP)
    inside = (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1
    key, row = key[inside], row[inside]
    order = np.lexsort((key, row))
    key, row = key[order], row[order]
    new = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (row[1:] != row[:-1])])) if len(key) else np.zeros(0, np.int64)
    return row[new], key[new], np.diff(np.append(new, len(key))), np.diff(first)


def _faint(table: np.ndarray, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Sums of faint evidence (of words, of pairs and contexts) of each text, and its number of words."""
    *parts, first = _word_pairs(texts)
    word, context, pair = (table[(entry_keys(tag, x).view(np.uint64) >> np.uint64(64 - FAINT)).astype(np.int64)] for tag, x in enumerate(parts))
    sums = [np.concatenate([[0], np.cumsum(p, dtype=np.int64)]) for p in (word, context.astype(np.int64) + pair)]
    return np.column_stack([p[first[1:]] - p[first[:-1]] for p in sums]) * _STEP, np.diff(first)


def evidence(m: KneserNey, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Mean strong evidence (of words, of pairs and contexts) of each of a few texts (0 without words) and its number of words."""
    row, key, times, count = _hits(m.bits, texts)
    total = np.zeros((len(texts), 2))
    if len(key):
        wanted = m.entries.sparkSession.createDataFrame([(int(k),) for k in np.unique(key)], "key long")
        table = m.entries.join(wanted, "key").orderBy("key").toArrow()
        at = _find(np.asarray(table["key"]), key)
        for i, part in enumerate(("word", "pair")):
            np.add.at(total[:, i], row[at >= 0], np.asarray(table[part])[at[at >= 0]] * times[at >= 0])
    return total / np.maximum(count, 1)[:, None], count


def remainder(id_col: Column) -> Column:
    return F.crc32(id_col.cast("string")) % 3


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, k0 .. k3): texts with the pair, by place (half, class); each text counts a pair once."""
    for whole in batches:
        for b in slices(whole, "text", 1 << 20):
            _, _, pair, first = _word_pairs(b.column("text"))
            if not len(pair):
                continue
            row = np.repeat(np.arange(b.num_rows), np.diff(first))
            place = np.asarray(b.column("place"))
            order = np.lexsort((row, pair))
            pair, row = pair[order], row[order]
            once = np.concatenate([[True], (pair[1:] != pair[:-1]) | (row[1:] != row[:-1])])
            pair, at = pair[once], place[row[once]]
            head = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]]))
            counts = [np.add.reduceat((at == i).astype(np.int64), head) for i in range(4)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (pair[head], *counts)], names=["key", "k0", "k1", "k2", "k3"])


def _representatives(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """(id, h, toxic, half), one row per distinct text of the labelled learning rows."""
    known = (labels.filter(F.col(f"`{label_col}`").isNotNull()).groupBy(F.col(f"`{id_col}`").alias("l"))
             .agg(F.max(F.col(f"`{label_col}`")).cast("int").alias("toxic")))
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = (docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(text).alias("h"), F.xxhash64(text, F.lit(1)).alias("h2"))
            .filter(remainder(F.col("id")) != 1).join(known, F.col("id") == F.col("l")))
    return (rows.groupBy("h", "h2").agg(F.min("id").alias("id"), F.max("toxic").alias("toxic"))
            .select("id", "h", "toxic", F.pmod("h", F.lit(2)).cast("int").alias("half")))


def _of_ids(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(text, toxic, half) of the documents that ``wanted`` names, each once.

    A table of 2 ** FILTER rows, whatever the number of ids, is broadcast first and drops nearly all other documents, so that
    only texts that are wanted are shuffled.
    """
    where = F.xxhash64("id", F.lit(2))
    place, bit = F.shiftrightunsigned(where, 64 - FILTER), F.expr("shiftleft(1L, cast(pmod(xxhash64(id, 2), 64) as int))")
    bitmap = wanted.groupBy(place.alias("place")).agg(F.bit_or(bit).alias("bits"))
    narrow = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    some = (narrow.withColumn("place", place).join(F.broadcast(bitmap), "place").filter(F.col("bits").bitwiseAND(bit) != 0)
            .select("id", F.xxhash64("text").alias("h"), "text"))
    return some.join(wanted, ["id", "h"]).dropDuplicates(["id", "h"]).select("text", "toxic", "half")


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        curve_rows: int = CURVE_ROWS) -> KneserNey:
    """Learn from labelled rows with crc32(id) mod 3 != 1.  A document with several labels is toxic if one says so; null
    labels and null ids teach nothing; without labels of both classes every score is the same."""
    from ..session import delete_path
    folder = _folder(docs)
    chosen = _stored(_representatives(docs, labels, id_col, text_col, label_col), f"{folder}/work/texts")
    place = (F.col("half") * 2 + F.col("toxic")).cast("byte").alias("place")
    pairs = (_of_ids(docs, chosen, id_col, text_col).select("text", place).mapInArrow(_pairs, "key long, k0 long, k1 long, k2 long, k3 long")
             .groupBy("key").agg(*[F.sum(f"k{i}").alias(f"k{i}") for i in range(4)]))
    counts = _stored(_counts(_stored(pairs, f"{folder}/work/pairs")), f"{folder}/work/counts")
    delete_path(docs.sparkSession, f"{folder}/work/pairs")
    models = [_of_counts(counts, part, f"{folder}/evidence" if part == 2 else f"{folder}/work/half-{part}") for part in range(3)]
    if models[2] is None:
        return KneserNey()
    share = min(1.0, curve_rows / max(chosen.count(), 1))
    # about curve_rows ids, so that they may be broadcast
    few = chosen.filter(F.pmod(F.xxhash64("id", F.lit(3)), F.lit(1 << 30)) < int(share * (1 << 30)))
    sample = _stored(_of_ids(docs, F.broadcast(few), id_col, text_col), f"{folder}/work/curve")
    features, truth = [], []
    for half in (0, 1):
        if models[1 - half] is not None:
            points = _with_evidence(sample.filter(F.col("half") == half), models[1 - half], keep=["toxic"]).select("row.toxic", *_MEANS, "n").toArrow()
            features.append(_features(np.column_stack([np.asarray(points[c]) for c in _MEANS]), np.asarray(points["n"])))
            truth.append(np.asarray(points["toxic"], dtype=np.float64))
    if features:
        _fit_curve(models[2], np.vstack(features), np.concatenate(truth))
    delete_path(docs.sparkSession, f"{folder}/work")  # what remains in use is the evidence of the whole
    return models[2]


def _beyond(gain: Column) -> Column:
    return F.signum(gain) * F.greatest(F.abs(gain) - MARGIN, F.lit(0.0))


def _within(gain: Column) -> Column:
    return F.greatest(F.least(gain, F.lit(MARGIN)), F.lit(-MARGIN))


def _discounted(k: Column, size: float, rate: float) -> Column:
    return F.greatest(k - F.lit(rate * size), F.lit(0.0))


#: ordinary and toxic texts with a pair, in either half and in both
_PARTS = (("k0", "k1"), ("k2", "k3"), ("k0 + k2", "k1 + k3"))


def _counts(pairs: DataFrame) -> DataFrame:
    """(tag, x, s0 ..) from (key, k0 .. k3): tag 0 the words with, for each part, the kinds of words before them in ordinary texts, in toxic
    ones, and in either; tag 1 the contexts with their texts by place; tag 2 the pairs in more than ``RARE`` texts of a class, likewise.

    Kinds are numbers of distinct 32-bit words, so two of them share one sum, one in the lower half and one in the upper.
    """
    one = [f"cast({e} > 0 as bigint)" for a, b in _PARTS for e in (a, b, f"{a} + {b}")] + ["0L"]
    kinds = [f"{one[i]} + shiftleft({one[i + 1]}, 32)" for i in range(0, len(one), 2)]
    texts = [f"k{i}" for i in range(4)] + ["0L"]
    row = lambda tag, x, sums: f"named_struct('tag', {tag}, 'x', {x}, " + ", ".join(f"'s{i}', {s}" for i, s in enumerate(sums)) + ")"
    often = f"greatest({_PARTS[2][0]}, {_PARTS[2][1]}) > {RARE}"
    both = [row(0, "shiftrightunsigned(key, 32)", kinds), row(1, "key & 4294967295L", texts)]
    sums = (pairs.select(F.explode(F.expr(f"array({', '.join(both)})")).alias("r")).select("r.*")
            .groupBy("tag", "x").agg(*[F.sum(f"s{i}").alias(f"s{i}") for i in range(_SUMS)]))
    # the pairs are counted already and pass no second shuffle
    return sums.unionByName(pairs.filter(often).select(F.expr(row(2, "key", texts)).alias("r")).select("r.*"))


def _of_counts(counts: DataFrame, part: int, path: str) -> KneserNey | None:
    """The model of one part, its strong evidence stored at ``path``; None without words in both classes."""
    from ..session import free_shuffles
    half = lambda i: F.shiftrightunsigned(f"s{i // 2}", 32) if i % 2 else F.col(f"s{i // 2}").bitwiseAND(F.lit(0xFFFFFFFF))
    kinds = counts.filter("tag = 0").select(F.col("x").alias("w"), *[half(3 * part + i).alias(c) for i, c in enumerate(("a", "b", "e"))])
    k = [F.col("a"), F.col("b")]
    sums = kinds.agg(F.sum("a").alias("s0"), F.sum("b").alias("s1"), F.sum("e").alias("s")).first()
    size = [float(sums["s0"] or 0), float(sums["s1"] or 0)]
    if not all(size):
        return None
    rate = RARE / min(size)
    own = [_discounted(k[c], size[c], rate) / F.lit(size[c]) for c in range(2)]
    used = kinds.agg(*[F.sum(own[c]).alias(f"s{c}") for c in range(2)]).first()
    word = kinds.filter("e > 0").select("w", "e", *[(own[c] + F.lit((1 - used[f"s{c}"]) / sums["s"]) * F.col("e")).alias(f"p{c}") for c in range(2)])

    texts = [F.expr(e.replace("k", "s")) for e in _PARTS[part]]
    follows = counts.filter("tag = 1").select(F.col("x").alias("v"), *[t.alias(f"n{c}") for c, t in enumerate(texts)])
    total = follows.agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).first()
    seen = [float(total["n0"]), float(total["n1"])]
    least = RARE / min(seen)
    often = (counts.filter("tag = 2").select("x", F.shiftrightunsigned("x", 32).alias("w"), F.col("x").bitwiseAND(F.lit(0xFFFFFFFF)).alias("v"),
                                             *[t.alias(f"k{c}") for c, t in enumerate(texts)])
             .filter((F.col("k0") > least * seen[0]) | (F.col("k1") > least * seen[1])))
    share = often.join(follows, "v").select("x", "v", "w", *[
        (_discounted(F.col(f"k{c}"), seen[c], least) / F.greatest(F.col(f"n{c}"), F.lit(1))).alias(f"o{c}") for c in range(2)], (F.col("k0") + F.col("k1")).alias("k"), (F.col("n0") + F.col("n1")).alias("n"))
    context = share.groupBy("v").agg(*[(1 - F.sum(f"o{c}")).alias(f"r{c}") for c in range(2)], F.max("n").alias("times"))
    context = context.withColumn("c", F.log("r1") - F.log("r0"))
    more = [F.log(F.col(f"o{c}") / F.col(f"p{c}") + F.col(f"r{c}")) for c in range(2)]
    parts = lambda gain: (_beyond(gain), _within(gain))
    both, left = parts(more[1] - more[0]), parts(F.col("c"))
    pair = share.join(context, "v").join(word, "w").select(F.lit(2).alias("tag"), "x", *[x - y for x, y in zip(both, left, strict=True)], F.col("k"))
    found = (word.select(F.lit(0), "w", *parts(F.log("p1") - F.log("p0")), "e")
             .union(context.select(F.lit(1), "v", *left, "times")).union(pair).toDF("tag", "x", "gain", "faint", "times"))
    entries = _stored(found.filter(F.col("gain") != 0).mapInArrow(_keyed, "key long, word double, pair double, faint double, times long")
                      .groupBy("key").agg(F.sum("word").alias("word"), F.sum("pair").alias("pair")), path)
    m = KneserNey(entries)
    bitmap = entries.groupBy(F.shiftrightunsigned("key", 64 - BITMAP + 6).alias("at")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(key, {64 - BITMAP}) & 63 as int))")).alias("b")).toArrow()
    m.bits[np.asarray(bitmap["at"])] = np.asarray(bitmap["b"]).view(np.uint64)
    # the eight bytes of a row are made in one task, so there is one shuffle
    place = F.shiftrightunsigned("key", 64 - FAINT)
    faint = (found.filter(F.col("faint") != 0).mapInArrow(_keyed, "key long, word double, pair double, faint double, times long")
             .select(F.shiftrightunsigned(place, 3).alias("at"), place.bitwiseAND(F.lit(7)).cast("int").alias("byte"), F.round(F.col("faint") / F.lit(_STEP)).cast("int").alias("steps"), "times").repartition("at")
             .groupBy("at", "byte").agg((F.sum(F.col("steps") * F.col("times")) / F.sum("times")).alias("mean"))
             .groupBy("at").agg(F.bit_or(F.expr("shiftleft(cast(round(mean) as bigint) & 255, 8 * byte)")).alias("b")).toArrow())
    m.faint.view(np.int64)[np.asarray(faint["at"])] = np.asarray(faint["b"])
    free_shuffles(counts.sparkSession)
    return m


def _of_pairs(pairs: DataFrame) -> KneserNey | None:
    """The model of a table (key, k0, k1)."""
    return _of_counts(_counts(pairs.select("key", "k0", "k1", F.lit(0).alias("k2"), F.lit(0).alias("k3"))), 0, _folder(pairs))


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        tag, x, gain = (np.asarray(b.column(c)) for c in ("tag", "x", "gain"))
        key = np.zeros(len(x), np.int64)
        for t in range(3):
            key[tag == t] = entry_keys(t, x[tag == t].copy())
        yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(np.where(tag == 0, gain, 0.0)), pa.array(np.where(tag == 0, 0.0, gain)),
                                          b.column("faint"), b.column("times")], names=["key", "word", "pair", "faint", "times"])


def _features(x: np.ndarray, n: np.ndarray) -> np.ndarray:
    return np.column_stack([x, x * np.sqrt(n)[:, None]])


def _fit_curve(m: KneserNey, f: np.ndarray, y: np.ndarray, rounds: int = 200, ridge: float = 1e-2) -> None:
    """Newton steps of a logistic curve that may not fall with the evidence."""
    if not 0 < y.sum() < len(y):
        return
    m.center, m.scale = np.median(f, axis=0), np.maximum(f.std(axis=0), 1e-9)
    z = np.column_stack([(f - m.center) / m.scale, np.ones(len(f))])
    used = list(range(z.shape[1]))
    while True:
        w = np.zeros(z.shape[1])
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -35, 35)))
            gradient = (z.T @ (y - p) - ridge * w)[used]
            hessian = ((z * (p * (1 - p))[:, None]).T @ z)[np.ix_(used, used)] + ridge * np.eye(len(used))
            step = np.clip(np.linalg.solve(hessian, gradient), -2, 2)
            w[used] += step
            if np.abs(step).max() < 1e-8:
                break
        if (w[:-1] >= 0).all():
            break
        used.remove(int(np.argmin(w[:-1])))  # a feature with a negative slope is left out
    m.curve = w


def _with_evidence(docs: DataFrame, m: KneserNey, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """row (a struct of the columns ``keep``, all by default), mean strong (x0, x1) and faint (y0, y1) evidence and number of words n of each
    text; strong evidence of equal texts (by 64 bits of hash) is looked up once."""
    keep = docs.columns if keep is None else keep
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.xxhash64(text).alias("a"), text.alias("text"))
    shared, table = (docs.sparkSession.sparkContext.broadcast(x) for x in (m.bits, m.faint))

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, "text", 1 << 20):
                sums, n = _faint(table.value, b.column("text"))
                mean = sums / np.maximum(n, 1)[:, None]
                yield pa.RecordBatch.from_arrays([b.column("row"), b.column("a"), pa.array(n, pa.int64()), pa.array(mean[:, 0]), pa.array(mean[:, 1])],
                                                 names=["row", "a", "n", "y0", "y1"])

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, "text", 1 << 20):
                row, key, times, _ = _hits(shared.value, b.column("text"))
                where = pa.array(row)
                yield pa.RecordBatch.from_arrays([b.column("a").take(where), pa.array(key), pa.array(times)], names=["a", "key", "n"])

    counted = keyed.mapInArrow(counts, T.StructType([*(keyed.schema[c] for c in ("row", "a")), T.StructField("n", T.LongType()),
                                                     *(T.StructField(c, T.DoubleType()) for c in _MEANS[2:])]))
    if m.entries is None:
        return counted.select("row", F.lit(0.0).alias("x0"), F.lit(0.0).alias("x1"), "y0", "y1", "n")
    found = keyed.select("a", "text").mapInArrow(hits, "a long, key long, n long")
    sums = (found.join(m.entries, "key").dropDuplicates(["a", "key"])
            .groupBy("a").agg(F.sum(F.col("word") * F.col("n")).alias("s0"), F.sum(F.col("pair") * F.col("n")).alias("s1")))
    mean = lambda c: F.coalesce(F.col(c) / F.greatest(F.col("n"), F.lit(1)), F.lit(0.0))
    return counted.join(sums, "a", "left").select("row", mean("s0").alias("x0"), mean("s1").alias("x1"), "y0", "y1", "n")


def _curve(m: KneserNey) -> Column:
    x = [F.col(c) for c in _MEANS] + [F.col(c) * F.sqrt(F.col("n")) for c in _MEANS]
    z = F.lit(float(m.curve[-1]))
    for i, c in enumerate(x):
        z = z + (c - float(m.center[i])) / float(m.scale[i]) * float(m.curve[i])
    return 1 / (1 + F.exp(-F.greatest(F.least(z, F.lit(700.0)), F.lit(-700.0))))


def score(docs: DataFrame, model: KneserNey, text_col: str = "text", result: str = "toxicity") -> DataFrame:
    """``docs`` with ``result`` (0 to 1, replacing a column of that name).  Null and empty texts, and texts without a letter
    or digit, have evidence 0; every row gets a score, repeated rows the same one; columns of any other name stay."""
    docs = docs.drop(result)
    return _with_evidence(docs, model, text_col).select("row.*", _curve(model).alias(result))


def remove_toxic(docs: DataFrame, model: KneserNey, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more; the columns stay as they are."""
    name = "_toxicity"
    while name in docs.columns:
        name += "_"
    return score(docs, model, text_col, name).filter(F.col(name) < threshold).drop(name)


def report(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    m = fit(docs, labels, id_col, text_col)
    narrow = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return _with_evidence(narrow, m, keep=["doc_id"]).withColumn("score", _curve(m)).select(
        "row.doc_id", F.coalesce(remainder(F.col("row.doc_id")) == 1, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))
