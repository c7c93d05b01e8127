import hashlib
import math
import random
import zlib

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from cellgrid.llm import importance as I
from cellgrid.llm.crc_table import crc32

from plain import tokens


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=700), st.lists(st.tuples(st.integers(0, 700), st.integers(0, 700)), min_size=1, max_size=20))
def test_checksums_equal_the_library(data, spans):
    spans = [(min(a, b, len(data)), min(max(a, b), len(data))) for a, b in spans]
    starts, ends = np.array(spans).T
    assert crc32(np.frombuffer(data, np.uint8), starts, ends).tolist() == [zlib.crc32(data[a:b]) for a, b in spans]


def test_checksums_of_long_spans():
    data = np.random.default_rng(1).integers(0, 256, 500_000).astype(np.uint8)
    starts, ends = np.array([0, 1, 63, 64, 100]), np.array([500_000, 65, 127, 129, 400_001])
    assert crc32(data, starts, ends).tolist() == [zlib.crc32(data[a:b].tobytes()) for a, b in zip(starts, ends, strict=True)]


def features(text, longest=2):
    w = tokens(text)
    return [" ".join(w[i:i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1)]


def plain(docs, items):
    of = lambda t: [zlib.crc32(f.encode()) % I.BUCKETS for f in features(t)]
    s, t = [0] * I.BUCKETS, [0] * I.BUCKETS
    for x in docs:
        for b in of(x[1]):
            s[b] += 1
    for x in items:
        for b in of(x):
            t[b] += 1
    top, bottom = float(sum(s) + I.BUCKETS), float(sum(t) + I.BUCKETS)
    gain = [math.floor(1000 * math.log(((t[b] + 1) * top) / ((s[b] + 1) * bottom))) for b in range(I.BUCKETS)]
    out = []
    for i, x in docs:
        f = of(x)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(tokens(x)), len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    long_enough = sorted((-r[4], r[0]) for r in out if r[1] >= I.LEAST_WORDS)
    drawn = {i: k + 1 for k, (_, i) in enumerate(long_enough[:25 * len(long_enough) // 100])}
    return sorted((*r, drawn.get(r[0])) for r in out)


def corpus(n):
    rng = random.Random(2)
    vocab = [f"w{i}" for i in range(300)] + ["é", "世界", "Ab", "x" * 200]
    return [(i, None if i % 50 == 7 else " ".join(rng.choice(vocab) for _ in range(rng.randint(0, 60)))) for i in range(n)]


def test_ranking_equals_plain_python(spark):
    docs = corpus(400)
    items = [" ".join(f"w{i}" for i in range(40)), None, "", "é 世界 ab"]
    got = I.ranked(spark.createDataFrame(docs, "doc_id long, text string").repartition(6),
                   spark.createDataFrame([(i, x) for i, x in enumerate(items)], "item_id long, text string"))
    rows = sorted(tuple(r) for r in got.select("doc_id", "n_words", "n_features", "weight", "score", "rank").collect())
    assert rows == plain(docs, items)


def test_runs_of_three_words():
    row, bucket, n = I.buckets(pa.array(["a b c", None, "d"]), longest=3, n_buckets=1 << 20)
    want = [(0, f) for f in ["a", "b", "c", "a b", "b c", "a b c"]] + [(2, "d")]
    assert sorted(zip(row.tolist(), bucket.tolist(), strict=True)) == sorted((r, zlib.crc32(f.encode()) % (1 << 20)) for r, f in want)
    assert n.tolist() == [3, 0, 1]


def test_target_like_documents_are_drawn_more_often(spark):
    near = [(i, " ".join(f"t{(i * 7 + j) % 50}" for j in range(40)), "near") for i in range(200)]
    far = [(1000 + i, " ".join(f"u{(i * 7 + j) % 50}" for j in range(40)), "far") for i in range(600)]
    docs = spark.createDataFrame(near + far, "doc_id long, text string, score string")
    target = spark.createDataFrame([(" ".join(f"t{j}" for j in range(50)),)] * 200, "text string")
    drawn = I.resample(docs, target)
    assert drawn.columns == docs.columns
    of = {r.score: r["count"] for r in drawn.groupBy("score").count().collect()}
    assert sum(of.values()) == 200 and of["near"] > 150


def test_odd_rows(spark, odd_docs, no_docs):
    target = spark.createDataFrame([(None,), ("ab word",)], "text string")
    assert I.ranked(no_docs, target).count() == 0 and I.ranked(odd_docs, target.limit(0)).count() == odd_docs.count()
    rows = I.ranked(odd_docs, target).collect()
    assert len(rows) == odd_docs.count() and all(r.weight == 0 for r in rows if not r.n_features)
    assert not any(r.rank for r in rows)  # two texts have 20 words; 25 % of them is none


def test_draw_size(spark):
    docs = [(i, "a b c d e f g h i j k l m n o p q r s t" + " u" * (i % 2) if i else None) for i in range(11)]
    rows = I.ranked(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([("a",)], "text string"), percent=35).collect()
    assert sorted(r.rank for r in rows if r.rank) == [1, 2, 3]
