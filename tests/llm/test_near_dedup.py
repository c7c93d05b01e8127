import random

import numpy as np
import pyarrow as pa
import pytest
from plain import components_of

from cellgrid.llm import near_dedup as N
from cellgrid.llm.components import connected_components

@pytest.mark.parametrize("k", [2, 5])
def test_components_equal_brute_force(spark, k):
    rnd, docs = random.Random(k), []
    for base in range(25):
        words = [f"b{base}w{rnd.randrange(60)}" for _ in range(rnd.choice([4, 12, 40, 120]))]
        for _ in range(rnd.choice([1, 1, 3, 8])):
            w = list(words)
            for _ in range(rnd.randrange(0, max(1, len(w) // (10 if k == 2 else 30)) + 1)):
                w[rnd.randrange(len(w))] = f"e{rnd.randrange(999)}"
            docs.append(" ".join(w))
    rnd.shuffle(docs)
    rows = list(enumerate(docs)) + [(1000, None), (1001, ""), (1002, "  "), (1003, "One"), (1004, "oNE")]
    got = {r.doc_id: r for r in N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle=k).collect()}
    want, sizes = components_of(rows, k)
    assert {i: r.component_id for i, r in got.items()} == want
    assert {i: r.n_shingles for i, r in got.items()} == sizes
    assert all(r.kept == (i == r.component_id) for i, r in got.items())


def test_a_large_group_of_variants(spark, monkeypatch):
    monkeypatch.setattr(N, "DIRECT", 4)
    rnd, base = random.Random(9), [f"w{i}" for i in range(90)]
    rows = []
    for d in range(150):
        w = list(base)
        for at in rnd.sample(range(90), rnd.randrange(0, 9)):
            w[at] = f"e{d}x{at}" if rnd.random() < 0.8 else f"shared{at % 7}"
        rows.append((d + 1, " ".join(w)))
    got = {r.doc_id: r.component_id for r in N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle=2).collect()}
    want, _ = components_of(rows, 2)
    assert got == want and 1 < len(set(want.values())) < 100


def test_odd_rows_and_keep_one(odd_docs, no_docs):
    out = N.near_duplicates(odd_docs).collect()
    assert len(out) == 9
    assert [(r.component_id, r.kept) for r in out if r.doc_id is None] == [(None, True)]
    assert all(r.component_id == r.doc_id for r in out if r.doc_id is not None)
    assert N.keep_one(odd_docs).columns == odd_docs.columns and N.keep_one(odd_docs).count() == 9
    assert N.near_duplicates(no_docs).count() == 0


def test_band_collisions_follow_the_similarity():
    rng = np.random.default_rng(0)
    met = []
    for size in (5, 50, 400):
        for _ in range(60):
            a = rng.integers(0, 2**64, size, dtype=np.uint64)
            b = a.copy()
            b[:max(1, size // 9)] = rng.integers(0, 2**64, max(1, size // 9), dtype=np.uint64)
            keys = N.band_keys([np.unique(a), np.unique(b)])
            met.append((keys[0] == keys[1]).any())
    assert all(met)


def test_shingles_of_short_texts_are_their_whole_sequence():
    one, two, other, none = N.shingle_sets(pa.array(["a b c", "A  b\nc", "a b", None]), 5)
    assert len(one) == 1 and one[0] == two[0] != other[0] and len(none) == 0


def test_connected_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, k) for k in range(101, 130)] + [(200, 200), (7, 6), (None, 3), (300, 299)]
    got = {r.vertex: r.component for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert {got[k] for k in range(41)} == {0} and {got[k] for k in range(100, 130)} == {100}
    assert got[300] == got[299] == 299 and 200 not in got
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0
