import math

import numpy as np
import pytest

from cellgrid.llm import hard_negatives as H


def plain(rows, step, n_pos=5, n_neg=5, low=80, high=100):
    """All anchors against all rows, on Python integers."""
    clean = [(i, label, [math.floor(256 * x) for x in v]) for i, label, v in rows
             if i is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, la, qa in clean:
        if a % step:
            continue
        scored = [(-sum(x * y for x, y in zip(qa, q, strict=True)), i, label) for i, label, q in clean if i != a]
        for s, i, _ in sorted(x for x in scored if x[2] == la)[:n_pos]:
            inside = sorted(x for x in scored if x[2] != la and low * -s <= 100 * -x[0] <= high * -s)[:n_neg]
            out += [(a, i, k + 1, j, -s, -t) for k, (t, j, _) in enumerate(inside)]
    return sorted(out)


def mined(spark, rows, **options):
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    return sorted(tuple(r) for r in H.mine(df, **options).collect())


def clustered(n, d, seed, labels=4):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(6, d))
    v = (centers[rng.integers(0, 6, n)] + 0.5 * rng.normal(size=(n, d))).astype(np.float32)
    return [(i, int(rng.integers(0, labels)), [float(x) for x in v[i]]) for i in range(n)]


@pytest.mark.parametrize("block_rows", [16_384, 60])
def test_equals_brute_force_in_one_block_and_in_many(spark, block_rows):
    rows = clustered(400, 12, 1)
    got = mined(spark, rows, anchor_step=4, block_rows=block_rows)
    assert got == plain(rows, 4) and len(got) > 500


def test_copies_making_up_a_third_and_a_hot_label(spark):
    rows = clustered(300, 8, 2, labels=2)
    rows = [(i, 0 if i % 3 else label, rows[0][2] if i % 3 == 1 else v) for i, label, v in rows]
    got = mined(spark, rows, anchor_step=10, block_rows=64)
    assert got == plain(rows, 10) and got


def test_rows_that_take_no_part(spark):
    rows = clustered(60, 5, 3, labels=2)
    odd = [(None, 1, [1.0] * 5), (1000, None, [1.0] * 5), (1001, 1, None), (1002, 1, []), (1003, 1, [None, 1.0, 1.0, 1.0, 1.0]),
           (1004, 0, [float("nan")] * 5), (1005, 0, [float("inf")] * 5)]
    got = mined(spark, rows + odd, anchor_step=5)
    assert got == plain(rows, 5) and got
    assert got == mined(spark, rows + odd + [(1010, 0, [1.0] * 4), (1011, 0, [1e30] * 5)], anchor_step=5)
    assert got == mined(spark, rows + rows[:20], anchor_step=5)  # repeated rows are one


def test_zero_and_negative_scores(spark):
    rows = [(0, 0, [1.0, 0.0]), (1, 0, [0.0, 1.0]), (2, 1, [0.0, -1.0]), (3, 1, [-1.0, 0.0]), (10, 0, [-2.0, 0.0]), (4, 1, [0.0, 0.0])]
    assert mined(spark, rows, anchor_step=10) == plain(rows, 10)


def test_empty_table_and_no_anchor(spark):
    assert mined(spark, []) == [] and mined(spark, [(1, 0, [1.0]), (2, 1, [1.0])]) == []


def test_bounds_drop_rows_early():
    rng = np.random.default_rng(4)
    q = np.concatenate([rng.integers(-40, 40, (2000, 32)), 200 + rng.integers(-5, 5, (20, 32))])
    block = H.Block(np.arange(2020), np.r_[np.ones(2000, int), np.zeros(20, int)], q)
    read = []
    keep_all = H.Block.scan

    def counting(self, a, alive, keep, low, high):
        def judge(score, least, most):
            read.append(len(score))
            return keep(score, least, most)
        return keep_all(self, a, alive, judge, low, high)

    H.Block.scan = counting
    try:
        block.negatives(0, q[-1], [int(q[-1] @ q[-2])], 5, 80, 100)
    finally:
        H.Block.scan = keep_all
    assert read[0] == 2000 and len(read) < 4  # nothing is left before the last dimensions
