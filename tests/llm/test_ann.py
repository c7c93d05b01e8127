import numpy as np
import pytest

from cellgrid.llm import ann_hilbert as A


def test_hilbert_curve_visits_neighbouring_cells():
    for dims, bits in ((2, 4), (3, 3)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
        key = A.hilbert_index(cells, bits)
        assert sorted(key) == list(range(len(cells)))
        path = cells[np.argsort(key)]
        assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def _exact(ids, v, k, step):
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    out = {}
    for i in np.flatnonzero(ids % step == 0):
        s = unit @ unit[i]
        order = [j for j in np.lexsort((ids, -s)) if j != i][:k]
        out[int(ids[i])] = [int(ids[j]) for j in order]
    return out


@pytest.mark.parametrize("kind", ["isotropic", "clustered"])
def test_recall_against_brute_force(spark, kind):
    rng = np.random.default_rng(5)
    v = rng.normal(size=(4000, 32)) + (0 if kind == "isotropic" else 3 * rng.normal(size=(20, 32))[rng.integers(0, 20, 4000)])
    v[3000:3300] = v[3000]  # one vector that is very common
    ids = np.arange(4000)
    df = spark.createDataFrame([(int(i), x.tolist()) for i, x in zip(ids, v)], "vec_id long, embedding array<double>")
    got = A.nearest(df, 5, 20).toPandas()
    want = _exact(ids, v, 5, 20)
    near = {q: g.sort_values("rank") for q, g in got.groupby("query_id")}
    assert set(near) == set(want) and all(list(g["rank"]) == [1, 2, 3, 4, 5] for g in near.values())
    assert np.mean([len(set(near[q].vec_id) & set(w)) / 5 for q, w in want.items()]) >= 0.9
    same = near[3000].vec_id.tolist()
    assert same == [3001, 3002, 3003, 3004, 3005]  # ties go to the smaller id


def test_odd_vectors_and_few_candidates(spark):
    rows = [(0, [1.0, 0.0]), (50, [1.0, 1.0]), (1, [2.0, 0.0]), (2, None), (3, []), (4, [0.0, 0.0]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]),
            (7, [None, 1.0]), (8, [1.0, 2.0, 3.0]), (None, [1.0, 0.0]), (100, [0.0, 0.0])]
    got = A.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 5, 50).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r["rank"], r.vec_id) for r in got] == [(0, 1, 1), (0, 2, 50), (50, 1, 0), (50, 2, 1)]
    assert got[0].score == pytest.approx(1.0) and got[1].score == pytest.approx(0.5 ** 0.5)
    assert A.nearest(spark.createDataFrame([], "vec_id long, embedding array<float>"), 5, 50).count() == 0


@pytest.mark.parametrize("share", [3, 1.2])
def test_ties_of_very_many_copies_go_to_the_smaller_ids(spark, share):
    rng = np.random.default_rng(6)
    v = rng.normal(size=(4000, 16))
    copies = np.sort(rng.permutation(4000)[:int(4000 / share)])
    v[copies] = v[copies[0]]
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    got = {q: g.sort_values("rank").vec_id.tolist() for q, g in A.nearest(df, 5, 20).toPandas().groupby("query_id")}
    asked = [q for q in copies.tolist() if q % 20 == 0]
    assert len(asked) > 50 and len(got) == 200
    for q in asked:
        assert got[q] == [i for i in copies[:6].tolist() if i != q][:5]
