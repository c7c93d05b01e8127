"""Graph metrics against the reference's committed golden values (15 edges, 12 cells)."""

import pytest

from cellgrid.operators import graph
from cellgrid.operators.features import with_centrality

# fixed values: the committed neighbour list (k=2 lattice over three groups)
EDGES = [("CELL-008", "CELL-009"), ("CELL-008", "CELL-010"), ("CELL-009", "CELL-010"), ("CELL-009", "CELL-011"),
         ("CELL-010", "CELL-011"), ("CELL-002", "CELL-005"), ("CELL-001", "CELL-003"), ("CELL-001", "CELL-004"),
         ("CELL-003", "CELL-004"), ("CELL-003", "CELL-006"), ("CELL-004", "CELL-006"), ("CELL-004", "CELL-007"),
         ("CELL-006", "CELL-007"), ("CELL-006", "CELL-012"), ("CELL-007", "CELL-012")]

# fixed values: committed degree, PageRank and betweenness per cell
GOLDEN = {
    "CELL-001": (2, 0.0589919816723046, 0.0),
    "CELL-002": (1, 0.08333333333333333, 0.0),
    "CELL-003": (3, 0.08333333333333331, 0.01515151515151515),
    "CELL-004": (4, 0.107674684994362, 0.04848484848484848),
    "CELL-005": (1, 0.08333333333333333, 0.0),
    "CELL-006": (4, 0.107674684994362, 0.04848484848484848),
    "CELL-007": (3, 0.08333333333333331, 0.01515151515151515),
    "CELL-008": (2, 0.06826144594115915, 0.0),
    "CELL-009": (3, 0.09840522072550743, 0.00909090909090909),
    "CELL-010": (3, 0.09840522072550743, 0.00909090909090909),
    "CELL-011": (2, 0.06826144594115915, 0.0),
    "CELL-012": (2, 0.0589919816723046, 0.0),
}


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame(EDGES, "src_cell_id string, dst_cell_id string")


def test_centrality_matches_golden(edges):
    got = {r.cell_id: r for r in graph.centrality(edges).collect()}
    assert set(got) == set(GOLDEN)
    for c, (deg, pr, bt) in GOLDEN.items():
        assert got[c].neighbor_degree == deg
        assert abs(got[c].pagerank - pr) < 1e-9
        assert abs(got[c].betweenness - bt) < 1e-9
    assert abs(sum(r.pagerank for r in got.values()) - 1.0) < 1e-9


def test_betweenness_blocks_agree(edges):
    whole = {r.cell_id: r.betweenness for r in graph.betweenness(edges).collect()}
    many = {r.cell_id: r.betweenness for r in graph.betweenness(edges, block_work=7).collect()}
    assert whole.keys() == many.keys()
    assert all(abs(whole[k] - many[k]) < 1e-12 for k in whole)


def test_betweenness_of_a_path_has_a_closed_form(spark):
    n = 120
    rows = [(f"p{i:04d}", f"p{i + 1:04d}") for i in range(n - 1)] + [(f"q{i}", "qhub") for i in range(40)]
    got = {r.cell_id: r.betweenness for r in graph.betweenness(
        spark.createDataFrame(rows, "src_cell_id string, dst_cell_id string"), normalized=False, block_work=5_000).collect()}
    for i in range(n):
        assert got[f"p{i:04d}"] == pytest.approx(i * (n - 1 - i))
    assert got["qhub"] == pytest.approx(40 * 39 / 2) and got["q3"] == 0


def test_more_shortest_paths_than_a_double_holds():
    import numpy as np
    n = 1200  # a chain of diamonds doubles the paths at each step: 2 ** 1200 from end to end
    rows = [e for a in range(0, 3 * n, 3) for e in ((a, a + 1), (a, a + 2), (a + 1, a + 3), (a + 2, a + 3))]
    u, v = np.array(rows + [(b, a) for a, b in rows]).T
    total = graph._brandes(u, v, 3 * n + 1, np.arange(3 * n + 1))
    for i in (1, 600, n - 1):  # all pairs of the two sides, and half of the pairs of both vertices beside it
        assert total[3 * i] == pytest.approx(2 * 3 * i * 3 * (n - i) + 2, rel=1e-9)
    assert np.isfinite(total).all()


def test_levels_by_joins_match_golden_and_the_search_in_tasks(spark, edges):
    got = {r.cell_id: r.betweenness for r in graph.betweenness(edges, task_edges=0, state_rows=30).collect()}
    assert got.keys() == GOLDEN.keys() and all(abs(got[c] - bt) < 1e-9 for c, (_, _, bt) in GOLDEN.items())
    rows = [(f"p{i:02d}", f"p{i + 1:02d}") for i in range(13)]
    path = spark.createDataFrame(rows, "src_cell_id string, dst_cell_id string")
    got = {r.cell_id: r.betweenness for r in graph.betweenness(path, normalized=False, task_edges=0).collect()}
    assert all(got[f"p{i:02d}"] == pytest.approx(i * (13 - i)) for i in range(14))


def test_a_connected_graph_of_thousands_of_cells_by_levels(spark):
    import random
    rnd = random.Random(4)
    n = 30_000  # a tree of shortcuts keeps it connected and shallow, the rest is random; a hub sees a third of all cells
    rows = [(f"c{i}", f"c{(i - 1) // 8}") for i in range(1, n)] + [(f"c{rnd.randrange(n)}", f"c{rnd.randrange(n)}") for _ in range(n)]
    rows += [("c0", f"c{i}") for i in range(2, n, 3)]
    e = spark.createDataFrame(rows, "src_cell_id string, dst_cell_id string").repartition(8).checkpoint()
    by_levels = graph.betweenness(e, source_fraction=0.0004, task_edges=1000, state_rows=200_000)
    in_tasks = graph.betweenness(e, source_fraction=0.0004).withColumnRenamed("betweenness", "b")
    worst = by_levels.join(in_tasks, "cell_id").selectExpr("max(abs(betweenness - b))", "count(*)", "max(b)").first()
    assert worst[0] < 1e-9 and worst[1] == n and worst[2] > 0


def test_centrality_takes_stored_parts(spark, edges):
    whole = {r.cell_id: tuple(r) for r in graph.centrality(edges).collect()}
    parts = graph.centrality(edges, graph.pagerank(edges).checkpoint(), graph.betweenness(edges).checkpoint())
    assert {r.cell_id: tuple(r) for r in parts.collect()} == whole


def test_lattice_reproduces_committed_edges(spark):
    groups = {"r1": ["CELL-008", "CELL-009", "CELL-010", "CELL-011"], "r2": ["CELL-002", "CELL-005"],
              "r3": ["CELL-001", "CELL-003", "CELL-004", "CELL-006", "CELL-007", "CELL-012"]}
    cells = spark.createDataFrame([(r, c) for r, cs in groups.items() for c in cs], "region string, cell_id string")
    got = sorted(tuple(r) for r in graph.neighbor_lattice(cells, 2).collect())
    assert got == sorted(EDGES)


def test_duplicate_reversed_and_self_edges_collapse(spark):
    e = spark.createDataFrame([("a", "b"), ("b", "a"), ("a", "b"), ("b", "c"), ("c", "c")],
                              "src_cell_id string, dst_cell_id string")
    deg = {r.cell_id: r.neighbor_degree for r in graph.degree(e).collect()}
    assert deg == {"a": 1, "b": 2, "c": 1}
    bt = {r.cell_id: r.betweenness for r in graph.betweenness(e).collect()}
    assert bt["b"] == pytest.approx(1.0)   # the only bridge: 2 ordered pairs / ((3-1)(3-2))


def test_isolated_cell_gets_zero(spark, edges):
    cent = graph.centrality(edges)
    cells = spark.createDataFrame([("CELL-001",), ("CELL-999",)], "cell_id string")
    out = {r.cell_id: r for r in with_centrality(cells, cent).collect()}
    assert out["CELL-999"].neighbor_degree == 0 and out["CELL-999"].pagerank == 0.0


def test_neighbors_of(edges):
    out = graph.neighbors_of(edges, "CELL-004").collect()
    assert sorted(r.neighbor for r in out) == ["CELL-001", "CELL-003", "CELL-006", "CELL-007"]
    assert all(r.weight == 1.0 for r in out)


def test_sampled_betweenness_is_scaled(edges):
    exact = {r.cell_id: r.betweenness for r in graph.betweenness(edges).collect()}
    full = {r.cell_id: r.betweenness for r in graph.betweenness(edges, source_fraction=0.999999).collect()}
    assert exact.keys() == full.keys()


def test_pagerank_and_betweenness_wait_for_nothing_else(spark, monkeypatch):
    import __spark_entry__ as E
    from cellgrid.plans import fixtures as fx
    for name in ("pagerank", "betweenness"):
        monkeypatch.setattr(fx, name, lambda s, d, name=name: s.createDataFrame([("a", 0.5)], f"cell_id string, {name} double"))
    monkeypatch.setattr(fx, "centrality", None)
    for name in ("pagerank", "betweenness"):
        assert [tuple(r) for r in E.queries()[name](spark, "nowhere").collect()] == [("a", 0.5)]


def test_components_of_a_long_path_need_few_rounds(spark, monkeypatch):
    from cellgrid.operators import components
    rounds, step = [], components._small_star
    monkeypatch.setattr(components, "_small_star", lambda e: (rounds.append(1), step(e))[1])
    rows = [(f"a{i:04d}", f"a{i + 1:04d}") for i in range(400)] + [("b1", "b2"), ("b2", "b2"), (None, "b3"), ("b2", "b1"), ("c1", "c1")]
    got = {r.vertex: r.component for r in components.connected_components(spark.createDataFrame(rows, "u string, v string")).collect()}
    assert got == {**{f"a{i:04d}": "a0000" for i in range(401)}, "b1": "b1", "b2": "b1"}
    assert len(rounds) <= 5  # 10 when every edge went through the rounds


@pytest.mark.parametrize("limit", [3, 50, 10 ** 6])
def test_stars_of_a_task_connect_what_its_edges_connect(monkeypatch, limit):
    import random

    import pyarrow as pa

    from cellgrid.operators import components
    monkeypatch.setattr(components, "LOCAL_VERTICES", limit)
    rnd = random.Random(3)
    rows = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(200)]
    table = pa.table({"u": pa.array([a for a, _ in rows]), "v": pa.array([b for _, b in rows])})

    def parts(pairs):
        root = {x: x for x in range(300)}
        for _ in range(300):
            new = dict(root)
            for a, b in pairs:
                new[a] = new[b] = min(new[a], new[b])
            if new == root:
                return root
            root = new

    out = [r for b in components._within_tasks(iter(table.to_batches(max_chunksize=20))) for r in zip(*(c.to_pylist() for c in b.columns), strict=True)]
    assert parts(out) == parts(rows)
    assert limit < 300 or len(out) == len({a for a, b in rows} | {b for a, b in rows}) - len({parts(rows)[x] for r in rows for x in r})


def test_few_and_very_many_shortest_paths_in_one_level_are_counted_exactly():
    from fractions import Fraction

    import numpy as np
    k = 450  # diamonds of three ways, 3 ** 450 paths, beside a plain path of the same length; both end in the same vertex
    rows, at, new = [], 0, 1
    for _ in range(k):
        rows += [e for m in range(new, new + 3) for e in ((at, m), (m, new + 3))]
        at, new = new + 3, new + 4
    plain = list(range(new, new + 2 * k - 1))
    rows += list(zip([0, *plain], [*plain, at], strict=True))
    n = plain[-1] + 1
    near = [[] for _ in range(n)]
    for a, b in rows:
        near[a].append(b)
        near[b].append(a)
    sources, want = [0, 1, at, plain[3]], [Fraction(0)] * n
    for s in sources:
        far, paths, order = {s: 0}, [0] * n, [s]
        paths[s] = 1
        for x in order:
            for y in near[x]:
                if y not in far:
                    far[y] = far[x] + 1
                    order.append(y)
                if far[y] == far[x] + 1:
                    paths[y] += paths[x]
        credit = [0.0] * n  # ratios of neighbouring numbers of paths are exact, the sums are not
        for x in reversed(order[1:]):
            for y in near[x]:
                if far[y] == far[x] - 1:
                    credit[y] += float(Fraction(paths[y], paths[x])) * (1 + credit[x])
            want[x] += Fraction(credit[x])
    u, v = np.array(rows + [(b, a) for a, b in rows]).T
    got = graph._brandes(u, v, n, np.array(sources))
    assert got == pytest.approx([float(x) for x in want], rel=1e-9, abs=1e-9)
