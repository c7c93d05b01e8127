"""Merged sketches against exact answers."""

import datetime as dt
import random

from cellgrid.operators import sketches as S

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "ts timestamp_ntz, date date, cell_id string, region string, latency_ms double"


def silver(spark, rows):
    return spark.createDataFrame([(t, t.date(), c, r, v) for t, c, r, v in rows], SCHEMA)


def test_small_groups_are_exact_and_empty_ones_null(spark):
    rows = [(T0 + dt.timedelta(minutes=15 * i), "a", "r", float(i % 17)) for i in range(96)]
    rows += [(T0, "b", "r", None), (T0, "b", "r", None), (T0, None, "r", 4.0)]
    out = {r.cell_id: r for r in S.merged_quantile(S.quantile_layer(silver(spark, rows)), ["cell_id", "region", "date"]).collect()}
    values = sorted(float(i % 17) for i in range(96))
    assert out["a"].n == 96 and out["a"].value_q == values[91]  # 0.95 * 96 = 91.2: the 92nd value
    assert out["b"].value_q is None and out[None].value_q == 4.0


def test_large_merged_groups_keep_the_rank_bound(spark):
    pick = random.Random(5)
    rows = [(T0 + dt.timedelta(seconds=20 * i), f"c{pick.randrange(40)}", "r", pick.expovariate(0.1)) for i in range(30_000)]
    layer = S.quantile_layer(silver(spark, rows))
    values = sorted(v for *_, v in rows)
    for q in (0.5, 0.95):
        got = S.merged_quantile(layer, ["region"], q).first()
        rank = sum(v <= got.value_q for v in values) / len(values)
        assert got.n == len(rows) and abs(rank - q) < 0.0165


def test_distinct_cells_of_a_window(spark):
    rows = [(T0 + dt.timedelta(days=d), f"c{k}", f"r{k % 3}", 1.0) for d in (0, 1, 4, 9) for k in range(d * 500, d * 500 + 2000)]
    layer = S.distinct_layer(silver(spark, rows))
    got = {r.date: r.n_distinct for r in S.distinct_in_window(layer, 3).collect()}
    cells = {T0.date() + dt.timedelta(days=d): set(range(d * 500, d * 500 + 2000)) for d in (0, 1, 4, 9)}
    assert got.keys() == cells.keys()
    for day in cells:
        want = len(set().union(*(s for other, s in cells.items() if 0 <= (day - other).days < 3)))
        assert abs(got[day] - want) <= 0.04 * want


def test_empty_input(spark):
    empty = silver(spark, [])
    assert S.merged_quantile(S.quantile_layer(empty), ["cell_id"]).count() == 0
    assert S.distinct_in_window(S.distinct_layer(empty), 7).count() == 0
