"""Silver/gold/label semantics on tiny hand-made frames (nulls, NaN, gaps, two regions per hour)."""

import datetime as dt
import math

from cellgrid.operators import layers
from cellgrid.schemas import BRONZE

T0 = dt.datetime(2024, 1, 1, 0, 0)


def row(ts, cell="C1", region="r1", rsrp=-90.0, sinr=10.0, prb=50.0, lat=30.0):
    return (ts, cell, region, rsrp, -10.0, sinr, prb, 100.0, 0.1, lat, 1.0, 0.1)


def bronze(spark, rows):
    return spark.createDataFrame(rows, BRONZE)


def test_silver_flags_three_valued(spark):
    rows = [row(T0, lat=None, prb=90.0), row(T0 + dt.timedelta(minutes=15), lat=None, prb=10.0),
            row(T0 + dt.timedelta(minutes=30), lat=70.0, prb=10.0), row(T0 + dt.timedelta(minutes=45), lat=10.0)]
    out = {r.ts: r for r in layers.silver(bronze(spark, rows)).collect()}
    assert out[T0].anomaly_flag == 1                                   # NULL OR true
    assert out[T0 + dt.timedelta(minutes=15)].anomaly_flag is None     # NULL OR false
    assert out[T0 + dt.timedelta(minutes=30)].anomaly_flag == 1
    assert out[T0 + dt.timedelta(minutes=45)].anomaly_flag == 0


def test_silver_nan_is_null_and_screen(spark):
    rows = [row(T0, prb=float("nan")), row(T0, rsrp=None), row(T0, sinr=float("nan")), row(T0, region=None)]
    out = layers.silver(bronze(spark, rows)).collect()
    assert len(out) == 2                       # null rsrp and NaN sinr are screened out
    assert all(r.prb_util_pct is None or not math.isnan(r.prb_util_pct) for r in out)
    assert sorted(r.region for r in out) == ["r1", "unknown"]
    nan_row = [r for r in out if r.prb_util_pct is None][0]
    assert nan_row.prb_high is None            # NaN > 85 would be true in Spark; we made it NULL


def test_gold_rollup_and_exact_p95(spark):
    lats = [10.0, 20.0, 30.0, 40.0]
    rows = [row(T0 + dt.timedelta(minutes=15 * i), lat=v) for i, v in enumerate(lats)]
    g = layers.gold(layers.silver(bronze(spark, rows))).collect()
    assert len(g) == 1
    r = g[0]
    assert r.n_samples == 4 and r.latency_ms_avg == 25.0 and r.latency_ms_p95 == 40.0
    assert r.ts_hour == T0 and r.hour == 0 and r.date == T0.date()
    assert r.anomaly_rate == 0.0 and r.anomaly_any == 0 and r.y_next_anomaly is None


def test_label_row_mode_skips_gap_strict_does_not(spark):
    hours = [0, 1, 3]
    rows = [row(T0 + dt.timedelta(hours=h), lat=100.0 if h == 3 else 10.0) for h in hours]
    s = layers.silver(bronze(spark, rows))
    row_mode = {r.hour: r.y_next_anomaly for r in layers.gold(s).collect()}
    strict = {r.hour: r.y_next_anomaly for r in layers.gold(s, strict_label=True).collect()}
    assert row_mode == {0: 0, 1: 1, 3: None}
    assert strict == {0: 0, 1: None, 3: None}


def test_two_regions_in_one_cell_hour_is_deterministic(spark):
    rows = [row(T0, region="b", lat=100.0), row(T0, region="a", lat=10.0),
            row(T0 + dt.timedelta(hours=1), region="a", lat=10.0)]
    s = layers.silver(bronze(spark, rows))
    out = {(r.region, r.hour): r.y_next_anomaly for r in layers.gold(s).collect()}
    # order within the hour is (ts_hour, region): a, then b, then next hour
    assert out == {("a", 0): 1, ("b", 0): 0, ("a", 1): None}
