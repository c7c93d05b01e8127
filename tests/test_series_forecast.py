"""Series preparation and forecast invariants."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellgrid.operators import forecast as FC
from cellgrid.operators import series as SE
from cellgrid.operators import seriesfit as SF

T0 = dt.datetime(2024, 1, 1)


def test_interpolate_fills_gap_linearly_and_holds_ends(spark):
    rows = [("a", T0, 10.0), ("a", T0 + dt.timedelta(hours=3), 40.0), ("b", T0, 5.0),
            ("a", T0 + dt.timedelta(hours=1, minutes=30), None)]
    df = spark.createDataFrame(rows, "cell_id string, ts_hour timestamp_ntz, prb_util_pct_avg double")
    out = {(r.cell_id, r.ds): (r.y, r.observed) for r in SE.interpolate(df).collect()}
    assert out[("a", T0 + dt.timedelta(hours=1))] == (20.0, False)
    assert out[("a", T0 + dt.timedelta(hours=2))] == (30.0, False)
    assert out[("a", T0 + dt.timedelta(hours=3))] == (40.0, True)
    assert out[("b", T0)] == (5.0, True)                 # single-point series
    assert len(out) == 5


def test_winsorize_clips_to_series_percentiles(spark):
    rows = [("a", T0 + dt.timedelta(hours=i), float(i)) for i in range(101)]
    df = spark.createDataFrame(rows, "cell_id string, ds timestamp_ntz, y double")
    out = SE.winsorize(df).collect()
    ys = sorted(r.y for r in out)
    assert ys[0] == pytest.approx(1.0) and ys[-1] == pytest.approx(99.0)


def test_naive_forecast_horizon_band_bounds(spark):
    rows = [("a", T0 + dt.timedelta(hours=i), 80.0 + 5 * (i % 2)) for i in range(10)]
    df = spark.createDataFrame(rows, "cell_id string, ds timestamp_ntz, y double")
    fc = FC.naive_forecast(df, horizon=12, step="hour", z=1.28, bounds=(0.0, 100.0)).collect()
    assert len(fc) == 12
    assert all(r.yhat_lower <= r.yhat <= r.yhat_upper <= 100.0 for r in fc)
    assert min(r.ds for r in fc) == T0 + dt.timedelta(hours=10)
    p = FC.breach_probability(FC.forecast_frame(df, FC.naive_forecast(df, horizon=12, step="hour", z=1.28, bounds=(0, 100)))).first()
    assert p.p_breach == 1.0   # last value 85 plus a positive band reaches 85 at every step


def test_forecast_chain_falls_back_for_short_series(spark):
    rows = [("long", T0 + dt.timedelta(hours=i), 50 + 10 * float(np.sin(2 * np.pi * i / 24))) for i in range(24 * 3)]
    rows += [("short", T0 + dt.timedelta(hours=i), 40.0) for i in range(5)]
    df = spark.createDataFrame(rows, "cell_id string, ds timestamp_ntz, y double")
    out = FC.forecast(df, horizon=6, bounds=(0.0, 100.0)).collect()
    models = {(r.cell_id, r.model) for r in out if r.model != "observed"}
    assert ("short", "naive_last") in models
    assert any(c == "long" and m in ("fourier_logistic", "holt_winters") for c, m in models)
    pred = [r for r in out if r.model != "observed"]
    assert len(pred) == 12 and all(0.0 <= r.yhat_lower <= r.yhat <= r.yhat_upper <= 100.0 for r in pred)
    summ = {r.cell_id: r for r in FC.forecast_summary(FC.forecast(df, horizon=6)).collect()}
    assert summ["short"].n_forecast == 6 and summ["short"].n_observed == 5


def test_no_series_past_the_gate_is_lost(spark):
    rows = [(f"c{n}", T0 + dt.timedelta(days=i), 50.0 + i % 7) for n in (5, 9, 13, 14, 30) for i in range(n)]
    df = spark.createDataFrame(rows, "cell_id string, ds timestamp_ntz, y double")
    out = FC.forecast(df, horizon=3, step="day", methods=("fourier", "hw"), season=7, hist=4, min_points=9)
    models = {}
    for r in out.collect():
        models.setdefault(r.cell_id, []).append(r.model)
    assert set(models) == {"c9", "c13", "c14", "c30"}          # c5 is below the gate
    assert {r.cell_id for r in FC.rejected_series(out).collect()} == {"c9", "c13"}
    assert all(sum(m not in ("observed", "rejected") for m in models[c]) == 3 for c in ("c14", "c30"))
    assert FC.breach_probability(out, 10.0, 3).count() == 2
    assert {r.cell_id for r in SE.short_series(df, 9).collect()} == {"c5"}


def test_errors_in_a_fit_are_not_swallowed(monkeypatch):
    monkeypatch.setattr(SF, "holt_winters", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        SF.fit_matrix(np.ones((3, 20)), ("hw", "naive"), 2, 7)


def test_series_of_one_length_meet_and_matrices_stay_small(spark, monkeypatch):
    import numpy as np
    import pyarrow as pa
    from cellgrid.operators import forecast as FC
    rows = spark.range(160).selectExpr("concat('c', id) AS cell_id", "explode(sequence(0, 20 + cast(id % 8 as int))) AS i")
    series = rows.selectExpr("cell_id", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(i) AS ds", "cast(i % 7 as double) AS y")
    out = FC.forecast(series, "cell_id", 3, "day", ("naive",), 7, 40)
    per_cell = out.groupBy("cell_id").agg(F.count_if(F.col("model") == "observed").alias("n"))
    at = out.select("cell_id", F.spark_partition_id().alias("p")).distinct().join(per_cell, "cell_id")
    assert at.select("n").distinct().count() == 8 and at.select("n", "p").distinct().count() < 8 + 8

    sizes = []
    whole = FC.fit_matrix
    monkeypatch.setattr(FC, "fit_matrix", lambda y, *a: sizes.append(len(y)) or whole(y, *a))
    n = 1500
    batch = pa.RecordBatch.from_pydict({"cell_id": [f"c{i}" for i in range(n)],
                                        "ds": pa.array([[d * 86_400_000_000 for d in range(30)]] * n, pa.list_(pa.timestamp("us"))),
                                        "y": np.random.default_rng(1).random((n, 30)).tolist()})
    run = FC._fit_batches("cell_id", 12, "day", ("trend_multiplicative",), 7, 14, (0.0, 100.0))
    found = sum(b.num_rows for b in run(iter([batch])))
    assert found == n * (14 + 12) and sum(sizes) == n and max(sizes) * FC.SIMULATIONS * 12 <= FC.FIT_NUMBERS
