"""Invariants for the registered rows-only forecast queries on the smallest driver tables."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name,horizon,hist,bounded", [("forecast_hw", 12, 14, True),
                                                       ("forecast_fourier", 12, 14, True),
                                                       ("forecast_latency", 14, 14, False)])
def test_forecast_invariants(spark, name, horizon, hist, bounded):
    fc = E.queries()[name](spark, SF).cache()
    rejected = {r.cell_id for r in fc.filter(F.col("model") == "rejected").collect()}
    pred = fc.filter(~F.col("model").isin("observed", "rejected"))
    per_cell = {r.cell_id: r.n for r in pred.groupBy("cell_id").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert per_cell and set(per_cell.values()) == {horizon}
    obs = {r.cell_id: r.n for r in fc.filter(F.col("model") == "observed").groupBy("cell_id")
           .agg(F.count(F.lit(1)).alias("n")).collect()}
    assert obs.keys() == per_cell.keys() | rejected and not per_cell.keys() & rejected and max(obs.values()) <= hist
    assert len(per_cell) > 12  # real cells, not a handful of merged ones
    bad = pred.filter(~((F.col("yhat_lower") <= F.col("yhat")) & (F.col("yhat") <= F.col("yhat_upper")))).count()
    assert bad == 0
    if bounded:
        assert pred.filter((F.col("yhat_lower") < 0) | (F.col("yhat_upper") > 100)).count() == 0
    # forecasts start right after each series' last observed point
    last_obs = fc.filter(F.col("model") == "observed").groupBy("cell_id").agg(F.max("ds").alias("last"))
    first_fc = pred.groupBy("cell_id").agg(F.min("ds").alias("first"))
    gap = last_obs.join(first_fc, "cell_id").select(
        F.max(F.timestamp_diff("HOUR", F.col("last"), F.col("first"))).alias("g"),
        F.min(F.timestamp_diff("HOUR", F.col("last"), F.col("first"))).alias("h")).first()
    assert gap.g == 24 and gap.h == 24


def test_latest_rows_prune_the_other_dates(spark):
    from cellgrid.operators import aggregates as A
    from cellgrid.operators import slices as L
    from cellgrid.plans import fixtures as fx
    gold = fx.gold(spark, SF, "hour")

    def plan(df):
        return df._jdf.queryExecution().toString()
    for df in (L.latest_hour(gold), L.recent_window(gold, "ts_hour", 12), A.slo_latest(gold)):
        text = plan(df)
        assert "PartitionFilters: []" not in text.split("== Physical Plan ==")[1].split("Subquery")[0], text[-3000:]
    assert "Expand" not in plan(A.cell_counts(gold))


def test_model_keys_over_the_smallest_tables(spark, monkeypatch):
    """All model keys run; a few trees are enough for that."""
    from cellgrid.operators import model as M
    from cellgrid.plans import fixtures as fx
    monkeypatch.setenv("CELLGRID_VERSION", "test-few-trees")
    real = M.fit_risk_model
    monkeypatch.setattr(M, "fit_risk_model", lambda train, features, kind="gbt", **kw: real(train, features, kind, n_trees=5))
    q = E.queries()
    for name in ("score_gbt", "score_rf", "score_gbt_hourly"):
        rows = q[name](spark, SF).collect()
        assert rows and all(0 <= r.risk_score <= 1 for r in rows) and len({r.ts_hour for r in rows}) == 1
    assert q["feature_importance"](spark, SF).agg(F.sum("importance")).first()[0] == pytest.approx(1.0, abs=1e-4)
    assert 0 <= q["model_auc_roc"](spark, SF).first().auc_roc <= 1
    for name in ("top_reasons_model", "top_reasons_forest"):
        assert all(len(r.top_reasons.split(", ")) == 3 for r in q[name](spark, SF).collect())
    assert q["global_attribution_model"](spark, SF).count() == 27
    alerts = q["alerts_model"](spark, SF)
    assert alerts.count() > 0 and "priority" in alerts.columns
    assert fx.risk_model_path(spark, SF, "rf").endswith(fx.risk_model_path(spark, SF, "rf")[-16:])
