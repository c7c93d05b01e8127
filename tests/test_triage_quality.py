"""Triage formula edge cases and data-quality helpers."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cellgrid.operators import quality as Q
from cellgrid.operators import triage as TR
from cellgrid.operators.frames import drop_empty_columns
from cellgrid.schemas import GOLD
from cellgrid.sources import sinks as K

T0 = dt.datetime(2024, 1, 1)
COLS = ("cell_id string, region string, ts_hour timestamp_ntz, risk_score double, latency_ms_p95 double, "
        "prb_util_pct_avg double, sinr_db_avg double, thrpt_mbps_avg double, neighbor_degree long, "
        "pagerank double, betweenness double")


def scores(spark, rows):
    return spark.createDataFrame(rows, COLS)


def test_priority_with_constant_centrality_and_missing_breach(spark):
    s = scores(spark, [("a", "r", T0, 0.8, 70.0, 50.0, 5.0, 10.0, 2, 0.1, 0.0),
                       ("b", "r", T0, 0.6, 10.0, 50.0, 5.0, 10.0, 2, 0.1, 0.0),
                       ("c", "r", T0, 0.1, 10.0, 50.0, 5.0, 10.0, 9, 0.9, 0.5)])
    pb = spark.createDataFrame([("a", 0.5)], "cell_id string, p_breach double")
    out = {r.cell_id: r for r in TR.alert_priority(TR.alerts(s, 0.5), pb).collect()}
    assert set(out) == {"a", "b"}                       # c is below the threshold; scaling uses a and b only
    assert out["a"].pagerank_z == 0.0 and out["b"].p_breach == 0.0
    assert out["a"].priority == pytest.approx(0.55 * 0.8 + 0.30 * 0.5)
    assert out["b"].priority == pytest.approx(0.55 * 0.6)


def test_empty_alert_set(spark):
    s = scores(spark, [("a", "r", T0, 0.1, 70.0, 50.0, 5.0, 10.0, 2, 0.1, 0.0)])
    assert TR.alerts_table(s, 0.5, None, None).count() == 0


def test_reason_prefers_model_then_rule(spark):
    s = scores(spark, [("a", "r", T0, 0.8, 70.0, 50.0, 5.0, 10.0, 2, 0.1, 0.0),
                       ("b", "r", T0, 0.8, 10.0, 50.0, 5.0, 10.0, 2, 0.1, 0.0),
                       ("c", "r", T0, 0.8, None, 50.0, 5.0, 10.0, 2, 0.1, 0.0)])
    reasons = spark.createDataFrame([("a", "r", T0, "x, y, z"), ("b", "r", T0, "")],
                                    "cell_id string, region string, ts_hour timestamp_ntz, top_reasons string")
    out = {r.cell_id: r.reason for r in TR.alert_reason(s, reasons).collect()}
    assert out == {"a": "x, y, z", "b": "capacity pressure", "c": "capacity pressure"}


def test_dq_rules_and_gap_check(spark):
    df = spark.createDataFrame([("a", T0, 5.0), ("a", T0 + dt.timedelta(hours=3), None), ("b", T0, 120.0)],
                               "cell_id string, ts_hour timestamp_ntz, prb_util_pct_avg double")
    rules = {"present": "prb_util_pct_avg IS NOT NULL", "range": "prb_util_pct_avg BETWEEN 0 AND 100"}
    out = {r.rule: (r.failed, r.total) for r in Q.dq_rules(df, rules).collect()}
    assert out == {"present": (1, 3), "range": (2, 3)}
    gaps = {r.cell_id: (r.expected, r.present, r.missing) for r in Q.gap_check(df, "hour").collect()}
    assert gaps == {"a": (4, 2, 2), "b": (1, 1, 0)}


def test_freshness(spark):
    df = spark.createDataFrame([(T0, None, 1.0), (T0 + dt.timedelta(hours=1), 2.0, 1.0)],
                               "ts_hour timestamp_ntz, prb_util_pct_avg double, latency_ms_p95 double")
    r = Q.dq_freshness(df, F.lit(T0 + dt.timedelta(hours=2, minutes=30)).cast("timestamp_ntz")).first()
    assert r.hours_behind == pytest.approx(1.5) and r.null_prb_util_pct_avg == 0.5 and r.ok is False


def test_schema_drift(spark):
    df = spark.createDataFrame([("a", 1)], "cell_id string, n_samples int")
    out = {r.column: r.status for r in Q.schema_drift(df, GOLD).collect()}
    assert out["n_samples"] == "type_changed" and out["region"] == "missing"


def test_drop_empty_and_coerce(spark):
    df = spark.createDataFrame([("1.6", None, "x", "2024-01-01 00:00:00"), ("bad", None, None, "nope")],
                               "a string, empty string, flag string, ts string")
    assert drop_empty_columns(df).columns == ["a", "flag", "ts"]
    out = K.coerce_types(df, {"a": "bigint", "flag": "boolean", "ts": "timestamptz"}).collect()
    assert out[0].a == 2 and out[1].a is None
    assert out[0].flag is False and out[1].flag is False
    assert out[0].ts == T0 and out[1].ts is None


def test_mirror_plan(spark):
    df = spark.createDataFrame([("a", 1, 1.0, True)], "c string, i long, d double, b boolean")
    plan = {r.column: (r.sink_type, r.action) for r in K.mirror_plan(df, {"c": "text"}).collect()}
    assert plan == {"c": ("text", "keep"), "i": ("BIGINT", "add"), "d": ("DOUBLE PRECISION", "add"),
                    "b": ("BOOLEAN", "add")}
