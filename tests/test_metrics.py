"""Classification metrics vs plain-Python calculations on seeded random frames, and the committed arithmetic."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellgrid.operators import evaluation as EV


def frame(spark, n=400, seed=7, ties=True):
    rnd = random.Random(seed)
    rows = []
    for _ in range(n):
        y = 1 if rnd.random() < 0.15 else 0
        s = rnd.random() * 0.5 + 0.3 * y
        if ties:
            s = round(s, 2)
        rows.append((s, y))
    return spark.createDataFrame(rows, "risk_score double, y_next_anomaly int"), rows


def py_auc(rows):
    pos = [s for s, y in rows if y == 1]
    neg = [s for s, y in rows if y == 0]
    tot = sum((1.0 if p > q else 0.5 if p == q else 0.0) for p in pos for q in neg)
    return tot / (len(pos) * len(neg))


def py_pr(rows):
    """Precision/recall at each distinct threshold (score >= t), descending, plus the (0, 1) end point."""
    P = sum(y for _, y in rows)
    pts = []
    for t in sorted({s for s, _ in rows}, reverse=True):
        tp = sum(1 for s, y in rows if s >= t and y == 1)
        fp = sum(1 for s, y in rows if s >= t and y == 0)
        pts.append((t, tp / (tp + fp), tp / P))
    return pts


def py_auc_pr(pts):
    area, pr, pp = 0.0, 0.0, 1.0
    for _, p, r in pts:
        area += (r - pr) * (p + pp) / 2
        pr, pp = r, p
    return area


@pytest.mark.parametrize("seed,ties", [(7, True), (11, False), (3, True)])
def test_auc_roc_matches_pairwise(spark, seed, ties):
    df, rows = frame(spark, seed=seed, ties=ties)
    got = EV.auc_roc(df).first().auc_roc
    assert got == pytest.approx(py_auc(rows), abs=1e-12)


@pytest.mark.parametrize("seed", [7, 11])
def test_pr_curve_and_area(spark, seed):
    df, rows = frame(spark, seed=seed)
    pts = py_pr(rows)
    got = sorted(((r.threshold, r.precision, r.recall) for r in EV.pr_curve(df).collect()), reverse=True)
    assert len(got) == len(pts)
    for a, b in zip(got, pts):
        assert a == pytest.approx(b, abs=1e-12)
    assert EV.auc_pr(df).first().auc_pr == pytest.approx(py_auc_pr(pts), abs=1e-12)


def test_operating_point_best_f1_lowest_threshold_on_ties(spark):
    df, rows = frame(spark, seed=5)
    pts = py_pr(rows)
    f1 = [(2 * p * r / (p + r + 1e-12), t) for t, p, r in pts]
    best = max(v for v, _ in f1)
    thr = min(t for v, t in f1 if v == best)
    got = EV.operating_point(df).first()
    assert got.threshold == thr and got.f1 == pytest.approx(best)


def test_report_reproduces_committed_arithmetic(spark):
    # fixed values: the committed report at its threshold: 76 negatives, 11 positives, 7 TP of 22 flagged
    rows = [(0.9, 1)] * 7 + [(0.9, 0)] * 15 + [(0.1, 1)] * 4 + [(0.1, 0)] * 61
    df = spark.createDataFrame(rows, "risk_score double, y_next_anomaly int")
    rep = {r.label: r for r in EV.classification_report(df, threshold=0.5, strict=False).collect()}
    assert rep["1"].precision == pytest.approx(0.3181818, abs=1e-6)
    assert rep["1"].recall == pytest.approx(0.6363636, abs=1e-6)
    assert rep["1"].f1_score == pytest.approx(0.4242424, abs=1e-6)
    assert rep["1"].support == 11 and rep["0"].support == 76
    assert rep["accuracy"].f1_score == pytest.approx(68 / 87)


def test_report_strict_vs_inclusive(spark):
    df = spark.createDataFrame([(0.5, 1), (0.4, 0)], "risk_score double, y_next_anomaly int")
    strict = {r.label: r for r in EV.classification_report(df, threshold=0.5, strict=True).collect()}
    incl = {r.label: r for r in EV.classification_report(df, threshold=0.5, strict=False).collect()}
    assert strict["1"].recall == 0.0 and incl["1"].recall == 1.0


def test_single_class_and_empty_inputs_do_not_fail(spark):
    one = spark.createDataFrame([(0.3, 0), (0.6, 0)], "risk_score double, y_next_anomaly int")
    assert EV.auc_roc(one).first().auc_roc is None
    empty = one.limit(0)
    rep = {r.label: r for r in EV.classification_report(empty).collect()}
    assert rep["weighted avg"].precision is None and rep["accuracy"].support == 0


@pytest.mark.parametrize("reuse", ["true", "false"])
def test_auc_of_many_distinct_scores_is_exact_and_repeatable(spark, reuse):
    """400,000 distinct scores over many ranges, with and without exchange reuse, three runs each."""
    before = spark.conf.get("spark.sql.exchange.reuse", "true")
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    try:
        df = spark.range(400_000, numPartitions=16).select(
            (F.pmod(F.xxhash64("id"), F.lit(1 << 40)) / F.lit(float(1 << 40)) + F.col("id") * 1e-13).alias("risk_score"), "id")
        df = df.withColumn("y_next_anomaly", (F.rand(3) < F.col("risk_score") * 0.5).cast("int")).checkpoint()
        pdf = df.toPandas().sort_values("risk_score")
        y = pdf.y_next_anomaly.to_numpy()
        below = np.cumsum(1 - y)
        exact = float((y * below).sum()) / (y.sum() * (1 - y).sum())
        for _ in range(3):
            assert EV.auc_roc(df).first().auc_roc == pytest.approx(exact, abs=1e-9)
        curve = EV.pr_curve(df)
        assert curve.agg(F.max("recall")).first()[0] == 1.0
    finally:
        spark.conf.set("spark.sql.exchange.reuse", before)
