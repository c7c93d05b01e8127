"""Binary classification metrics as DataFrame jobs.

Rows are first reduced to one row per distinct score (positives, negatives) with a
partial aggregate; running sums over the distinct scores use the range-partitioned
prefix helper, which stores that reduced frame once, so no step needs a single-partition
window and the scored plan runs once for each metric.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .prefix import prefix_sums

EPS = 1e-12


def score_counts(df: DataFrame, score: str = "risk_score", label: str = "y_next_anomaly") -> DataFrame:
    y = F.col(label).cast("long")
    return (df.filter(F.col(label).isNotNull() & F.col(score).isNotNull())
            .groupBy(F.col(score).alias("score"))
            .agg(F.sum(y).alias("pos"), F.sum(1 - y).alias("neg")))


def auc_roc(df: DataFrame, score: str = "risk_score", label: str = "y_next_anomaly") -> DataFrame:
    """Mann-Whitney AUC with mid-ranks for ties: sum_s pos(s) * (neg below s + neg(s)/2) / (P * N)."""
    cnt = score_counts(df, score, label)
    cum = prefix_sums(cnt, [F.col("score").asc()], ["neg"])
    return cum.agg(
        F.try_divide(F.sum(F.col("pos") * (F.col("cum_neg") - F.col("neg") + 0.5 * F.col("neg"))),
                     (F.sum("pos") * F.sum("neg")).cast("double")).alias("auc_roc"),
        F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"))


def pr_curve(df: DataFrame, score: str = "risk_score", label: str = "y_next_anomaly") -> DataFrame:
    """Precision/recall at every distinct score threshold (predict positive when score >= threshold).

    Also returns the previous point (next higher threshold; (recall 0, precision 1) at the top),
    which makes the trapezoid area a plain sum.
    """
    cnt = score_counts(df, score, label)
    cum = prefix_sums(cnt, [F.col("score").desc()], ["pos", "neg"], totals=True)
    total_pos = F.col("total_pos")
    tp, fp = F.col("cum_pos"), F.col("cum_neg")
    ptp, pfp = tp - F.col("pos"), fp - F.col("neg")
    recall = F.when(total_pos == 0, F.lit(1.0)).otherwise(tp / total_pos)
    prev_recall = F.when(total_pos == 0, F.lit(1.0)).otherwise(ptp / total_pos)
    return cum.select(
        F.col("score").alias("threshold"),
        tp.alias("tp"), fp.alias("fp"),
        (tp / (tp + fp)).alias("precision"),
        recall.alias("recall"),
        F.when(ptp + pfp == 0, F.lit(1.0)).otherwise(ptp / (ptp + pfp)).alias("prev_precision"),
        F.when(ptp + pfp == 0, F.lit(0.0)).otherwise(prev_recall).alias("prev_recall"))


def auc_pr(df: DataFrame, score: str = "risk_score", label: str = "y_next_anomaly") -> DataFrame:
    """Trapezoid area under the PR curve (recall on x), end point (recall 0, precision 1) included."""
    c = pr_curve(df, score, label)
    return c.agg(F.sum((F.col("recall") - F.col("prev_recall"))
                       * (F.col("precision") + F.col("prev_precision")) / 2).alias("auc_pr"))


def operating_point(df: DataFrame, score: str = "risk_score", label: str = "y_next_anomaly") -> DataFrame:
    """Threshold with the best F1 (epsilon 1e-12); ties go to the lowest threshold.

    The threshold returned is the one that attains the best F1 (the reference shifts
    the index by one, so its recorded threshold and report disagree).
    """
    c = pr_curve(df, score, label)
    f1 = 2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall") + EPS)
    return (c.select("threshold", "precision", "recall", f1.alias("f1"))
            .orderBy(F.col("f1").desc(), F.col("threshold").asc()).limit(1))


def _safe_div(a, b):
    return F.when(b == 0, F.lit(0.0)).otherwise(a / b)


def _f1(p, r):
    return F.when(p + r == 0, F.lit(0.0)).otherwise(2 * p * r / (p + r))


def classification_report(df: DataFrame, score: str = "risk_score", label: str = "y_next_anomaly",
                          threshold: float | F.Column = 0.5, strict: bool = True) -> DataFrame:
    """Per-class precision/recall/F1/support, accuracy, macro and weighted averages.

    One aggregation pass for the confusion counts; ``strict`` predicts positive on
    ``score > threshold`` (the reference's 0.5 report) else ``score >= threshold``.
    Zero divisions give 0.
    """
    thr = threshold if isinstance(threshold, F.Column) else F.lit(float(threshold))
    pred = (F.col(score) > thr) if strict else (F.col(score) >= thr)
    y = F.col(label).cast("int") == 1
    pred = F.coalesce(pred, F.lit(False))
    base = df.filter(F.col(label).isNotNull())
    c = base.agg(F.count_if(y & pred).alias("tp"), F.count_if(~y & pred).alias("fp"),
                 F.count_if(y & ~pred).alias("fn"), F.count_if(~y & ~pred).alias("tn"))
    tp, fp, fn, tn = (F.col(x).cast("double") for x in ("tp", "fp", "fn", "tn"))
    p1, r1 = _safe_div(tp, tp + fp), _safe_div(tp, tp + fn)
    p0, r0 = _safe_div(tn, tn + fn), _safe_div(tn, tn + fp)
    s1, s0 = tp + fn, tn + fp
    tot = s0 + s1
    m = c.select(
        p0.alias("p0"), r0.alias("r0"), _f1(p0, r0).alias("f0"), s0.alias("s0"),
        p1.alias("p1"), r1.alias("r1"), _f1(p1, r1).alias("f1"), s1.alias("s1"),
        _safe_div(tp + tn, tot).alias("acc"), tot.alias("tot"))
    rows = m.select(F.expr("""stack(5,
        '0', p0, r0, f0, s0,
        '1', p1, r1, f1, s1,
        'accuracy', CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), acc, tot,
        'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, tot,
        'weighted avg', try_divide(p0 * s0 + p1 * s1, tot), try_divide(r0 * s0 + r1 * s1, tot),
        try_divide(f0 * s0 + f1 * s1, tot), tot
      ) AS (label, precision, recall, f1_score, support)"""))
    return rows.withColumn("support", F.col("support").cast("long"))
