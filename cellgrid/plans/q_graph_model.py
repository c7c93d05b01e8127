"""Registered queries: neighbour graph, centrality joins, features, split, metrics, model, attributions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import evaluation as EV
from ..operators import features as FE
from ..operators import graph as G
from ..operators import model as M
from ..operators import slices as L
from ..schemas import ALL_FEATURES, TEMPORAL_BASE
from . import fixtures as fx
from .oracle_base import GOLD_COLS, GOLD_DOUBLES, cte, rounded, sql
from .registry import query

GRAPH_DOUBLES = ["pagerank", "betweenness"]


@query("neighbor_lattice", sql("SELECT src_cell_id, dst_cell_id FROM lattice", "lattice"))
def neighbor_lattice(spark, sf_dir):
    """k=2 path lattice per region."""
    return G.neighbor_lattice(fx.cells(spark, sf_dir), k=2)


@query("degree", sql("SELECT v AS cell_id, deg AS neighbor_degree FROM deg", "deg"))
def degree(spark, sf_dir):
    """Simple undirected graph, degree per cell."""
    return G.degree(fx.edges(spark, sf_dir))


@query("pagerank", sql("SELECT cell_id, round(pagerank, 6) AS pagerank FROM pagerank", "pagerank"))
def pagerank(spark, sf_dir):
    """PageRank (0.85, tol 1e-6 per vertex, at most 100 rounds)."""
    return fx.pagerank(spark, sf_dir).select("cell_id", "pagerank")


@query("betweenness", sql("SELECT cell_id, round(betweenness, 6) AS betweenness FROM betweenness", "betweenness"))
def betweenness(spark, sf_dir):
    """Exact Brandes betweenness, normalised by (n-1)(n-2)."""
    return fx.betweenness(spark, sf_dir).select("cell_id", "betweenness")


@query("centrality", sql(rounded(["cell_id", "neighbor_degree", "pagerank", "betweenness"], GRAPH_DOUBLES,
                                 "centrality"), "centrality"))
def centrality(spark, sf_dir):
    """Degree, PageRank, betweenness per cell."""
    return fx.centrality(spark, sf_dir)


@query("neighbors_of", sql("""
SELECT n.neighbor, n.weight, c.neighbor_degree, round(c.pagerank, 6) AS pagerank,
  round(c.betweenness, 6) AS betweenness
FROM (SELECT CASE WHEN src_cell_id = 'CELL-00003' THEN dst_cell_id ELSE src_cell_id END AS neighbor, CAST(1.0 AS DOUBLE) AS weight
      FROM lattice WHERE src_cell_id = 'CELL-00003' OR dst_cell_id = 'CELL-00003') n
LEFT JOIN centrality c ON c.cell_id = n.neighbor
ORDER BY n.weight DESC, n.neighbor LIMIT 25""", "lattice", "centrality"))
def neighbors_of(spark, sf_dir):
    """One cell's neighbours with their centrality (drill-in)."""
    return G.neighbors_of(fx.edges(spark, sf_dir), "CELL-00003", fx.centrality(spark, sf_dir), 25)


GWC_COLS = GOLD_COLS + ["neighbor_degree", "pagerank", "betweenness"]


@query("gold_with_centrality", sql(rounded(GWC_COLS, GOLD_DOUBLES + GRAPH_DOUBLES, """(SELECT g.*,
  coalesce(c.neighbor_degree, 0) AS neighbor_degree, coalesce(c.pagerank, 0.0) AS pagerank,
  coalesce(c.betweenness, 0.0) AS betweenness
  FROM gold_day g LEFT JOIN centrality c ON c.cell_id = g.cell_id) t"""), "gold_day", "centrality"))
def gold_with_centrality(spark, sf_dir):
    """Vertex features joined to every cell-period, missing -> 0."""
    return FE.with_centrality(fx.gold(spark, sf_dir, "day"), fx.centrality(spark, sf_dir))


FACT_COLS = ["cell_id", "region", "ts_hour", "latency_ms_avg", "latency_ms_p95", "prb_util_pct_avg", "thrpt_mbps_avg",
             "sinr_db_avg", "rsrp_dbm_avg", "anomaly_rate", "anomaly_any", "y_next_anomaly", "neighbor_degree",
             "pagerank", "betweenness"]
FACT_DOUBLES = ["latency_ms_avg", "latency_ms_p95", "prb_util_pct_avg", "thrpt_mbps_avg", "sinr_db_avg",
                "rsrp_dbm_avg", "anomaly_rate", "neighbor_degree", "pagerank", "betweenness"]


@query("fact_cell_hour", sql(rounded(FACT_COLS, FACT_DOUBLES, """(SELECT g.cell_id, g.region, g.ts_hour,
  g.latency_ms_avg, g.latency_ms_p95, g.prb_util_pct_avg, g.thrpt_mbps_avg, g.sinr_db_avg, g.rsrp_dbm_avg,
  g.anomaly_rate, CAST(g.anomaly_any AS SMALLINT) AS anomaly_any, CAST(g.y_next_anomaly AS SMALLINT) AS y_next_anomaly,
  CAST(coalesce(c.neighbor_degree, 0) AS DOUBLE) AS neighbor_degree, coalesce(c.pagerank, 0.0) AS pagerank,
  coalesce(c.betweenness, 0.0) AS betweenness
  FROM gold g LEFT JOIN centrality c ON c.cell_id = g.cell_id) t"""), "gold", "centrality"))
def fact_cell_hour(spark, sf_dir):
    """Fact table in the warehouse contract's column order and types."""
    from .q_io import to_contract
    from ..schemas import FACT_CELL_HOUR
    g = FE.with_centrality(fx.gold(spark, sf_dir, "hour"), fx.centrality(spark, sf_dir))
    return to_contract(g, FACT_CELL_HOUR)


# ---- features and split ----

def _feature_sql(src: str) -> str:
    lag = ",\n  ".join(f"lag({c}) OVER w AS {c}_lag1" for c in TEMPORAL_BASE)
    rm = ",\n  ".join(f"avg({c}) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS {c}_rm3" for c in TEMPORAL_BASE)
    return f"""
SELECT f.*, {", ".join(f"{c} - {c}_lag1 AS {c}_chg1" for c in TEMPORAL_BASE)}
FROM (SELECT g.*, coalesce(c.neighbor_degree, 0) AS neighbor_degree, coalesce(c.pagerank, 0.0) AS pagerank,
  coalesce(c.betweenness, 0.0) AS betweenness,
  {lag},
  {rm}
  FROM {src} g LEFT JOIN centrality c ON c.cell_id = g.cell_id
  WINDOW w AS (PARTITION BY g.cell_id ORDER BY g.ts_hour, g.region)) f"""


cte("feat_raw", _feature_sql("gold_day"), "gold_day", "centrality")
cte("features", "SELECT cell_id, region, ts_hour, y_next_anomaly, "
    + ", ".join(f"coalesce(CAST({c} AS DOUBLE), 0.0) AS {c}" for c in ALL_FEATURES) + " FROM feat_raw", "feat_raw")
FEATURE_COLS = ["cell_id", "region", "ts_hour", "y_next_anomaly"] + ALL_FEATURES


def features_df(spark, sf_dir):
    return FE.features(fx.gold(spark, sf_dir, "day"), fx.centrality(spark, sf_dir))


@query("features", sql(rounded(FEATURE_COLS, ALL_FEATURES, "features"), "features"))
def features(spark, sf_dir):
    """12 base + 12 temporal + 3 graph features, nulls -> 0."""
    return features_df(spark, sf_dir)


cte("feat_raw_hour", _feature_sql("gold"), "gold", "centrality")
cte("features_hour", "SELECT cell_id, region, ts_hour, y_next_anomaly, "
    + ", ".join(f"coalesce(CAST({c} AS DOUBLE), 0.0) AS {c}" for c in ALL_FEATURES) + " FROM feat_raw_hour", "feat_raw_hour")


@query("features_hourly", sql(rounded(FEATURE_COLS, ALL_FEATURES, "features_hour"), "features_hour"))
def features_hourly(spark, sf_dir):
    """M1/W1-W4 at the reference's grain: hourly gold with the next-hour label and its features."""
    return FE.features(fx.gold(spark, sf_dir, "hour"), fx.centrality(spark, sf_dir))


@query("score_gbt_hourly")
def score_gbt_hourly(spark, sf_dir):
    """M3/M12 at the reference's grain: trained on hourly rows, scores for the last hour."""
    f = FE.features(fx.gold(spark, sf_dir, "hour"), fx.centrality(spark, sf_dir))
    train = FE.time_split(FE.training_rows(f)).filter(F.col("split") == "train")
    model = fx.risk_model(spark, sf_dir, "gbt", lambda: M.fit_risk_model(train, ALL_FEATURES, "gbt"), grain="hour")
    return M.score(model, L.latest_hour(f)).select("cell_id", "region", "ts_hour", "risk_score")


cte("labelled", "SELECT * FROM scored WHERE y_next_anomaly IS NOT NULL", "scored")
cte("test_rows", "SELECT * FROM labelled WHERE ts_hour >= (SELECT quantile_disc(ts_hour, 0.8) FROM labelled)",
    "labelled")


def labelled(spark, sf_dir):
    return FE.training_rows(fx.scored(spark, sf_dir))


def test_rows(spark, sf_dir):
    s = FE.time_split(labelled(spark, sf_dir))
    return s.filter(F.col("split") == "test").drop("split")


@query("time_split", sql("""
SELECT cell_id, region, ts_hour,
  CASE WHEN ts_hour < (SELECT quantile_disc(ts_hour, 0.8) FROM labelled) THEN 'train' ELSE 'test' END AS split
FROM labelled""", "labelled"))
def time_split(spark, sf_dir):
    """M2: chronological split, the last 20% of labelled rows by time are test."""
    return FE.time_split(labelled(spark, sf_dir)).select("cell_id", "region", "ts_hour", "split")


# ---- metrics on the deterministic score, test rows ----

cte("score_counts", """SELECT risk_score AS score, CAST(sum(y_next_anomaly) AS BIGINT) AS pos,
  CAST(sum(1 - y_next_anomaly) AS BIGINT) AS neg FROM test_rows GROUP BY risk_score""", "test_rows")
cte("pr_rows", """
SELECT score AS threshold, tp, fp, tp / (tp + fp) AS precision,
  CASE WHEN (SELECT sum(pos) FROM score_counts) = 0 THEN 1.0 ELSE tp / (SELECT sum(pos) FROM score_counts) END AS recall,
  CASE WHEN tp - pos + fp - neg = 0 THEN 1.0 ELSE (tp - pos) / (tp - pos + fp - neg) END AS prev_precision,
  CASE WHEN tp - pos + fp - neg = 0 THEN 0.0
       WHEN (SELECT sum(pos) FROM score_counts) = 0 THEN 1.0
       ELSE (tp - pos) / (SELECT sum(pos) FROM score_counts) END AS prev_recall
FROM (SELECT *, sum(pos) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS tp,
             sum(neg) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS fp FROM score_counts) c""",
    "score_counts")


@query("auc_roc", sql("""
SELECT round(sum(pos * (cum_neg - neg + 0.5 * neg)) / (sum(pos) * sum(neg)), 6) AS auc_roc,
  CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg
FROM (SELECT *, sum(neg) OVER (ORDER BY score ROWS UNBOUNDED PRECEDING) AS cum_neg FROM score_counts) c""",
                      "score_counts"))
def auc_roc(spark, sf_dir):
    """M5: rank-sum AUC on the test rows."""
    return EV.auc_roc(test_rows(spark, sf_dir))


@query("pr_curve", sql("""
SELECT threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, round(precision, 6) AS precision,
  round(recall, 6) AS recall, round(prev_precision, 6) AS prev_precision, round(prev_recall, 6) AS prev_recall
FROM pr_rows""", "pr_rows"))
def pr_curve(spark, sf_dir):
    """M6: precision/recall at every distinct threshold."""
    return EV.pr_curve(test_rows(spark, sf_dir))


@query("auc_pr", sql("""
SELECT round(sum((recall - prev_recall) * (precision + prev_precision) / 2), 6) AS auc_pr FROM pr_rows""", "pr_rows"))
def auc_pr(spark, sf_dir):
    """M6: trapezoid area under the PR curve."""
    return EV.auc_pr(test_rows(spark, sf_dir))


cte("op_point", """
SELECT threshold, precision, recall, 2 * precision * recall / (precision + recall + 1e-12) AS f1 FROM pr_rows
ORDER BY f1 DESC, threshold ASC LIMIT 1""", "pr_rows")


@query("operating_point", sql("""
SELECT threshold, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1
FROM op_point""", "op_point"))
def operating_point(spark, sf_dir):
    """M7: best-F1 threshold."""
    return EV.operating_point(test_rows(spark, sf_dir))


def _report_sql(pred: str) -> str:
    return f"""
WITH c AS (SELECT
  CAST(count_if(y_next_anomaly = 1 AND {pred}) AS DOUBLE) AS tp,
  CAST(count_if(y_next_anomaly <> 1 AND {pred}) AS DOUBLE) AS fp,
  CAST(count_if(y_next_anomaly = 1 AND NOT {pred}) AS DOUBLE) AS fn,
  CAST(count_if(y_next_anomaly <> 1 AND NOT {pred}) AS DOUBLE) AS tn FROM test_rows),
m AS (SELECT
  CASE WHEN tn + fn = 0 THEN 0 ELSE tn / (tn + fn) END AS p0, CASE WHEN tn + fp = 0 THEN 0 ELSE tn / (tn + fp) END AS r0,
  CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END AS p1, CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END AS r1,
  tn + fp AS s0, tp + fn AS s1, tp, tn FROM c),
n AS (SELECT *, CASE WHEN p0 + r0 = 0 THEN 0 ELSE 2 * p0 * r0 / (p0 + r0) END AS f0,
  CASE WHEN p1 + r1 = 0 THEN 0 ELSE 2 * p1 * r1 / (p1 + r1) END AS f1, s0 + s1 AS tot FROM m),
r AS (
  SELECT '0' AS label, p0 AS precision, r0 AS recall, f0 AS f1_score, s0 AS support FROM n
  UNION ALL SELECT '1', p1, r1, f1, s1 FROM n
  UNION ALL SELECT 'accuracy', NULL, NULL, CASE WHEN tot = 0 THEN 0 ELSE (tp + tn) / tot END, tot FROM n
  UNION ALL SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, tot FROM n
  UNION ALL SELECT 'weighted avg', (p0 * s0 + p1 * s1) / tot, (r0 * s0 + r1 * s1) / tot, (f0 * s0 + f1 * s1) / tot, tot
  FROM n)
SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1_score, 6) AS f1_score,
  CAST(support AS BIGINT) AS support FROM r"""


def _nested(body: str, *needs: str) -> str:
    # the report body has its own WITH; wrap it as a subquery after the shared CTEs
    return sql(f"SELECT * FROM ({body}) rep", *needs)


@query("classification_report", _nested(_report_sql("risk_score > 0.5"), "test_rows"))
def classification_report(spark, sf_dir):
    """M8: report at 0.5 with a strict comparison (as the reference's first report)."""
    return EV.classification_report(test_rows(spark, sf_dir), threshold=0.5, strict=True)


@query("report_at_threshold",
       _nested(_report_sql("risk_score >= (SELECT threshold FROM op_point)"), "test_rows", "op_point"))
def report_at_threshold(spark, sf_dir):
    """M8 at the operating threshold (score >= threshold)."""
    t = test_rows(spark, sf_dir)
    thr = EV.operating_point(t).select("threshold").first()[0]  # one number to the driver
    return EV.classification_report(t, threshold=thr, strict=False)


# ---- attributions with fixed linear coefficients ----

W = M.LINEAR_WEIGHTS


def _attr_union(src: str, keys: str) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT {keys}, '{f}' AS feature, abs({w!r} * ({f} - (SELECT avg({f}) FROM features))) AS a FROM {src}"
        for f, w in W.items())


cte("reasons", f"""
SELECT cell_id, region, ts_hour, string_agg(feature, ', ' ORDER BY rn) AS top_reasons
FROM (SELECT *, row_number() OVER (PARTITION BY cell_id, region, ts_hour ORDER BY a DESC, feature) AS rn
      FROM ({_attr_union("(SELECT * FROM features WHERE ts_hour = (SELECT max(ts_hour) FROM features)) x",
                         "cell_id, region, ts_hour")}) u) r
WHERE rn <= 3 GROUP BY cell_id, region, ts_hour""", "features")


def reasons_df(spark, sf_dir):
    f = features_df(spark, sf_dir)
    return M.top_reasons(L.latest_hour(f), W, 3, background=f)


@query("top_reasons", sql("SELECT * FROM reasons", "reasons"))
def top_reasons(spark, sf_dir):
    """Top-3 features by |coef * (x - mean)| for the latest rows."""
    return reasons_df(spark, sf_dir)


@query("global_attribution", sql(f"""
SELECT feature, round(avg(a), 6) AS importance
FROM ({_attr_union('''(SELECT * FROM features WHERE ts_hour >= (SELECT quantile_disc(ts_hour, 0.8)
   FROM features WHERE y_next_anomaly IS NOT NULL) AND y_next_anomaly IS NOT NULL) x''', "cell_id")}) u
GROUP BY feature""", "features"))
def global_attribution(spark, sf_dir):
    """Mean |attribution| per feature over all test rows."""
    f = features_df(spark, sf_dir)
    test = FE.time_split(FE.training_rows(f)).filter(F.col("split") == "test")
    return M.global_attribution(test, W, background=f)


# ---- pyspark.ml model (rows-only checks) ----

def _train_test(spark, sf_dir):
    f = FE.training_rows(features_df(spark, sf_dir))
    s = FE.time_split(f)
    return s.filter(F.col("split") == "train"), s.filter(F.col("split") == "test")


@query("score_gbt")
def score_gbt(spark, sf_dir):
    """Class-weighted boosted trees, scores for the latest period."""
    train, _ = _train_test(spark, sf_dir)
    model = fx.risk_model(spark, sf_dir, "gbt", lambda: M.fit_risk_model(train, ALL_FEATURES, "gbt"))
    latest = L.latest_hour(features_df(spark, sf_dir))
    return M.score(model, latest).select("cell_id", "region", "ts_hour", "risk_score")


@query("score_rf")
def score_rf(spark, sf_dir):
    """Random forest alternative."""
    train, _ = _train_test(spark, sf_dir)
    model = fx.risk_model(spark, sf_dir, "rf", lambda: M.fit_risk_model(train, ALL_FEATURES, "rf"))
    latest = L.latest_hour(features_df(spark, sf_dir))
    return M.score(model, latest).select("cell_id", "region", "ts_hour", "risk_score")


@query("feature_importance")
def feature_importance(spark, sf_dir):
    """Importances of the boosted trees."""
    train, _ = _train_test(spark, sf_dir)
    model = fx.risk_model(spark, sf_dir, "gbt", lambda: M.fit_risk_model(train, ALL_FEATURES, "gbt"))
    return M.feature_importance(model, ALL_FEATURES)


@query("model_auc_roc")
def model_auc_roc(spark, sf_dir):
    """M5 on the fitted model's test scores."""
    train, test = _train_test(spark, sf_dir)
    model = fx.risk_model(spark, sf_dir, "gbt", lambda: M.fit_risk_model(train, ALL_FEATURES, "gbt"))
    return EV.auc_roc(M.score(model, test))


def _gbt(spark, sf_dir):
    train, test = _train_test(spark, sf_dir)
    model = fx.risk_model(spark, sf_dir, "gbt", lambda: M.fit_risk_model(train, ALL_FEATURES, "gbt"))
    return model, fx.risk_model_path(spark, sf_dir, "gbt"), test


@query("top_reasons_model")
def top_reasons_model(spark, sf_dir):
    """M9: top-3 features by |Shapley value| of the boosted trees, latest period."""
    from ..operators import attribution as AT
    from ..operators import shap as S
    _, path, _ = _gbt(spark, sf_dir)
    att = S.shap_values(path, L.latest_hour(features_df(spark, sf_dir)), ALL_FEATURES)
    return AT.top_attributed(att, ALL_FEATURES, 3)


@query("top_reasons_forest")
def top_reasons_forest(spark, sf_dir):
    """M9: top-3 features by |Shapley value| of the random forest, latest period."""
    from ..operators import attribution as AT
    from ..operators import shap as S
    train, _ = _train_test(spark, sf_dir)
    fx.risk_model(spark, sf_dir, "rf", lambda: M.fit_risk_model(train, ALL_FEATURES, "rf"))
    att = S.shap_values(fx.risk_model_path(spark, sf_dir, "rf"), L.latest_hour(features_df(spark, sf_dir)), ALL_FEATURES)
    return AT.top_attributed(att, ALL_FEATURES, 3)


@query("global_attribution_model")
def global_attribution_model(spark, sf_dir):
    """Mean |Shapley value| per feature over all test rows."""
    from ..operators import attribution as AT
    from ..operators import shap as S
    _, path, test = _gbt(spark, sf_dir)
    return AT.mean_abs_attribution(S.shap_values(path, test, ALL_FEATURES), ALL_FEATURES)
