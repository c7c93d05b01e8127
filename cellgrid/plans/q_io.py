"""Registered queries: sources and sinks (round trips through the shared scratch area)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import evaluation as EV
from ..operators import slices as L
from ..operators import quality as Q
from ..schemas import ALL_FEATURES, EDGES, GOLD_WAREHOUSE, MART_CELL_HOUR_SCORES, SILVER
from ..session import _key, scratch_path
from ..sources import readers as R
from ..sources import sinks as K
from . import fixtures as fx
from .oracle_base import GOLD_COLS, GOLD_DOUBLES, KPIS, rounded, sql
from .q_graph_model import _report_sql, test_rows
from .q_layers import SILVER_COLS
from .registry import query


def to_contract(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Select and cast to a declared contract, in its column order."""
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in contract.fields])


def _path(spark, sf_dir, name):
    return scratch_path(spark, f"{name}-{_key(name, sf_dir)}")


@query("write_read_silver", sql(rounded(SILVER_COLS, KPIS, "silver"), "silver"))
def write_read_silver(spark, sf_dir):
    """S9 + S2: partitioned overwrite by (date, region), read back with partition discovery."""
    path = _path(spark, sf_dir, "silver")
    K.write_layer(fx.silver(spark, sf_dir), path, ("date", "region"))
    return R.read_layer(spark, path, SILVER, partitioned=True).select(*SILVER_COLS)


@query("load_cells", sql("SELECT DISTINCT region, cell_id FROM gold WHERE cell_id IS NOT NULL", "gold"))
def load_cells(spark, sf_dir):
    """First source that yields cells (a missing folder, then the gold layer)."""
    return R.load_cells(spark, [("parquet", _path(spark, sf_dir, "does-not-exist")), ("parquet", fx.gold_path(spark, sf_dir))])


@query("edges_from_csv", sql("SELECT src_cell_id, dst_cell_id FROM lattice", "lattice"))
def edges_from_csv(spark, sf_dir):
    """Edge list written as CSV with header and read back with a declared schema."""
    path = _path(spark, sf_dir, "edges-csv")
    K.write_csv(fx.edges(spark, sf_dir), path)
    return R.read_csv(spark, path, EDGES)


@query("normalize_columns", sql(rounded(GOLD_COLS, GOLD_DOUBLES, "gold_day"), "gold_day"))
def normalize_columns(spark, sf_dir):
    """Headers with padding and capitals are trimmed and lower-cased."""
    g = fx.gold(spark, sf_dir, "day")
    messy = g.toDF(*[f"  {c.upper()} " for c in g.columns])
    return R.normalize_columns(messy)


@query("alias_columns", sql("""
SELECT cell_id, region, 'global' AS source_region FROM cells""", "cells"))
def alias_columns(spark, sf_dir):
    """Cell/Market headers mapped to cell_id/region; a frame without region gets the default."""
    cells = fx.cells(spark, sf_dir)
    named = R.alias_columns(R.normalize_columns(cells.select(F.col("cell_id").alias(" Cell"),
                                                             F.col("region").alias("Market "))))
    no_region = R.alias_columns(cells.select(F.col("cell_id").alias("CellID")), default_region="global")
    return named.join(no_region.withColumnRenamed("region", "source_region").distinct(), "cell_id")


@query("mart_tables", sql(rounded([f.name for f in MART_CELL_HOUR_SCORES.fields],
                                  ["risk_score", "latency_ms_p95", "prb_util_pct_avg", "sinr_db_avg",
                                   "thrpt_mbps_avg"], "scored"), "scored"))
def mart_tables(spark, sf_dir):
    """Scores mart published as a catalog table (create or replace), read back."""
    mart = to_contract(fx.scored(spark, sf_dir), MART_CELL_HOUR_SCORES)
    return K.publish_table(mart, "mart_cell_hour_scores", _path(spark, sf_dir, "mart_cell_hour_scores"))


@query("alerts_export_csv", sql("""
SELECT cell_id, region, CAST(ts_hour AS VARCHAR) AS ts_hour, round(risk_score, 6) AS risk_score
FROM scored WHERE ts_hour = (SELECT max(ts_hour) FROM scored) AND risk_score >= 0.5""", "scored"))
def alerts_export_csv(spark, sf_dir):
    """Alerts written as CSV sorted by risk, read back as text columns."""
    al = L.latest_hour(fx.scored(spark, sf_dir)).filter(F.col("risk_score") >= 0.5)
    path = _path(spark, sf_dir, "alerts-csv")
    out = al.select("cell_id", "region", F.col("ts_hour").cast("string").alias("ts_hour"), "risk_score")
    K.write_csv(out.orderBy(F.col("risk_score").desc(), "cell_id"), path)
    return R.read_csv(spark, path, "cell_id string, region string, ts_hour string, risk_score double")


@query("metrics_json_lookup", sql(f"""
SELECT round((SELECT threshold FROM op_point), 6) AS threshold, round((SELECT f1 FROM op_point), 6) AS f1,
  round((SELECT f1_score FROM ({_report_sql("risk_score > 0.5")}) a WHERE label = 'macro avg'), 6) AS report_macro_f1,
  round((SELECT recall FROM ({_report_sql("risk_score >= (SELECT threshold FROM op_point)")}) b WHERE label = '1'), 6)
    AS recall_at_threshold,
  CAST({len(ALL_FEATURES)} AS INTEGER) AS n_features, CAST(0.25 AS DOUBLE) AS missing_default""", "op_point", "test_rows"))
def metrics_json_lookup(spark, sf_dir):
    """Metrics document written as JSON, reopened and extended with the operating point and the report
    there, written again, nested keys read with a default."""
    t = test_rows(spark, sf_dir).checkpoint()  # the scored test rows feed every part
    path = _path(spark, sf_dir, "metrics-json")
    K.write_metrics(K.metrics_document({
        "auc_roc": EV.auc_roc(t).select("auc_roc"), "auc_pr": EV.auc_pr(t),
        "report": K.report_part(EV.classification_report(t, threshold=0.5, strict=True)),
        "features": K.features_part(spark, ALL_FEATURES)}), path)
    point = EV.operating_point(t)
    thr = point.select("threshold").first()[0]  # one number
    K.write_metrics(K.extend_metrics(R.read_metrics(spark, path), {
        "operating_point": point,
        "report_at_threshold": K.report_part(EV.classification_report(t, threshold=thr, strict=False), "report_at_threshold")}),
        f"{path}-extended")
    m = R.read_metrics(spark, f"{path}-extended")
    return spark.range(1).select(
        R.metrics_value(m, "operating_point.threshold", 0.5).alias("threshold"),
        R.metrics_value(m, "operating_point.f1", 0.0).alias("f1"),
        R.metrics_value(m, F.col("report")["macro avg"]["f1-score"], -1.0).alias("report_macro_f1"),
        R.metrics_value(m, F.col("report_at_threshold")["1"]["recall"], -1.0).alias("recall_at_threshold"),
        m.select(F.size("features")).scalar().alias("n_features"),
        R.metrics_value(m, F.col("report")["no such label"]["precision"], 0.25).alias("missing_default"))


COERCE_TARGET = {"n_samples": "integer", "anomaly_any": "smallint", "hour": "smallint",
                 "y_next_anomaly": "boolean", "latency_ms_p95": "bigint", "ts_hour": "timestamp with time zone",
                 "region": "text", "prb_util_pct_avg": "double precision"}


@query("coerce_types", sql("""
SELECT CAST(round_even(TRY_CAST(n_samples AS DOUBLE), 0) AS BIGINT) AS n_samples,
  CAST(round_even(TRY_CAST(anomaly_any AS DOUBLE), 0) AS BIGINT) AS anomaly_any,
  CAST(round_even(TRY_CAST(hour AS DOUBLE), 0) AS BIGINT) AS hour,
  coalesce(round_even(TRY_CAST(y_next_anomaly AS DOUBLE), 0), 0.0) <> 0 AS y_next_anomaly,
  CAST(round_even(TRY_CAST(latency_ms_p95 AS DOUBLE), 0) AS BIGINT) AS latency_ms_p95,
  TRY_CAST(CAST(ts_hour AS VARCHAR) AS TIMESTAMP) AS ts_hour,
  CAST(region AS VARCHAR) AS region,
  round(TRY_CAST(prb_util_pct_avg AS DOUBLE), 6) AS prb_util_pct_avg
FROM gold""", "gold"))
def coerce_types(spark, sf_dir):
    """Coercion to sink types: integers rounded, NULL boolean -> false, bad values -> NULL."""
    g = fx.gold(spark, sf_dir).select(*COERCE_TARGET)
    return K.coerce_types(g, COERCE_TARGET)


@query("scan_silver_partitioned", sql(rounded(SILVER_COLS, KPIS, "silver"), "silver"))
def scan_silver_partitioned(spark, sf_dir):
    """The written silver layer read by its root; date and region come back from the folder names."""
    return fx.silver(spark, sf_dir).select(*SILVER_COLS)


MART_COLS = [f.name for f in MART_CELL_HOUR_SCORES.fields]
MART_DOUBLES = ["risk_score", "latency_ms_p95", "prb_util_pct_avg", "sinr_db_avg", "thrpt_mbps_avg"]


@query("mart_scores", sql(rounded(MART_COLS, MART_DOUBLES, "scored"), "scored"))
def mart_scores(spark, sf_dir):
    """Scores in the mart contract's column order and types."""
    return to_contract(fx.scored(spark, sf_dir), MART_CELL_HOUR_SCORES)


@query("warehouse_view", sql(rounded(MART_COLS, MART_DOUBLES, """(SELECT * FROM scored
  WHERE ts_hour = (SELECT max(ts_hour) FROM scored) ORDER BY risk_score DESC, cell_id, region LIMIT 50) t"""), "scored"))
def warehouse_view(spark, sf_dir):
    """The "last hour, high risk" view defined in Spark SQL over the published mart table."""
    K.publish_table(to_contract(fx.scored(spark, sf_dir), MART_CELL_HOUR_SCORES), "mart_view_source",
                    _path(spark, sf_dir, "mart_cell_hour_scores_v"))
    spark.sql("""
        CREATE OR REPLACE TEMP VIEW v_last_hour_risk AS
        WITH h AS (SELECT max(ts_hour) AS ts_hour FROM mart_view_source)
        SELECT s.* FROM mart_view_source s JOIN h ON s.ts_hour = h.ts_hour
        ORDER BY s.risk_score DESC, s.cell_id, s.region LIMIT 50""")
    return spark.table("v_last_hour_risk")


_DRIFT = [("n_samples", "int", "bigint", "CAST(n_samples AS INTEGER)", "n_samples"),
          ("anomaly_any", "tinyint", "int", "CAST(anomaly_any AS TINYINT)", "anomaly_any"),
          ("hour", "tinyint", "int", "CAST(hour AS TINYINT)", "hour"),
          ("y_next_anomaly", "tinyint", "int", "CAST(y_next_anomaly AS TINYINT)", "y_next_anomaly")]


@query("schema_drift", sql("\nUNION ALL\n".join(
    [f"""SELECT '{c}' AS "column", '{e}' AS expected, '{a}' AS actual, 'type_changed' AS status,
  CAST(count_if({x} IS NOT NULL AND TRY_{cast} IS NULL) AS BIGINT) AS n_unfit FROM gold"""
     for c, e, a, cast, x in _DRIFT]
    + ["""SELECT 'date', NULL, 'date', 'extra', CAST(NULL AS BIGINT)"""]), "gold"))
def schema_drift(spark, sf_dir):
    """Q4: gold against the warehouse contract: changed types (with values that would not fit), extras."""
    return Q.schema_drift(fx.gold(spark, sf_dir), GOLD_WAREHOUSE, check_values=True)


@query("p95_large_groups", """
SELECT l_suppkey, count(*) AS n, quantile_disc(l_extendedprice, 0.95) AS price_p95 FROM lineitem GROUP BY l_suppkey""")
def p95_large_groups(spark, sf_dir):
    """A2 on large groups: p95 of the line price per supplier.  The sketch's rank error is at most n / 10000, so
    groups of fewer than 10000 rows are exact, and larger ones are off by at most one rank in ten thousand."""
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_suppkey").agg(
        F.count("*").alias("n"), F.percentile_approx("l_extendedprice", 0.95, 10_000).alias("price_p95"))
