"""Registered queries: projections, slices, top-k, aggregates, SLOs and data quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalar as S
from ..operators import aggregates as A
from ..operators import quality as Q
from ..operators import sketches as K
from ..operators import slices as L
from ..sources import readers as R
from . import fixtures as fx
from .oracle_base import GOLD_COLS, GOLD_DOUBLES, KPIS, rounded, sql
from .q_layers import SILVER_COLS
from .registry import query

PRESENT = ["ts", "cell_id", "anomaly_flag", "latency_ms", "prb_util_pct", "thrpt_mbps", "date", "region"]
WANTED = PRESENT + ["not_a_column"]
SCORE_COLS = ["cell_id", "region", "ts_hour", "risk_score", "latency_ms_p95", "prb_util_pct_avg", "sinr_db_avg",
              "thrpt_mbps_avg"]
SCORE_DOUBLES = ["risk_score", "latency_ms_p95", "prb_util_pct_avg", "sinr_db_avg", "thrpt_mbps_avg"]


def scores_plain(spark, sf_dir):
    """Latest-day scored rows (no graph columns)."""
    return L.latest_hour(fx.scored(spark, sf_dir)).select(*SCORE_COLS, "rsrp_dbm_avg", "jitter_ms_avg",
                                                           "pkt_loss_pct_avg")


LATEST_SCORED = "(SELECT * FROM scored WHERE ts_hour = (SELECT max(ts_hour) FROM scored))"


@query("project_present", sql(rounded(PRESENT, KPIS, "silver"), "silver"))
def project_present(spark, sf_dir):
    """S3: keep the wanted columns that exist."""
    return R.project_present(fx.silver(spark, sf_dir), WANTED)


@query("slice_region_date", sql(rounded(SILVER_COLS, KPIS, """(SELECT * FROM silver WHERE region = 'nyc'
  AND date = (SELECT max(date) FROM silver WHERE region = 'nyc')) t"""), "silver"))
def slice_region_date(spark, sf_dir):
    """One region, its latest date."""
    return L.slice_region_date(fx.silver(spark, sf_dir), "nyc", "latest")


@query("latest_hour", sql(rounded(GOLD_COLS, GOLD_DOUBLES,
                                  "(SELECT * FROM gold WHERE ts_hour = (SELECT max(ts_hour) FROM gold)) t"), "gold"))
def latest_hour(spark, sf_dir):
    """Rows of the newest hour."""
    return L.latest_hour(fx.gold(spark, sf_dir))


@query("training_rows", sql(rounded(GOLD_COLS, GOLD_DOUBLES,
                                    "(SELECT * FROM gold WHERE y_next_anomaly IS NOT NULL) t"), "gold"))
def training_rows(spark, sf_dir):
    """Rows with a label."""
    from ..operators.features import training_rows as tr
    return tr(fx.gold(spark, sf_dir))


@query("recent_window", sql(rounded(GOLD_COLS, GOLD_DOUBLES, """(SELECT * FROM gold
  WHERE ts_hour >= (SELECT max(ts_hour) FROM gold) - INTERVAL 12 HOUR) t"""), "gold"))
def recent_window(spark, sf_dir):
    """Rows within 12 h of the newest (inclusive)."""
    return L.recent_window(fx.gold(spark, sf_dir), "ts_hour", 12, inclusive=True)


@query("recent_window_exclusive", sql(rounded(GOLD_COLS, GOLD_DOUBLES, """(SELECT * FROM gold
  WHERE ts_hour > (SELECT max(ts_hour) FROM gold) - INTERVAL 12 HOUR) t"""), "gold"))
def recent_window_exclusive(spark, sf_dir):
    """P15, exclusive variant (ds > max - 12 h)."""
    return L.recent_window(fx.gold(spark, sf_dir), "ts_hour", 12, inclusive=False)


@query("latest_rows", sql(rounded(PRESENT, KPIS,
                                  "(SELECT * FROM silver ORDER BY ts DESC, cell_id DESC LIMIT 100) t"), "silver"))
def latest_rows(spark, sf_dir):
    """Newest 100 samples overall."""
    return R.project_present(L.latest_rows(fx.silver(spark, sf_dir), "ts", 100, ["cell_id"]), PRESENT)


@query("series_tail", sql(rounded(GOLD_COLS, GOLD_DOUBLES, """(SELECT * FROM gold_day
  QUALIFY row_number() OVER (PARTITION BY cell_id ORDER BY ts_hour DESC, region DESC) <= 5) t"""), "gold_day"))
def series_tail(spark, sf_dir):
    """Last 5 periods of every cell."""
    return L.series_tail(fx.gold(spark, sf_dir, "day"), "cell_id", "ts_hour", 5, ["region"])


@query("top_cells_by_anomaly", sql("""
SELECT cell_id, round(avg(anomaly_flag), 6) AS anomaly_flag, round(avg(latency_ms), 6) AS latency_ms,
  round(avg(prb_util_pct), 6) AS prb_util_pct
FROM silver GROUP BY cell_id ORDER BY avg(anomaly_flag) DESC NULLS LAST, cell_id LIMIT 10""", "silver"))
def top_cells_by_anomaly(spark, sf_dir):
    """A5: top 10 cells by mean anomaly flag."""
    return A.top_cells_by_anomaly(fx.silver(spark, sf_dir), 10)


_SLO = """
SELECT CAST(ts_hour AS DATE) AS date,
  round(avg(CAST(coalesce(prb_util_pct_avg < 85, false) AS DOUBLE)), 6) AS capacity_slo,
  round(avg(CAST(coalesce(latency_ms_p95 < 60, false) AS DOUBLE)), 6) AS latency_slo,
  round(avg(CAST(coalesce(drop_rate_pct_avg < 0.5, false) AS DOUBLE)), 6) AS reliability_slo,
  count(*) AS n_cell_hours
FROM gold GROUP BY 1"""


@query("slo_daily", sql(_SLO, "gold"))
def slo_daily(spark, sf_dir):
    """SLO attainment per date."""
    return A.slo_daily(fx.gold(spark, sf_dir))


@query("slo_latest", sql(f"SELECT * FROM ({_SLO}) s WHERE date = (SELECT max(CAST(ts_hour AS DATE)) FROM gold)",
                         "gold"))
def slo_latest(spark, sf_dir):
    """The last day's SLO (the panel figures)."""
    return A.slo_latest(fx.gold(spark, sf_dir))


@query("series_coverage", sql("""
SELECT cell_id, count(ts_hour) AS n, min(ts_hour) AS start, max(ts_hour) AS "end" FROM gold GROUP BY cell_id""",
                              "gold"))
def series_coverage(spark, sf_dir):
    """Per-cell count and span."""
    return A.series_coverage(fx.gold(spark, sf_dir))


@query("cell_counts", sql("""
SELECT count(*) AS n_rows, count(DISTINCT cell_id) AS n_cells, count(DISTINCT region) AS n_regions FROM gold""",
                          "gold"))
def cell_counts(spark, sf_dir):
    """A10: rows and distinct cells."""
    return A.cell_counts(fx.gold(spark, sf_dir))


@query("p95_daily_merged", sql("""
SELECT cell_id, region, date, count(latency_ms) AS n, round(quantile_disc(latency_ms, 0.95), 6) AS latency_p95
FROM silver GROUP BY cell_id, region, date""", "silver"))
def p95_daily_merged(spark, sf_dir):
    """A2 for later groupings: p95 per cell and day from the stored hourly sketches (exact: a day has fewer than 200 samples)."""
    return K.merged_quantile(fx.latency_sketches(spark, sf_dir), ["cell_id", "region", "date"]).withColumnRenamed("value_q", "latency_p95")


@query("cells_in_week", sql("""
SELECT d.date, count(DISTINCT s.cell_id) AS n_distinct
FROM (SELECT DISTINCT date FROM silver) d JOIN silver s ON s.date BETWEEN d.date - INTERVAL 6 DAY AND d.date GROUP BY d.date""", "silver"))
def cells_in_week(spark, sf_dir):
    """A10 for windows: distinct cells of the seven days up to each date, from the stored daily sketches."""
    return K.distinct_in_window(fx.cell_sketches(spark, sf_dir), 7)


@query("distinct_values", sql("""
SELECT DISTINCT 'region' AS "column", CAST(region AS VARCHAR) AS value FROM silver
UNION ALL SELECT DISTINCT 'date', CAST(date AS VARCHAR) FROM silver
UNION ALL SELECT DISTINCT 'cell_id', CAST(cell_id AS VARCHAR) FROM silver""", "silver"))
def distinct_values(spark, sf_dir):
    """Picker lists for region, date and cell."""
    return A.distinct_values(fx.silver(spark, sf_dir), ["region", "date", "cell_id"])


@query("class_weight", sql("""
SELECT round(p, 6) AS pos_rate, round((1 - p) / p, 6) AS pos_weight
FROM (SELECT greatest(avg(CAST(y_next_anomaly AS DOUBLE)), 1e-6) AS p FROM gold WHERE y_next_anomaly IS NOT NULL) t""",
                           "gold"))
def class_weight(spark, sf_dir):
    """Positive rate and class weight on labelled rows."""
    from ..operators.features import training_rows as tr
    return A.class_weight(tr(fx.gold(spark, sf_dir)))


@query("region_summary", sql("""
SELECT region, count(DISTINCT cell_id) AS n_cells, count(*) AS n_rows, CAST(sum(n_samples) AS BIGINT) AS n_samples,
  round(avg(latency_ms_p95), 6) AS latency_ms_p95_avg, round(avg(prb_util_pct_avg), 6) AS prb_util_pct_avg,
  round(avg(anomaly_rate), 6) AS anomaly_rate, CAST(sum(anomaly_any) AS BIGINT) AS anomaly_periods,
  max(ts_hour) AS last_ts
FROM gold GROUP BY region""", "gold"))
def region_summary(spark, sf_dir):
    """Per-region summary mart."""
    return L.region_summary(fx.gold(spark, sf_dir))


@query("latest_by_region", sql(rounded(GOLD_COLS, GOLD_DOUBLES, """(SELECT g.* FROM gold g
  JOIN (SELECT region, max(ts_hour) AS m FROM gold GROUP BY region) r ON r.region = g.region AND g.ts_hour = r.m) t"""),
                               "gold"))
def latest_by_region(spark, sf_dir):
    """Each region's newest hour."""
    return L.latest_by_region(fx.gold(spark, sf_dir))


@query("top10_risk_by_region", sql(rounded(SCORE_COLS + ["rank"], SCORE_DOUBLES, f"""(SELECT *,
  CAST(row_number() OVER (PARTITION BY region ORDER BY risk_score DESC NULLS LAST, cell_id) AS INTEGER) AS rank
  FROM {LATEST_SCORED} s QUALIFY rank <= 10) t"""), "scored"))
def top10_risk_by_region(spark, sf_dir):
    """Top 10 cells by risk per region (latest day)."""
    return L.top_per_region(scores_plain(spark, sf_dir), 10).select(*SCORE_COLS, "rank")


@query("top_risk", sql(rounded(SCORE_COLS, SCORE_DOUBLES, f"""(SELECT * FROM {LATEST_SCORED} s
  ORDER BY risk_score DESC NULLS LAST, cell_id, region LIMIT 12) t"""), "scored"))
def top_risk(spark, sf_dir):
    """O2: top 12 cells by risk (latest day)."""
    return L.top_risk(scores_plain(spark, sf_dir).select(*SCORE_COLS), 12)


@query("last_hour_risk", sql(rounded(SCORE_COLS, SCORE_DOUBLES, f"""(SELECT * FROM {LATEST_SCORED} s
  ORDER BY risk_score DESC NULLS LAST, cell_id, region LIMIT 50) t"""), "scored"))
def last_hour_risk(spark, sf_dir):
    """Newest period, highest risk first, 50 rows (the warehouse view)."""
    return L.last_hour_risk(fx.scored(spark, sf_dir).select(*SCORE_COLS), 50)


@query("risk_band", sql(f"""
SELECT cell_id, region, ts_hour, round(risk_score, 6) AS risk_score,
  CASE WHEN risk_score > 0.10 THEN 'sustained' WHEN risk_score > 0.05 THEN 'look' ELSE 'normal' END AS band
FROM {LATEST_SCORED} s""", "scored"))
def risk_band(spark, sf_dir):
    """Rule-of-thumb band."""
    return scores_plain(spark, sf_dir).select("cell_id", "region", "ts_hour", "risk_score",
                                              S.risk_band("risk_score").alias("band"))


@query("risk_percent", sql(f"""
SELECT cell_id, region, ts_hour, round(risk_score * 100, 1) AS risk_pct FROM {LATEST_SCORED} s""", "scored"))
def risk_percent(spark, sf_dir):
    """Risk as a percentage with one decimal."""
    return scores_plain(spark, sf_dir).select("cell_id", "region", "ts_hour",
                                              S.risk_percent("risk_score").alias("risk_pct"))


@query("fault_domain", sql(f"""
SELECT cell_id, region, ts_hour,
  CASE WHEN prb_util_pct_avg > 85 THEN 'capacity'
       WHEN sinr_db_avg < 0 OR rsrp_dbm_avg < -110 THEN 'radio quality'
       WHEN pkt_loss_pct_avg > 1 OR jitter_ms_avg > 30 THEN 'transport' ELSE 'none' END AS fault_domain
FROM {LATEST_SCORED} s""", "scored"))
def fault_domain(spark, sf_dir):
    """Failing dimension from PRB, SINR/RSRP, loss/jitter."""
    s = scores_plain(spark, sf_dir)
    return s.select("cell_id", "region", "ts_hour",
                    S.fault_domain("prb_util_pct_avg", "sinr_db_avg", "rsrp_dbm_avg", "pkt_loss_pct_avg",
                                   "jitter_ms_avg").alias("fault_domain"))


@query("alert_reason", sql(f"""
SELECT cell_id, region, ts_hour, round(risk_score, 6) AS risk_score,
  CASE WHEN coalesce(latency_ms_p95, 0) > 60 THEN 'high latency' ELSE 'capacity pressure' END AS reason
FROM {LATEST_SCORED} s WHERE risk_score >= 0.5""", "scored"))
def alert_reason(spark, sf_dir):
    """P16 + P17: alerts at threshold 0.5 with the rule reason (no model reasons)."""
    from ..operators import triage as TR
    al = TR.alert_reason(TR.alerts(scores_plain(spark, sf_dir), 0.5), None)
    return al.select("cell_id", "region", "ts_hour", "risk_score", "reason")


@query("clip_bounds", sql("""
SELECT ts, cell_id, round(latency_ms, 6) AS latency_ms,
  round(CASE WHEN latency_ms IS NULL THEN NULL ELSE least(greatest(latency_ms, 5.0), 400.0) END, 6) AS latency_clipped
FROM silver""", "silver"))
def clip_bounds(spark, sf_dir):
    """Clip to [5, 400], NULL kept."""
    s = fx.silver(spark, sf_dir)
    return s.select("ts", "cell_id", "latency_ms", S.clip("latency_ms", 5.0, 400.0).alias("latency_clipped"))


@query("lenient_casts", sql("""
SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k_num,
  TRY_CAST(event_type AS DOUBLE) AS bad_num, TRY_CAST(props AS DOUBLE) AS props_num,
  TRY_CAST(CAST(ts AS VARCHAR) AS TIMESTAMP) AS ts_parsed, TRY_CAST(event_type AS TIMESTAMP) AS bad_ts
FROM events"""))
def lenient_casts(spark, sf_dir):
    """Bad numbers and timestamps become NULL instead of failing."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    return e.select("event_id", S.lenient_double(F.get_json_object("props", "$.k")).alias("k_num"),
                    S.lenient_double("event_type").alias("bad_num"), S.lenient_double("props").alias("props_num"),
                    S.lenient_timestamp(F.col("ts").cast("string")).alias("ts_parsed"),
                    S.lenient_timestamp("event_type").alias("bad_ts"))


@query("drop_empty_columns", sql(rounded(GOLD_COLS, GOLD_DOUBLES, "gold"), "gold"))
def drop_empty_columns(spark, sf_dir):
    """A column that is NULL everywhere is dropped (one count() per column, one pass)."""
    from ..operators.frames import drop_empty_columns as dec
    g = fx.gold(spark, sf_dir).withColumn("notes", F.lit(None).cast("string"))
    return dec(g)


# ---- data quality ----

@query("gap_check", sql("""
SELECT cell_id, min(ts_hour) AS start, max(ts_hour) AS "end", count(DISTINCT ts_hour) AS present,
  date_diff('day', min(ts_hour), max(ts_hour)) + 1 AS expected,
  date_diff('day', min(ts_hour), max(ts_hour)) + 1 - count(DISTINCT ts_hour) AS missing
FROM gold_day GROUP BY cell_id""", "gold_day"))
def gap_check(spark, sf_dir):
    """Q1: expected vs present periods for every cell (day grain)."""
    return Q.gap_check(fx.gold(spark, sf_dir, "day"), "day")


@query("dq_freshness", sql("""
SELECT max(ts_hour) AS max_ts,
  round(count_if(prb_util_pct_avg IS NULL) / count(*), 6) AS null_prb_util_pct_avg,
  round(count_if(latency_ms_p95 IS NULL) / count(*), 6) AS null_latency_ms_p95,
  round(date_diff('microsecond', max(ts_hour), (SELECT max(ts) FROM silver)) / 3.6e9, 6) AS hours_behind,
  coalesce(date_diff('microsecond', max(ts_hour), (SELECT max(ts) FROM silver)) / 3.6e9 <= 2
    AND count_if(prb_util_pct_avg IS NULL) / count(*) < 0.05
    AND count_if(latency_ms_p95 IS NULL) / count(*) < 0.05, false) AS ok
FROM gold""", "gold", "silver"))
def dq_freshness(spark, sf_dir):
    """Newest hour, null shares, hours behind the newest raw sample, OK flag."""
    as_of = fx.silver(spark, sf_dir).select(F.max("ts")).scalar()
    return Q.dq_freshness(fx.gold(spark, sf_dir), as_of)


GOLD_RULES = {  # fixed rule set for the documented null and range checks
    "latency_p95_present": "latency_ms_p95 IS NOT NULL",
    "prb_in_range": "prb_util_pct_avg BETWEEN 0 AND 100",
    "sinr_in_range": "sinr_db_avg BETWEEN -20 AND 40",
    "rsrp_in_range": "rsrp_dbm_avg BETWEEN -140 AND -40",
    "anomaly_rate_unit": "anomaly_rate BETWEEN 0 AND 1",
    "samples_positive": "n_samples >= 1",
}


@query("dq_rules", sql("\nUNION ALL\n".join(
    f"SELECT '{n}' AS rule, CAST(count_if(NOT coalesce(({p}), false)) AS BIGINT) AS failed, count(*) AS total FROM gold"
    for n, p in GOLD_RULES.items()), "gold"))
def dq_rules(spark, sf_dir):
    """Q3: null and range rules in one pass, one row per rule."""
    return Q.dq_rules(fx.gold(spark, sf_dir), GOLD_RULES)
