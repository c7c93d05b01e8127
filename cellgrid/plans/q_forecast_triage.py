"""Registered queries: series preparation, forecasts, breach probability and alert triage."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import forecast as FC
from ..operators import series as SE
from ..operators import triage as TR
from ..sources import readers as R
from . import fixtures as fx
from .oracle_base import cte, rounded, sql
from .q_graph_model import reasons_df
from .registry import query

HORIZON = 12
HIST_DAYS = 14
BOUNDS = (0.0, 100.0)


def _interp_ctes(prefix: str, src: str, grain: str) -> str:
    step = {"hour": "INTERVAL 1 HOUR", "day": "INTERVAL 1 DAY"}[grain]
    cte(f"{prefix}_obs", f"""SELECT cell_id, CAST(date_trunc('{grain}', ts_hour) AS TIMESTAMP) AS ds,
  avg(prb_util_pct_avg) AS y FROM {src} WHERE prb_util_pct_avg IS NOT NULL AND ts_hour IS NOT NULL GROUP BY 1, 2""",
        src)
    cte(f"{prefix}_grid", f"""SELECT cell_id, unnest(generate_series(lo, hi, {step})) AS ds
FROM (SELECT cell_id, min(ds) AS lo, max(ds) AS hi FROM {prefix}_obs GROUP BY cell_id) b""", f"{prefix}_obs")
    cte(prefix, f"""
SELECT cell_id, ds, CASE WHEN y IS NOT NULL THEN y WHEN y0 IS NULL THEN y1 WHEN y1 IS NULL THEN y0
  ELSE y0 + (y1 - y0) * (t - t0) / (t1 - t0) END AS y, y IS NOT NULL AS observed
FROM (SELECT *,
  last_value(y IGNORE NULLS) OVER (PARTITION BY cell_id ORDER BY ds ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS y0,
  last_value(ty IGNORE NULLS) OVER (PARTITION BY cell_id ORDER BY ds ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS t0,
  first_value(y IGNORE NULLS) OVER (PARTITION BY cell_id ORDER BY ds ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS y1,
  first_value(ty IGNORE NULLS) OVER (PARTITION BY cell_id ORDER BY ds ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS t1
  FROM (SELECT g.cell_id, g.ds, o.y, epoch(g.ds) AS t, CASE WHEN o.y IS NOT NULL THEN epoch(g.ds) END AS ty
        FROM {prefix}_grid g LEFT JOIN {prefix}_obs o ON o.cell_id = g.cell_id AND o.ds = g.ds) x) w""",
        f"{prefix}_grid", f"{prefix}_obs")
    return prefix


_interp_ctes("interp12", "gold12", "hour")
_interp_ctes("interp_day", "gold_day", "day")


def hourly_series(spark, sf_dir):
    """Hourly PRB series of the 12 merged cells, on a regular grid."""
    return SE.interpolate(fx.gold(spark, sf_dir, "hour", merge_cells=12), "cell_id", "ts_hour",
                          "prb_util_pct_avg", "hour")


def daily_series(spark, sf_dir, region: str | None = None):
    """Daily PRB series per cell, on a regular grid; ``region`` filters the partitioned layer first."""
    g = fx.gold(spark, sf_dir, "day")
    if region is not None:
        g = g.filter(g.region == region)
    return SE.interpolate(g, "cell_id", "ts_hour", "prb_util_pct_avg", "day")


@query("interpolate_hourly", sql(rounded(["cell_id", "ds", "y", "observed"], ["y"], "interp12"), "interp12"))
def interpolate_hourly(spark, sf_dir):
    """Hourly mean resample, regular grid, linear gap fill, ends held."""
    return hourly_series(spark, sf_dir)


@query("winsorize", sql("""
SELECT cell_id, ds, round(least(greatest(y, p_lo), p_hi), 6) AS y, round(p_lo, 6) AS p_lo, round(p_hi, 6) AS p_hi
FROM (SELECT *, quantile_cont(y, 0.01) OVER (PARTITION BY cell_id) AS p_lo,
             quantile_cont(y, 0.99) OVER (PARTITION BY cell_id) AS p_hi FROM interp12) t""", "interp12"))
def winsorize(spark, sf_dir):
    """Clip each series to its own exact 1st/99th percentiles."""
    return SE.winsorize(hourly_series(spark, sf_dir).drop("observed"), "cell_id", "y", 0.01, 0.99)


@query("short_series", sql("""
SELECT cell_id, count(*) AS n_points FROM interp_day GROUP BY cell_id HAVING count(*) < 24""", "interp_day"))
def short_series(spark, sf_dir):
    """series below the 24-point minimum (the rejected list)."""
    return SE.short_series(daily_series(spark, sf_dir), 24)


def _clip_sql(x: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN NULL ELSE least(greatest({x}, 0.0), 100.0) END"


def _naive_ctes(naive: str, frame: str, src: str) -> None:
    cte(naive, f"""
SELECT cell_id, last_ds + i * INTERVAL 1 DAY AS ds, {_clip_sql('yhat')} AS yhat,
  {_clip_sql('yhat - 1.28 * sd')} AS yhat_lower, {_clip_sql('yhat + 1.28 * sd')} AS yhat_upper,
  'naive_last' AS model
FROM (SELECT cell_id, arg_max(y, ds) AS yhat, max(ds) AS last_ds, coalesce(stddev_samp(y), 0.0) AS sd
      FROM {src} GROUP BY cell_id) l, range(1, {HORIZON + 1}) r(i)""", src)
    cte(frame, f"""
SELECT cell_id, ds, y, CAST(NULL AS DOUBLE) AS yhat, CAST(NULL AS DOUBLE) AS yhat_lower,
  CAST(NULL AS DOUBLE) AS yhat_upper, 'observed' AS model
FROM {src} QUALIFY row_number() OVER (PARTITION BY cell_id ORDER BY ds DESC) <= {HIST_DAYS}
UNION ALL
SELECT cell_id, ds, CAST(NULL AS DOUBLE), yhat, yhat_lower, yhat_upper, model FROM {naive}""", src, naive)


_naive_ctes("naive", "fc_frame", "interp_day")
cte("gold_day_dfw", "SELECT * FROM gold_day WHERE region = 'dfw'", "gold_day")
_interp_ctes("interp_day_dfw", "gold_day_dfw", "day")
_naive_ctes("naive_dfw", "fc_frame_dfw", "interp_day_dfw")
FC_COLS = ["cell_id", "ds", "y", "yhat", "yhat_lower", "yhat_upper", "model"]
FC_DOUBLES = ["y", "yhat", "yhat_lower", "yhat_upper"]


def naive_df(spark, sf_dir):
    return FC.naive_forecast(daily_series(spark, sf_dir), "cell_id", HORIZON, "day", z=FC.Z80, bounds=BOUNDS)


def frame_df(spark, sf_dir):
    return FC.forecast_frame(daily_series(spark, sf_dir), naive_df(spark, sf_dir), "cell_id", HIST_DAYS)


@query("naive_forecast", sql(rounded(FC_COLS[:1] + FC_COLS[1:2] + FC_COLS[3:], FC_DOUBLES, "naive"), "naive"))
def naive_forecast(spark, sf_dir):
    """Last value carried 12 steps, band +-1.28 stddev, bounded to 0..100."""
    return naive_df(spark, sf_dir)


@query("forecast_frame", sql(rounded(FC_COLS, FC_DOUBLES, "fc_frame"), "fc_frame"))
def forecast_frame(spark, sf_dir):
    """O4/F7 (naive path)/P24: observed tail stacked over the forecast, missing columns as NULL."""
    return frame_df(spark, sf_dir)


cte("breach", f"""SELECT cell_id, count_if(yhat_upper >= 85) / {float(HORIZON)} AS p_breach
FROM fc_frame WHERE model <> 'observed' GROUP BY cell_id""", "fc_frame")


@query("forecast_region", sql(rounded(FC_COLS + ["region"], FC_DOUBLES, "(SELECT *, 'dfw' AS region FROM fc_frame_dfw) t"),
                              "fc_frame_dfw"))
def forecast_region(spark, sf_dir):
    """One region's forecast frame; the region is really filtered (partition pruning) and stamped."""
    s = daily_series(spark, sf_dir, "dfw")
    fc = FC.naive_forecast(s, "cell_id", HORIZON, "day", z=FC.Z80, bounds=BOUNDS)
    return FC.forecast_frame(s, fc, "cell_id", HIST_DAYS).withColumn("region", F.lit("dfw"))


@query("breach_probability", sql("SELECT cell_id, round(p_breach, 6) AS p_breach FROM breach", "breach"))
def breach_probability(spark, sf_dir):
    """Share of the 12 forecast steps whose upper band reaches 85%."""
    return FC.breach_probability(frame_df(spark, sf_dir), 85.0, HORIZON)


@query("forecast_sanity", sql("""
SELECT p.cell_id, round(p.min_yhat, 6) AS min_yhat, round(r.recent_median, 6) AS recent_median,
  round(r.recent_std, 6) AS recent_std, round(r.recent_slope, 6) AS recent_slope,
  p.min_yhat < r.recent_median - 2 * r.recent_std AND coalesce(r.recent_slope, 0.0) >= 0 AS implausible
FROM (SELECT cell_id, min(yhat) AS min_yhat FROM fc_frame WHERE model <> 'observed' GROUP BY cell_id) p
JOIN (SELECT cell_id, quantile_cont(y, 0.5) AS recent_median, coalesce(stddev_samp(y), 0.0) AS recent_std,
        regr_slope(y, CAST(date_diff('hour', TIMESTAMP '2000-01-01 00:00:00', ds) AS DOUBLE)) AS recent_slope
      FROM (SELECT * FROM fc_frame WHERE model = 'observed'
            QUALIFY row_number() OVER (PARTITION BY cell_id ORDER BY ds DESC) <= 24) o
      GROUP BY cell_id) r ON r.cell_id = p.cell_id""", "fc_frame"))
def forecast_sanity(spark, sf_dir):
    """flag forecasts far below the recent level without a downtrend."""
    return FC.forecast_sanity(frame_df(spark, sf_dir), 24)


@query("forecast_summary", sql("""
SELECT cell_id, CAST(count_if(model = 'observed') AS BIGINT) AS n_observed,
  count(DISTINCT CASE WHEN model <> 'observed' THEN ds END) AS n_forecast,
  min(CASE WHEN model <> 'observed' THEN ds END) AS first_forecast,
  max(CASE WHEN model <> 'observed' THEN ds END) AS last_forecast,
  max(CASE WHEN model = 'observed' THEN ds END) AS last_observed,
  array_to_string(list_sort(list_distinct(list(model) FILTER (WHERE model <> 'observed'))), ',') AS models
FROM fc_frame GROUP BY cell_id""", "fc_frame"))
def forecast_summary(spark, sf_dir):
    """observed/forecast split and horizon per cell."""
    return FC.forecast_summary(frame_df(spark, sf_dir))


def prb_model_series(spark, sf_dir):
    """Daily PRB series of every cell prepared as for model fitting: bounded to 0..100, regular grid, winsorised."""
    g = SE.bounded(fx.gold(spark, sf_dir, "day"), ["prb_util_pct_avg"], *BOUNDS)
    s = SE.interpolate(g, "cell_id", "ts_hour", "prb_util_pct_avg", "day")
    return SE.winsorize(s.drop("observed"), "cell_id", "y", 0.01, 0.99).drop("p_lo", "p_hi")


SEASON = 7  # days; every cell has about 27, and both seasonal methods need two seasons


# Holt-Winters in SQL: every grid point of every cell steps through time in a recursive query
cte("gold_day_bounded", f"SELECT * REPLACE ({_clip_sql('prb_util_pct_avg')} AS prb_util_pct_avg) FROM gold_day", "gold_day")
_interp_ctes("interp_day_bounded", "gold_day_bounded", "day")
cte("prb_series", """
SELECT cell_id, ds, least(greatest(y, quantile_cont(y, 0.01) OVER (PARTITION BY cell_id)),
                          quantile_cont(y, 0.99) OVER (PARTITION BY cell_id)) AS y
FROM interp_day_bounded""", "interp_day_bounded")
cte("prb_lists", "SELECT cell_id, list(y ORDER BY ds) AS ys, count(*) AS n, max(ds) AS last_ds FROM prb_series GROUP BY cell_id", "prb_series")
_GRID = [(a_, b_, g_) for a_ in (0.1, 0.3, 0.5, 0.8) for b_ in (0.01, 0.1, 0.3) for g_ in (0.05, 0.2, 0.5)]
cte("hw_grid", "SELECT * FROM (VALUES " + ", ".join(f"({i}, {a_}::DOUBLE, {b_}::DOUBLE, {g_}::DOUBLE)" for i, (a_, b_, g_) in enumerate(_GRID))
    + ") v(k, a, b, g)")
cte("hw_start", f"""
SELECT cell_id, k, a, b, g, ys, n, last_ds, list_sum(ys[1:{SEASON}]) / {SEASON} AS lev,
  (list_sum(ys[{SEASON + 1}:{2 * SEASON}]) / {SEASON} - list_sum(ys[1:{SEASON}]) / {SEASON}) / {SEASON} AS tr
FROM prb_lists, hw_grid WHERE n >= {2 * SEASON}""", "prb_lists", "hw_grid")
cte("hw_state", f"""
SELECT cell_id, k, 0, lev, tr, list_transform(ys[1:{SEASON}], lambda y: y - lev), 0.0::DOUBLE FROM hw_start
UNION ALL
SELECT cell_id, k, t + 1, new_lev, b * (new_lev - lev) + (1 - b) * tr,
  list_concat(sea[2:], [g * (y - new_lev) + (1 - g) * sea[1]]), sse + (lev + tr + sea[1] - y) * (lev + tr + sea[1] - y)
FROM (SELECT s.*, p.a, p.b, p.g, p.ys[s.t + 1] AS y, p.a * (p.ys[s.t + 1] - s.sea[1]) + (1 - p.a) * (s.lev + s.tr) AS new_lev
      FROM hw_state s JOIN hw_start p ON p.cell_id = s.cell_id AND p.k = s.k WHERE s.t < p.n) step""",
    "hw_start", cols="cell_id, k, t, lev, tr, sea, sse", recursive=True)
cte("hw_best", """
SELECT s.*, p.n, p.last_ds FROM hw_state s JOIN hw_start p ON p.cell_id = s.cell_id AND p.k = s.k AND s.t = p.n
QUALIFY row_number() OVER (PARTITION BY s.cell_id ORDER BY s.sse, s.k) = 1""", "hw_state")
cte("hw_pred", f"""
SELECT cell_id, last_ds + h * INTERVAL 1 DAY AS ds, lev + h * tr + sea[(h - 1) % {SEASON} + 1] AS yhat, 1.28 * sqrt(sse / n) AS half,
  'holt_winters' AS model FROM hw_best, range(1, {HORIZON + 1}) r(h)
UNION ALL
SELECT cell_id, last_ds + h * INTERVAL 1 DAY, ys[n], 0.0, 'naive_last'
FROM prb_lists, range(1, {HORIZON + 1}) r(h) WHERE n >= {SEASON} AND n < {2 * SEASON}""", "hw_best", "prb_lists")
cte("hw_frame", f"""
SELECT cell_id, ds, y, CAST(NULL AS DOUBLE) AS yhat, CAST(NULL AS DOUBLE) AS yhat_lower, CAST(NULL AS DOUBLE) AS yhat_upper, 'observed' AS model
FROM prb_series SEMI JOIN (SELECT cell_id FROM prb_lists WHERE n >= {SEASON}) USING (cell_id)
QUALIFY row_number() OVER (PARTITION BY cell_id ORDER BY ds DESC) <= {HIST_DAYS}
UNION ALL
SELECT cell_id, ds, NULL, {_clip_sql('yhat')}, {_clip_sql('yhat - half')}, {_clip_sql('yhat + half')}, model FROM hw_pred""",
    "hw_pred", "prb_series", "prb_lists")


@query("forecast_hw", sql(rounded(FC_COLS, FC_DOUBLES, "hw_frame"), "hw_frame"))
def forecast_hw(spark, sf_dir):
    """additive Holt-Winters (season 7 days) for every cell, fallback to naive; bounded 0..100."""
    return FC.forecast(prb_model_series(spark, sf_dir), "cell_id", HORIZON, "day", ("hw", "naive"), SEASON, HIST_DAYS,
                       BOUNDS, min_points=SEASON)


@query("forecast_fourier")
def forecast_fourier(spark, sf_dir):
    """trend + weekly Fourier terms on a logit scale for every cell, fallback chain hw -> naive."""
    return FC.forecast(prb_model_series(spark, sf_dir), "cell_id", HORIZON, "day", ("fourier", "hw", "naive"), SEASON,
                       HIST_DAYS, BOUNDS, min_points=SEASON)


@query("forecast_trend")
def forecast_trend(spark, sf_dir):
    """logistic growth with changepoints and a multiplicative weekly season for every cell, band from simulated
    trends, fallback chain hw -> naive."""
    return FC.forecast(prb_model_series(spark, sf_dir), "cell_id", HORIZON, "day", ("trend_multiplicative", "hw", "naive"), SEASON,
                       HIST_DAYS, BOUNDS, min_points=SEASON)


# the least-squares line of every cell, in closed form
cte("line_fit", """
SELECT cell_id, max(ds) AS last_ds, count(*) AS n, avg(y) AS my, regr_slope(y, t::DOUBLE) AS b, avg(t::DOUBLE) AS mt,
  sqrt(greatest(var_pop(y) - coalesce(regr_slope(y, t::DOUBLE), 0) * coalesce(covar_pop(y, t::DOUBLE), 0), 0)) AS rmse
FROM (SELECT *, row_number() OVER (PARTITION BY cell_id ORDER BY ds) - 1 AS t FROM prb_series) GROUP BY cell_id""", "prb_series")
cte("line_frame", f"""
SELECT cell_id, ds, y, CAST(NULL AS DOUBLE) AS yhat, CAST(NULL AS DOUBLE) AS yhat_lower, CAST(NULL AS DOUBLE) AS yhat_upper, 'observed' AS model
FROM prb_series SEMI JOIN (SELECT cell_id FROM line_fit WHERE n >= {SEASON}) USING (cell_id)
QUALIFY row_number() OVER (PARTITION BY cell_id ORDER BY ds DESC) <= {HIST_DAYS}
UNION ALL
SELECT cell_id, last_ds + h * INTERVAL 1 DAY, NULL, {_clip_sql('my + b * (n - 1 + h - mt)')}, {_clip_sql('my + b * (n - 1 + h - mt) - 1.28 * rmse')},
  {_clip_sql('my + b * (n - 1 + h - mt) + 1.28 * rmse')}, 'linear' FROM line_fit, range(1, {HORIZON + 1}) r(h) WHERE n >= {SEASON}""",
    "line_fit", "prb_series")


@query("forecast_linear", sql(rounded(FC_COLS, FC_DOUBLES, "line_frame"), "line_frame"))
def forecast_linear(spark, sf_dir):
    """F5 without season and changepoints: the least-squares line of every cell, bounded 0..100."""
    return FC.forecast(prb_model_series(spark, sf_dir), "cell_id", HORIZON, "day", ("linear",), SEASON, HIST_DAYS, BOUNDS, min_points=SEASON)


# hourly series of every real cell, at the grain of the alerts of the last hour
_interp_ctes("interp_hour", "gold", "hour")
cte("naive_hour", f"""
SELECT cell_id, last_ds + i * INTERVAL 1 HOUR AS ds, {_clip_sql('yhat')} AS yhat, {_clip_sql('yhat - 1.28 * sd')} AS yhat_lower,
  {_clip_sql('yhat + 1.28 * sd')} AS yhat_upper, 'naive_last' AS model
FROM (SELECT cell_id, arg_max(y, ds) AS yhat, max(ds) AS last_ds, coalesce(stddev_samp(y), 0.0) AS sd
      FROM interp_hour GROUP BY cell_id) l, range(1, {HORIZON + 1}) r(i)""", "interp_hour")


def cell_hours(spark, sf_dir):
    """Hourly PRB series of every cell, on a regular grid."""
    return SE.interpolate(fx.gold(spark, sf_dir, "hour"), "cell_id", "ts_hour", "prb_util_pct_avg", "hour")


@query("naive_forecast_hourly", sql(rounded(FC_COLS[:2] + FC_COLS[3:], FC_DOUBLES, "naive_hour"), "naive_hour"))
def naive_forecast_hourly(spark, sf_dir):
    """F6/F8 for every cell: the next 12 hours."""
    return FC.naive_forecast(cell_hours(spark, sf_dir), "cell_id", HORIZON, "hour", z=FC.Z80, bounds=BOUNDS)


@query("breach_probability_hourly", sql(f"""SELECT cell_id, round(count_if(yhat_upper >= 85) / {float(HORIZON)}, 6) AS p_breach
FROM naive_hour GROUP BY cell_id""", "naive_hour"))
def breach_probability_hourly(spark, sf_dir):
    """A7 for every cell: share of the next 12 hours whose upper band reaches 85%."""
    return FC.breach_probability(FC.naive_forecast(cell_hours(spark, sf_dir), "cell_id", HORIZON, "hour", z=FC.Z80, bounds=BOUNDS), 85.0, HORIZON)


@query("forecast_hourly")
def forecast_hourly(spark, sf_dir):
    """F5/F7 for every cell: the next 12 hours by trend with changepoints and a daily season, fallback chain hw -> naive;
    the last 24 hours observed."""
    return FC.forecast(cell_hours(spark, sf_dir).select("cell_id", "ds", "y"), "cell_id", HORIZON, "hour", ("trend", "hw", "naive"), 24, 24, BOUNDS,
                       min_points=24)


@query("forecast_latency")
def forecast_latency(spark, sf_dir):
    """F4/F5 for latency p95 of every cell: trend + weekly Fourier terms, Holt-Winters fallback, series that neither
    fits are listed as rejected; 14 days ahead and shown."""
    s = SE.interpolate(fx.gold(spark, sf_dir, "day"), "cell_id", "ts_hour", "latency_ms_p95", "day")
    return FC.forecast(s, "cell_id", HIST_DAYS, "day", ("fourier", "hw"), SEASON, HIST_DAYS, None, min_points=SEASON)


FULL_MONTH = 30

cte("day_points", "SELECT cell_id, count(*) AS n FROM interp_day GROUP BY cell_id", "interp_day")


@query("forecast_rejected", sql(f"SELECT cell_id, n AS n_points FROM day_points WHERE n < {FULL_MONTH}", "day_points"))
def forecast_rejected(spark, sf_dir):
    """cells below a gate of 30 daily points, which part of the cells miss, with their lengths."""
    return SE.short_series(daily_series(spark, sf_dir), FULL_MONTH)


# ---- alert triage on the latest scores (risk >= 0.5) ----

THR = 0.5
cte("al", f"SELECT * FROM scores_latest WHERE risk_score >= {THR}", "scores_latest")
cte("al_prio", """
SELECT *, 0.55 * risk_score + 0.30 * p_breach
  + 0.15 * (0.5 * pagerank_z + 0.3 * betweenness_z + 0.2 * neighbor_degree_z) AS priority
FROM (SELECT *,
  CASE WHEN max(nd) OVER () = min(nd) OVER () THEN 0.0
       ELSE (nd - min(nd) OVER ()) / (max(nd) OVER () - min(nd) OVER ()) END AS neighbor_degree_z,
  CASE WHEN max(pagerank) OVER () = min(pagerank) OVER () THEN 0.0
       ELSE (pagerank - min(pagerank) OVER ()) / (max(pagerank) OVER () - min(pagerank) OVER ()) END AS pagerank_z,
  CASE WHEN max(betweenness) OVER () = min(betweenness) OVER () THEN 0.0
       ELSE (betweenness - min(betweenness) OVER ()) / (max(betweenness) OVER () - min(betweenness) OVER ())
  END AS betweenness_z
  FROM (SELECT a.*, CAST(a.neighbor_degree AS DOUBLE) AS nd, coalesce(b.p_breach, 0.0) AS p_breach
        FROM al a LEFT JOIN breach b ON b.cell_id = a.cell_id) x) y""", "al", "breach")


def scores_latest(spark, sf_dir):
    return fx.scores_latest(spark, sf_dir)


def p_breach_df(spark, sf_dir):
    return FC.breach_probability(frame_df(spark, sf_dir), 85.0, HORIZON)


@query("alerts", sql(rounded(["cell_id", "region", "ts_hour", "risk_score", "latency_ms_p95", "prb_util_pct_avg",
                              "sinr_db_avg", "thrpt_mbps_avg", "neighbor_degree", "pagerank", "betweenness"],
                             ["risk_score", "latency_ms_p95", "prb_util_pct_avg", "sinr_db_avg", "thrpt_mbps_avg",
                              "pagerank", "betweenness"], "al"), "al"))
def alerts(spark, sf_dir):
    """Latest scores at or above the threshold, with graph columns."""
    return TR.alerts(scores_latest(spark, sf_dir), THR).select(
        "cell_id", "region", "ts_hour", "risk_score", "latency_ms_p95", "prb_util_pct_avg", "sinr_db_avg",
        "thrpt_mbps_avg", "neighbor_degree", "pagerank", "betweenness")


PRIO_COLS = ["cell_id", "region", "ts_hour", "risk_score", "p_breach", "neighbor_degree_z", "pagerank_z",
             "betweenness_z", "priority"]


@query("alert_priority", sql(rounded(PRIO_COLS, PRIO_COLS[3:], "al_prio"), "al_prio"))
def alert_priority(spark, sf_dir):
    """Priority from risk, breach probability and graph position scaled over the alert set."""
    al = TR.alert_priority(TR.alerts(scores_latest(spark, sf_dir), THR), p_breach_df(spark, sf_dir))
    return al.select(*PRIO_COLS)


_REASON_SQL = """
SELECT a.*, r.top_reasons, coalesce(nullif(r.top_reasons, ''),
  CASE WHEN coalesce(a.latency_ms_p95, 0) > 60 THEN 'high latency' ELSE 'capacity pressure' END) AS reason
FROM {src} a LEFT JOIN reasons r ON r.cell_id = a.cell_id AND r.region = a.region AND r.ts_hour = a.ts_hour"""


@query("alerts_with_reasons", sql(rounded(["cell_id", "region", "ts_hour", "risk_score", "top_reasons", "reason"],
                                          ["risk_score"], f"({_REASON_SQL.format(src='al')}) t"), "al", "reasons"))
def alerts_with_reasons(spark, sf_dir):
    """Model reasons joined on (cell, region, hour); rule reason where none."""
    al = TR.alert_reason(TR.alerts(scores_latest(spark, sf_dir), THR), reasons_df(spark, sf_dir))
    return al.select("cell_id", "region", "ts_hour", "risk_score", "top_reasons", "reason")


EXPORT_DOUBLES = ["priority", "risk_score", "latency_ms_p95", "prb_util_pct_avg", "sinr_db_avg", "thrpt_mbps_avg"]


@query("alerts_export", sql(rounded(TR.EXPORT_COLS, EXPORT_DOUBLES, f"({_REASON_SQL.format(src='al_prio')}) t"),
                            "al_prio", "reasons"))
def alerts_export(spark, sf_dir):
    """Full alert table (priority, reasons, display columns) exported as CSV by priority, read back."""
    from .q_io import _path
    table = TR.alerts_table(scores_latest(spark, sf_dir), THR, p_breach_df(spark, sf_dir), reasons_df(spark, sf_dir))
    path = _path(spark, sf_dir, "actionable-alerts")
    TR.export_alerts(table, path)
    schema = ("priority double, cell_id string, region string, ts_hour timestamp_ntz, risk_score double, "
              "latency_ms_p95 double, prb_util_pct_avg double, sinr_db_avg double, thrpt_mbps_avg double, "
              "reason string")
    return R.read_csv(spark, path, schema)



@query("alerts_model")
def alerts_model(spark, sf_dir):
    """P16/T1/T2 end to end with the fitted boosted trees: latest scores, threshold = the model's best-F1
    operating point on the test rows, priority with breach probability and graph position, Shapley reasons."""
    from ..operators import attribution as AT
    from ..operators import evaluation as EV
    from ..operators import model as M
    from ..operators import shap as S
    from ..operators import slices as L
    from ..schemas import ALL_FEATURES
    from .q_graph_model import _gbt, features_df
    model, path, test = _gbt(spark, sf_dir)
    thr = EV.operating_point(M.score(model, test)).select("threshold").first()[0]  # one number
    latest = L.latest_hour(features_df(spark, sf_dir))
    gold_cols = fx.gold(spark, sf_dir, "day").select("cell_id", "region", "ts_hour", "latency_ms_p95",
                                                      "prb_util_pct_avg", "sinr_db_avg", "thrpt_mbps_avg")
    scores = (M.score(model, latest).select("cell_id", "region", "ts_hour", "risk_score", "neighbor_degree",
                                            "pagerank", "betweenness")
              .join(gold_cols, ["cell_id", "region", "ts_hour"], "left"))
    reasons = AT.top_attributed(S.shap_values(path, latest, ALL_FEATURES), ALL_FEATURES, 3)
    return TR.alerts_table(scores, thr, p_breach_df(spark, sf_dir), reasons)
