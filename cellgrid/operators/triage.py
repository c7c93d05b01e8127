"""Alert triage: threshold, reasons, priority = risk x forecast x graph position, export.

The min/max used to scale centrality are taken over the alert rows (after the
threshold), as the reference does; they come from one aggregate used as a
struct-valued scalar subquery, so no global window or cross join is planned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import minmax_scaled, reason_rule

# fixed values: priority weights (risk, forecast, graph) and the graph mix (pagerank, betweenness, degree)
W_RISK, W_FORECAST, W_GRAPH = 0.55, 0.30, 0.15
G_PAGERANK, G_BETWEENNESS, G_DEGREE = 0.5, 0.3, 0.2


def alerts(scores: DataFrame, thr: float | F.Column = 0.5, region: str | None = None) -> DataFrame:
    """Rows whose risk reaches the threshold (optionally one region)."""
    thr_c = thr if isinstance(thr, F.Column) else F.lit(float(thr))
    out = scores.filter(F.col("risk_score") >= thr_c)
    if region is not None:
        out = out.filter(F.col("region") == region)
    return out


def alert_reason(al: DataFrame, reasons: DataFrame | None = None, latency_limit: float = 60.0) -> DataFrame:
    """Model reason where present (non-empty), else the rule: p95 > 60 ms -> high latency, else capacity pressure."""
    if reasons is not None:
        keys = [k for k in ("cell_id", "region", "ts_hour") if k in reasons.columns and k in al.columns]
        al = al.join(reasons.select(*keys, "top_reasons"), keys, "left")
    else:
        al = al.withColumn("top_reasons", F.lit(None).cast("string"))
    return al.withColumn("reason", F.coalesce(F.nullif(F.col("top_reasons"), F.lit("")),
                                              reason_rule("latency_ms_p95", latency_limit)))


def alert_priority(al: DataFrame, p_breach: DataFrame | None) -> DataFrame:
    """priority = 0.55 risk + 0.30 p_breach + 0.15 (0.5 pagerank_z + 0.3 betweenness_z + 0.2 degree_z)."""
    if p_breach is not None:
        al = al.join(p_breach.select("cell_id", "p_breach"), "cell_id", "left")
    else:
        al = al.withColumn("p_breach", F.lit(None).cast("double"))
    al = al.withColumn("p_breach", F.coalesce(F.col("p_breach"), F.lit(0.0)))
    for c in ("neighbor_degree", "pagerank", "betweenness"):
        if c not in al.columns:
            al = al.withColumn(c, F.lit(0.0))
        al = al.withColumn(c, F.coalesce(F.col(c).cast("double"), F.lit(0.0)))
    cols = ("neighbor_degree", "pagerank", "betweenness")
    # one aggregate over the alert rows, used as a single struct-valued scalar subquery
    st = al.select(F.struct(*[F.min(c).alias(f"lo_{c}") for c in cols],
                            *[F.max(c).alias(f"hi_{c}") for c in cols]).alias("s")).scalar()
    al = al.withColumns({f"{c}_z": minmax_scaled(c, st[f"lo_{c}"], st[f"hi_{c}"]) for c in cols})
    graph = (G_PAGERANK * F.col("pagerank_z") + G_BETWEENNESS * F.col("betweenness_z")
             + G_DEGREE * F.col("neighbor_degree_z"))
    return al.withColumn("priority", W_RISK * F.col("risk_score") + W_FORECAST * F.col("p_breach")
                         + W_GRAPH * graph)


EXPORT_COLS = ["priority", "cell_id", "region", "ts_hour", "risk_score", "latency_ms_p95", "prb_util_pct_avg",
               "sinr_db_avg", "thrpt_mbps_avg", "reason"]


def alerts_table(scores: DataFrame, thr, p_breach: DataFrame | None, reasons: DataFrame | None) -> DataFrame:
    """Full alert table: threshold, priority, reasons, display columns."""
    al = alert_priority(alerts(scores, thr), p_breach)
    al = alert_reason(al, reasons)
    return al.select(*EXPORT_COLS)


def export_alerts(table: DataFrame, path: str) -> None:
    """CSV export with header, highest priority first (a sorted write: range exchange + sort)."""
    (table.orderBy(F.col("priority").desc(), F.col("cell_id").asc())
     .write.mode("overwrite").option("header", True).csv(path))
