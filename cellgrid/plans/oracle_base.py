"""DuckDB oracle building blocks: named CTEs with dependencies.

``sql(body, *needs)`` returns ``WITH <needed ctes in dependency order> <body>``.
The oracle re-derives every layer from the raw driver tables, independently of
the Spark code.
"""

from __future__ import annotations

CTES: dict[str, tuple[tuple[str, ...], str]] = {}
HEADS: dict[str, str] = {}
RECURSIVE: set[str] = set()


def cte(name: str, body: str, *deps: str, cols: str | None = None, recursive: bool = False) -> None:
    CTES[name] = (deps, body)
    HEADS[name] = f"{name}({cols})" if cols else name
    if recursive:
        RECURSIVE.add(name)


def _order(names) -> list[str]:
    out: list[str] = []

    def visit(n):
        if n in out:
            return
        for d in CTES[n][0]:
            visit(d)
        out.append(n)

    for n in names:
        visit(n)
    return out


def sql(body: str, *needs: str) -> str:
    names = _order(needs)
    recursive = any(n in RECURSIVE for n in names)
    parts = [f"{HEADS[n]} AS ({CTES[n][1]})" for n in names]
    head = ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(parts) if parts else ""
    return f"{head}\n{body}"


def rounded(cols: list[str], doubles: list[str], src: str, digits: int = 6) -> str:
    sel = [f"round({c}, {digits}) AS {c}" if c in doubles else c for c in cols]
    return f"SELECT {', '.join(sel)} FROM {src}"


KPIS = ["rsrp_dbm", "rsrq_db", "sinr_db", "prb_util_pct", "thrpt_mbps", "drop_rate_pct",
        "latency_ms", "jitter_ms", "pkt_loss_pct"]

GOLD_DOUBLES = ["latency_ms_avg", "latency_ms_p95", "prb_util_pct_avg", "thrpt_mbps_avg", "jitter_ms_avg",
                "pkt_loss_pct_avg", "drop_rate_pct_avg", "sinr_db_avg", "rsrp_dbm_avg", "anomaly_rate"]
GOLD_COLS = ["cell_id", "region", "ts_hour", "n_samples"] + GOLD_DOUBLES + ["anomaly_any", "date", "hour",
                                                                            "y_next_anomaly"]


def _bronze(cell_expr: str) -> str:
    return f"""
SELECT CAST(ts AS TIMESTAMP) AS ts,
  'CELL-' || lpad(CAST({cell_expr} AS VARCHAR), 5, '0') AS cell_id,
  CASE WHEN event_id % 101 = 0 THEN NULL WHEN user_id % 3 = 0 THEN 'dfw'
       WHEN user_id % 3 = 1 THEN 'nyc' ELSE 'sea' END AS region,
  CASE WHEN event_id % 97 = 0 THEN NULL ELSE CAST(-120 + event_id % 50 AS DOUBLE) END AS rsrp_dbm,
  CAST(-10 - event_id % 5 AS DOUBLE) AS rsrq_db,
  CAST(-5 + event_id % 36 AS DOUBLE) AS sinr_db,
  TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS prb_util_pct,
  CAST(200 - event_id % 150 AS DOUBLE) AS thrpt_mbps,
  CAST(event_id % 11 AS DOUBLE) / 10 AS drop_rate_pct,
  CASE WHEN event_id % 89 = 0 THEN NULL ELSE value END AS latency_ms,
  CAST(event_id % 9 AS DOUBLE) AS jitter_ms,
  CAST(event_id % 7 AS DOUBLE) / 10 AS pkt_loss_pct
FROM events"""


def _silver(src: str) -> str:
    kp = ",\n  ".join(f"CASE WHEN isnan({c}) THEN NULL ELSE {c} END AS {c}" for c in KPIS)
    return f"""
SELECT *, CAST(ts AS DATE) AS date, CAST(hour(ts) AS INTEGER) AS hour,
  latency_ms > 60 AS latency_poor, prb_util_pct > 85 AS prb_high,
  CAST((latency_ms > 60) OR (prb_util_pct > 85) AS INTEGER) AS anomaly_flag
FROM (SELECT ts, cell_id, coalesce(region, 'unknown') AS region,
  {kp}
  FROM {src}) b
WHERE rsrp_dbm IS NOT NULL AND sinr_db IS NOT NULL"""


def _gold_agg(src: str, grain: str) -> str:
    avgs = ",\n  ".join(f"avg({s}) AS {n}" for n, s in [
        ("prb_util_pct_avg", "prb_util_pct"), ("thrpt_mbps_avg", "thrpt_mbps"), ("jitter_ms_avg", "jitter_ms"),
        ("pkt_loss_pct_avg", "pkt_loss_pct"), ("drop_rate_pct_avg", "drop_rate_pct"),
        ("sinr_db_avg", "sinr_db"), ("rsrp_dbm_avg", "rsrp_dbm")])
    return f"""
SELECT cell_id, region, CAST(date_trunc('{grain}', ts) AS TIMESTAMP) AS ts_hour,
  CAST(count(*) AS BIGINT) AS n_samples,
  avg(latency_ms) AS latency_ms_avg,
  quantile_disc(latency_ms, 0.95) AS latency_ms_p95,
  {avgs},
  avg(CAST(anomaly_flag AS DOUBLE)) AS anomaly_rate,
  max(anomaly_flag) AS anomaly_any
FROM {src} GROUP BY 1, 2, 3"""


def _gold(src: str) -> str:
    return f"""
SELECT *, CAST(ts_hour AS DATE) AS date, CAST(hour(ts_hour) AS INTEGER) AS hour,
  CAST(lead(anomaly_any) OVER (PARTITION BY cell_id ORDER BY ts_hour, region) AS INTEGER) AS y_next_anomaly
FROM {src}"""


cte("bronze", _bronze("user_id"))
cte("silver", _silver("bronze"), "bronze")
cte("gold_agg", _gold_agg("silver", "hour"), "silver")
cte("gold", _gold("gold_agg"), "gold_agg")
cte("gold_day_agg", _gold_agg("silver", "day"), "silver")
cte("gold_day", _gold("gold_day_agg"), "gold_day_agg")

# 12 merged cells, dense hourly series (seasonal forecasts)
cte("bronze12", _bronze("user_id % 12"))
cte("silver12", _silver("bronze12"), "bronze12")
cte("gold12_agg", _gold_agg("silver12", "hour"), "silver12")
cte("gold12", _gold("gold12_agg"), "gold12_agg")

# deterministic risk score on day-grain gold
RISK = "round(0.6 * least(latency_ms_p95 / 150.0, 1.0) + 0.004 * prb_util_pct_avg, 6)"
cte("scored", f"SELECT *, {RISK} AS risk_score FROM gold_day", "gold_day")


# ---- neighbour graph (k=2 lattice over (region, cell) pairs) ----
cte("cells", "SELECT DISTINCT region, cell_id FROM silver WHERE cell_id IS NOT NULL", "silver")
cte("lattice", """
SELECT DISTINCT a.cell_id AS src_cell_id, b.cell_id AS dst_cell_id
FROM (SELECT region, cell_id, row_number() OVER (PARTITION BY region ORDER BY cell_id) AS i FROM cells) a
JOIN (SELECT region, cell_id, row_number() OVER (PARTITION BY region ORDER BY cell_id) AS i FROM cells) b
  ON a.region = b.region AND b.i - a.i BETWEEN 1 AND 2""", "cells")
cte("canon", """SELECT DISTINCT least(src_cell_id, dst_cell_id) AS u, greatest(src_cell_id, dst_cell_id) AS v
FROM lattice WHERE src_cell_id <> dst_cell_id""", "lattice")
cte("adj", "SELECT u, v FROM canon UNION ALL SELECT v, u FROM canon", "canon")
cte("deg", "SELECT u AS v, count(*) AS deg FROM adj GROUP BY u", "adj")
cte("nv", "SELECT count(*) AS n FROM deg", "deg")
cte("adj_self", """SELECT a.u, a.v, 1.0 / d.deg AS w, false AS self FROM adj a JOIN deg d ON d.v = a.u
UNION ALL SELECT v, v, 0.0, true FROM deg""", "adj", "deg")
cte("pr", """
SELECT 0, v, 1.0 / (SELECT n FROM nv), 1e300 FROM deg
UNION ALL
SELECT it, v, rank, sum(abs(rank - prev)) OVER () FROM (
  SELECT p.it + 1 AS it, s.v,
    (1 - 0.85) / (SELECT n FROM nv) + 0.85 * sum(CASE WHEN NOT s.self THEN p.rank * s.w END) AS rank,
    max(CASE WHEN s.self THEN p.rank END) AS prev
  FROM pr p JOIN adj_self s ON s.u = p.v
  WHERE p.err >= (SELECT n FROM nv) * 1e-6 AND p.it < 100
  GROUP BY p.it, s.v) x""", "deg", "nv", "adj_self", cols="it, v, rank, err", recursive=True)
cte("pagerank", "SELECT v AS cell_id, rank AS pagerank FROM pr WHERE it = (SELECT max(it) FROM pr)", "pr")
cte("walks", """
SELECT v, v, 0 FROM deg
UNION ALL
SELECT DISTINCT w.s, a.v, w.d + 1 FROM walks w JOIN adj a ON a.u = w.v WHERE w.d < (SELECT n FROM nv)""",
    "deg", "adj", "nv", cols="s, v, d", recursive=True)
cte("dist", "SELECT s, v, min(d) AS d FROM walks GROUP BY s, v", "walks")
cte("sig", """
SELECT v, v, 0, CAST(1.0 AS DOUBLE) FROM deg
UNION ALL
SELECT g.s, a.v, g.d + 1, sum(g.sigma) FROM sig g JOIN adj a ON a.u = g.v
  JOIN dist t ON t.s = g.s AND t.v = a.v AND t.d = g.d + 1
GROUP BY g.s, a.v, g.d""", "deg", "adj", "dist", cols="s, v, d, sigma", recursive=True)
cte("betweenness", """
SELECT d.v AS cell_id,
  coalesce(b.b, 0) / CASE WHEN (SELECT n FROM nv) > 2
                          THEN ((SELECT n FROM nv) - 1) * ((SELECT n FROM nv) - 2) ELSE 1 END AS betweenness
FROM deg d LEFT JOIN (
  SELECT p1.v, sum(p1.sigma * p2.sigma / p3.sigma) AS b
  FROM sig p1 JOIN sig p2 ON p2.s = p1.v JOIN sig p3 ON p3.s = p1.s AND p3.v = p2.v
  WHERE p1.d + p2.d = p3.d AND p1.s <> p1.v AND p2.v <> p1.v AND p1.s <> p2.v
  GROUP BY p1.v) b ON b.v = d.v""", "deg", "sig", "nv")
cte("centrality", """
SELECT d.v AS cell_id, d.deg AS neighbor_degree, p.pagerank, b.betweenness
FROM deg d JOIN pagerank p ON p.cell_id = d.v JOIN betweenness b ON b.cell_id = d.v""",
    "deg", "pagerank", "betweenness")

# latest-day scores with graph features (one copy, nulls -> 0)
cte("scores_latest", """
SELECT s.cell_id, s.region, s.ts_hour, s.risk_score, s.latency_ms_p95, s.prb_util_pct_avg, s.sinr_db_avg,
  s.thrpt_mbps_avg, s.rsrp_dbm_avg, s.jitter_ms_avg, s.pkt_loss_pct_avg,
  coalesce(c.neighbor_degree, 0) AS neighbor_degree, coalesce(c.pagerank, 0.0) AS pagerank,
  coalesce(c.betweenness, 0.0) AS betweenness
FROM scored s LEFT JOIN centrality c ON c.cell_id = s.cell_id
WHERE s.ts_hour = (SELECT max(ts_hour) FROM scored)""", "scored", "centrality")
