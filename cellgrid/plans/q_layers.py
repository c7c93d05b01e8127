"""Registered queries: scans and the bronze/silver/gold layers."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import layers
from ..operators.refresh import refresh_gold
from ..session import scratch_path
from ..sources.readers import read_layer
from ..sources.sinks import write_layer
from . import fixtures as fx
from .oracle_base import GOLD_COLS, GOLD_DOUBLES, KPIS, rounded, sql
from .registry import query

BRONZE_COLS = ["ts", "cell_id", "region"] + KPIS
SILVER_COLS = BRONZE_COLS + ["date", "hour", "latency_poor", "prb_high", "anomaly_flag"]


@query("scan_bronze", sql(rounded(BRONZE_COLS, KPIS, "bronze"), "bronze"))
def scan_bronze(spark, sf_dir):
    """Read the source table with an explicit schema and map it to bronze."""
    return fx.bronze(spark, sf_dir)


@query("silver", sql(rounded(SILVER_COLS, KPIS, "silver"), "silver"))
def silver(spark, sf_dir):
    """date/hour, region default, quality screen, flags."""
    return fx.silver(spark, sf_dir, fresh=True)


@query("gold", sql(rounded(GOLD_COLS, GOLD_DOUBLES, "gold"), "gold"))
def gold(spark, sf_dir):
    """Hourly rollup per (cell, region, hour) with the next-hour label."""
    return fx.gold(spark, sf_dir, "hour", fresh=True)


@query("gold_refreshed", sql(rounded(GOLD_COLS, GOLD_DOUBLES, "gold"), "gold"))
def gold_refreshed(spark, sf_dir):
    """Gold after two loads of silver files, the second with late rows of every tenth day of a month, each followed by a refresh."""
    silver_path, gold_path, state = (scratch_path(spark, f"refresh-{uuid.uuid4().hex[:12]}", n) for n in ("silver", "gold", "state"))
    silver = fx.silver(spark, sf_dir)
    late = (F.dayofmonth("date") % 10 == 0) & (F.pmod(F.xxhash64("cell_id", "ts"), F.lit(4)) == 0)
    write_layer(silver.filter(~late), silver_path)
    refresh_gold(spark, silver_path, gold_path, state)
    silver.filter(late).hint("rebalance", "date", "region").write.mode("append").partitionBy("date", "region").parquet(silver_path)
    refresh_gold(spark, silver_path, gold_path, state)
    return read_layer(spark, gold_path, spark.read.parquet(gold_path).schema).select(*GOLD_COLS)


@query("gold_daily", sql(rounded(GOLD_COLS, GOLD_DOUBLES, "gold_day"), "gold_day"))
def gold_daily(spark, sf_dir):
    """Same rollup at day grain (the series grain used by labels, lags and forecasts)."""
    return fx.gold(spark, sf_dir, "day", fresh=True)


_STRICT = """
SELECT cell_id, region, ts_hour, anomaly_any,
  CASE WHEN lead(ts_hour) OVER w = ts_hour + INTERVAL 1 DAY
       THEN CAST(lead(anomaly_any) OVER w AS INTEGER) END AS y_next_anomaly,
  CAST(lead(anomaly_any) OVER w AS INTEGER) AS y_next_row
FROM gold_day_agg
WINDOW w AS (PARTITION BY cell_id ORDER BY ts_hour, region)"""


@query("next_anomaly_label", sql(_STRICT, "gold_day_agg"))
def next_anomaly_label(spark, sf_dir):
    """W1 with both label modes: strict (next row exactly one period later) and row mode."""
    g = layers.gold(fx.silver(spark, sf_dir, fresh=True), grain="day", label=False)
    g = layers.next_anomaly_label(g, strict=True, grain="day")
    g = layers.next_anomaly_label(g, strict=False, out="y_next_row")   # same window spec: one exchange
    return g.select("cell_id", "region", "ts_hour", "anomaly_any", "y_next_anomaly", "y_next_row")
