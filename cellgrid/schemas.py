"""Explicit schemas per layer and the warehouse contracts (used for read, select order and drift checks)."""

from __future__ import annotations

from pyspark.sql import types as T

# fixed values: column names and order of the layers and of the warehouse contracts
KPI_COLUMNS = ["rsrp_dbm", "rsrq_db", "sinr_db", "prb_util_pct", "thrpt_mbps", "drop_rate_pct",
               "latency_ms", "jitter_ms", "pkt_loss_pct"]

BRONZE = T.StructType(
    [T.StructField("ts", T.TimestampNTZType()),
     T.StructField("cell_id", T.StringType()),
     T.StructField("region", T.StringType())]
    + [T.StructField(c, T.DoubleType()) for c in KPI_COLUMNS])

SILVER = T.StructType(
    BRONZE.fields
    + [T.StructField("date", T.DateType()),
       T.StructField("hour", T.IntegerType()),
       T.StructField("latency_poor", T.BooleanType()),
       T.StructField("prb_high", T.BooleanType()),
       T.StructField("anomaly_flag", T.IntegerType())])

GOLD_AVG = [("latency_ms_avg", "latency_ms"), ("prb_util_pct_avg", "prb_util_pct"),
            ("thrpt_mbps_avg", "thrpt_mbps"), ("jitter_ms_avg", "jitter_ms"),
            ("pkt_loss_pct_avg", "pkt_loss_pct"), ("drop_rate_pct_avg", "drop_rate_pct"),
            ("sinr_db_avg", "sinr_db"), ("rsrp_dbm_avg", "rsrp_dbm")]

GOLD = T.StructType(
    [T.StructField("cell_id", T.StringType()),
     T.StructField("region", T.StringType()),
     T.StructField("ts_hour", T.TimestampNTZType()),
     T.StructField("n_samples", T.LongType()),
     T.StructField("latency_ms_avg", T.DoubleType()),
     T.StructField("latency_ms_p95", T.DoubleType())]
    + [T.StructField(n, T.DoubleType()) for n, _ in GOLD_AVG[1:]]
    + [T.StructField("anomaly_rate", T.DoubleType()),
       T.StructField("anomaly_any", T.IntegerType()),
       T.StructField("date", T.DateType()),
       T.StructField("hour", T.IntegerType()),
       T.StructField("y_next_anomaly", T.IntegerType())])

EDGES = T.StructType([T.StructField("src_cell_id", T.StringType()),
                      T.StructField("dst_cell_id", T.StringType())])


# Warehouse contracts (declared DDL of the reference's warehouse side).
FACT_CELL_HOUR = T.StructType(
    [T.StructField("cell_id", T.StringType()),
     T.StructField("region", T.StringType()),
     T.StructField("ts_hour", T.TimestampNTZType())]  # naive UTC on the lake side; TIMESTAMPTZ in the sink
    + [T.StructField(c, T.DoubleType()) for c in
       ["latency_ms_avg", "latency_ms_p95", "prb_util_pct_avg", "thrpt_mbps_avg", "sinr_db_avg",
        "rsrp_dbm_avg", "anomaly_rate"]]
    + [T.StructField("anomaly_any", T.ShortType()),
       T.StructField("y_next_anomaly", T.ShortType())]
    + [T.StructField(c, T.DoubleType()) for c in ["neighbor_degree", "pagerank", "betweenness"]])

MART_CELL_HOUR_SCORES = T.StructType(
    [T.StructField("cell_id", T.StringType()),
     T.StructField("region", T.StringType()),
     T.StructField("ts_hour", T.TimestampNTZType())]
    + [T.StructField(c, T.DoubleType()) for c in
       ["risk_score", "latency_ms_p95", "prb_util_pct_avg", "sinr_db_avg", "thrpt_mbps_avg"]])

GOLD_WAREHOUSE = T.StructType(
    [T.StructField("cell_id", T.StringType()),
     T.StructField("region", T.StringType()),
     T.StructField("ts_hour", T.TimestampNTZType()),
     T.StructField("n_samples", T.IntegerType())]
    + [T.StructField(c, T.DoubleType()) for c in
       ["latency_ms_avg", "latency_ms_p95", "prb_util_pct_avg", "thrpt_mbps_avg", "jitter_ms_avg",
        "pkt_loss_pct_avg", "drop_rate_pct_avg", "sinr_db_avg", "rsrp_dbm_avg", "anomaly_rate"]]
    + [T.StructField(c, T.ByteType()) for c in ["anomaly_any", "hour", "y_next_anomaly"]])


# Model features (fixed values: names and order as the reference's feature list).
BASE_FEATURES = ["latency_ms_avg", "latency_ms_p95", "prb_util_pct_avg", "thrpt_mbps_avg",
                 "jitter_ms_avg", "pkt_loss_pct_avg", "drop_rate_pct_avg",
                 "sinr_db_avg", "rsrp_dbm_avg", "anomaly_rate", "hour", "n_samples"]
TEMPORAL_BASE = ["latency_ms_p95", "prb_util_pct_avg", "thrpt_mbps_avg", "sinr_db_avg"]
TEMPORAL_FEATURES = ([f"{c}_lag1" for c in TEMPORAL_BASE] + [f"{c}_chg1" for c in TEMPORAL_BASE]
                     + [f"{c}_rm3" for c in TEMPORAL_BASE])
GRAPH_FEATURES = ["neighbor_degree", "pagerank", "betweenness"]
ALL_FEATURES = BASE_FEATURES + TEMPORAL_FEATURES + GRAPH_FEATURES
