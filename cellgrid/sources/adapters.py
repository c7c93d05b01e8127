"""Adapter from the driver's ``events`` table to the bronze KPI layout.

Every KPI value is a deterministic function of the event row, so Spark and the
DuckDB oracle see identical bronze input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import BRONZE


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def events_to_bronze(events: DataFrame, merge_cells: int | None = None) -> DataFrame:
    """Map events to bronze rows.

    ``merge_cells`` folds users into that many cells (``user_id % merge_cells``), giving
    dense hourly series for the seasonal forecasters.
    """
    eid, uid = F.col("event_id"), F.col("user_id")
    cell_num = uid % merge_cells if merge_cells else uid
    null_d = F.lit(None).cast("double")
    return events.select(
        F.col("ts").cast("timestamp_ntz").alias("ts"),
        F.concat(F.lit("CELL-"), F.lpad(cell_num.cast("string"), 5, "0")).alias("cell_id"),
        F.when(eid % 101 == 0, F.lit(None).cast("string"))
         .when(uid % 3 == 0, "dfw").when(uid % 3 == 1, "nyc").otherwise("sea").alias("region"),
        F.when(eid % 97 == 0, null_d).otherwise((F.lit(-120) + eid % 50).cast("double")).alias("rsrp_dbm"),
        (F.lit(-10) - eid % 5).cast("double").alias("rsrq_db"),
        (F.lit(-5) + eid % 36).cast("double").alias("sinr_db"),
        F.get_json_object("props", "$.k").try_cast("double").alias("prb_util_pct"),
        (F.lit(200) - eid % 150).cast("double").alias("thrpt_mbps"),
        ((eid % 11).cast("double") / 10).alias("drop_rate_pct"),
        F.when(eid % 89 == 0, null_d).otherwise(F.col("value")).alias("latency_ms"),
        (eid % 9).cast("double").alias("jitter_ms"),
        ((eid % 7).cast("double") / 10).alias("pkt_loss_pct"),
    ).select([F.col(f.name).cast(f.dataType) for f in BRONZE.fields])


def bronze_from_events(spark: SparkSession, sf_dir: str, merge_cells: int | None = None) -> DataFrame:
    return events_to_bronze(read_events(spark, sf_dir), merge_cells)
