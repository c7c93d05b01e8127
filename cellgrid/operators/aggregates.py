"""Group-level reports: anomaly ranking, SLO attainment, coverage, counts, pickers, class balance.

Every aggregate here is a partial + final hash aggregate (map-side combine), so a
hot key ships one partial row per task, not its raw rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .slices import on_latest_date


def top_cells_by_anomaly(silver: DataFrame, n: int = 10) -> DataFrame:
    """Mean flag / latency / PRB per cell, highest anomaly mean first (nulls last)."""
    agg = silver.groupBy("cell_id").agg(
        F.avg("anomaly_flag").alias("anomaly_flag"),
        F.avg("latency_ms").alias("latency_ms"),
        F.avg("prb_util_pct").alias("prb_util_pct"))
    return agg.orderBy(F.col("anomaly_flag").desc_nulls_last(), F.col("cell_id").asc()).limit(n)


def _share(pred) -> F.Column:
    # a NULL comparison counts as a miss (the reference compares in pandas, where NaN < x is False)
    return F.avg(F.coalesce(pred, F.lit(False)).cast("double"))


def slo_daily(gold: DataFrame, prb: float = 85.0, p95: float = 60.0, drop: float = 0.5) -> DataFrame:
    """Share of cell-periods meeting capacity (PRB), latency (p95) and reliability (drop) targets, per date."""
    return gold.groupBy(F.to_date("ts_hour").alias("date")).agg(
        _share(F.col("prb_util_pct_avg") < prb).alias("capacity_slo"),
        _share(F.col("latency_ms_p95") < p95).alias("latency_slo"),
        _share(F.col("drop_rate_pct_avg") < drop).alias("reliability_slo"),
        F.count(F.lit(1)).alias("n_cell_hours"))


def slo_latest(gold: DataFrame, **kw) -> DataFrame:
    """The last date's SLO row (the panel value); on a ``date`` partitioned layer only that date is read."""
    daily = slo_daily(on_latest_date(gold), **kw)
    return daily.filter(F.col("date") == daily.select(F.max("date")).scalar())


def series_coverage(gold: DataFrame, key: str = "cell_id", ts: str = "ts_hour") -> DataFrame:
    return gold.groupBy(key).agg(F.count(ts).alias("n"), F.min(ts).alias("start"), F.max(ts).alias("end"))


def cell_counts(gold: DataFrame, approx: bool = False) -> DataFrame:
    if approx:
        return gold.agg(F.count(F.lit(1)).alias("n_rows"), F.approx_count_distinct("cell_id").alias("n_cells"),
                        F.countDistinct("region").alias("n_regions"))
    # one row per cell, then per region: two distincts in one aggregate would copy every row for each
    pairs = gold.groupBy("region", "cell_id").agg(F.count(F.lit(1)).alias("n"))
    cells = pairs.groupBy("cell_id").agg(F.sum("n").alias("n"))
    regions = gold.select("region").distinct().select(F.count("region")).scalar()
    return cells.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n_rows"), F.count("cell_id").alias("n_cells")).withColumn(
        "n_regions", regions)


def distinct_values(df: DataFrame, cols: list[str]) -> DataFrame:
    """Picker lists: one (column, value) row per distinct value of each column."""
    parts = [df.select(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")).distinct() for c in cols]
    return reduce(DataFrame.unionByName, parts)


def class_weight(train: DataFrame, y: str = "y_next_anomaly", floor: float = 1e-6) -> DataFrame:
    """Positive rate floored at 1e-6 and the positive-class weight (1-p)/p."""
    p = F.greatest(F.avg(F.col(y).cast("double")), F.lit(floor))
    return train.agg(p.alias("pos_rate")).select(
        "pos_rate", ((1 - F.col("pos_rate")) / F.col("pos_rate")).alias("pos_weight"))
