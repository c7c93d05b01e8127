"""Per-series preparation: regular grid with linear interpolation, winsorising, length gate.

Everything is keyed by series (cell).  After the gold rollup a series has one row
per period, so each window partition is bounded by the time span, never by the
raw volume of a busy cell.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import clip, grain_step, trunc_ntz


def resample_mean(df: DataFrame, key: str, ts: str, y: str, grain: str = "hour") -> DataFrame:
    """Drop rows with null y, mean per (key, period)."""
    return (df.filter(F.col(y).isNotNull() & F.col(ts).isNotNull())
            .groupBy(key, trunc_ntz(ts, grain).alias("ds")).agg(F.avg(y).alias("y")))


def interpolate(df: DataFrame, key: str = "cell_id", ts: str = "ts_hour", y: str = "prb_util_pct_avg",
                grain: str = "hour") -> DataFrame:
    """Regular grid from each series' first to last period; gaps filled linearly, both ends held.

    Output (key, ds, y, observed).  The grid is ``sequence(first, last, step)`` exploded per
    series; previous/next observed points come from ``last``/``first`` with ignorenulls.
    """
    obs = resample_mean(df, key, ts, y, grain)
    bounds = obs.groupBy(key).agg(F.min("ds").alias("lo"), F.max("ds").alias("hi"))
    grid = bounds.select(key, F.explode(F.sequence("lo", "hi", F.expr(grain_step(grain)))).alias("ds"))
    g = grid.join(obs, [key, "ds"], "left")
    idx = F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("ds"))
    g = g.withColumn("_t", idx).withColumn("_ty", F.when(F.col("y").isNotNull(), F.col("_t")))
    before = Window.partitionBy(key).orderBy("ds").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    after = Window.partitionBy(key).orderBy("ds").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    g = g.select(key, "ds", "y", "_t",
                 F.last("y", True).over(before).alias("_y0"), F.last("_ty", True).over(before).alias("_t0"),
                 F.first("y", True).over(after).alias("_y1"), F.first("_ty", True).over(after).alias("_t1"))
    lin = F.col("_y0") + (F.col("_y1") - F.col("_y0")) * (F.col("_t") - F.col("_t0")) / (F.col("_t1") - F.col("_t0"))
    filled = (F.when(F.col("y").isNotNull(), F.col("y"))
              .when(F.col("_y0").isNull(), F.col("_y1"))
              .when(F.col("_y1").isNull(), F.col("_y0"))
              .otherwise(lin))
    return g.select(key, "ds", filled.alias("y"), F.col("y").isNotNull().alias("observed"))


def winsorize(df: DataFrame, key: str = "cell_id", y: str = "y", lo: float = 0.01, hi: float = 0.99) -> DataFrame:
    """Clip each series to its own [p_lo, p_hi] (exact, linearly interpolated percentiles)."""
    w = Window.partitionBy(key)
    q = F.percentile(F.col(y), F.array(F.lit(lo), F.lit(hi))).over(w)
    out = df.withColumn("_q", q)
    return out.withColumn("p_lo", F.col("_q")[0]).withColumn("p_hi", F.col("_q")[1]) \
        .withColumn(y, F.least(F.greatest(F.col(y), F.col("p_lo")), F.col("p_hi"))).drop("_q")


def series_lengths(df: DataFrame, key: str = "cell_id") -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n_points"))


def short_series(df: DataFrame, min_points: int, key: str = "cell_id") -> DataFrame:
    """Series rejected by the minimum-length gate (the report the reference keeps as a list)."""
    return series_lengths(df, key).filter(F.col("n_points") < min_points)


def long_enough(df: DataFrame, min_points: int, key: str = "cell_id") -> DataFrame:
    keep = series_lengths(df, key).filter(F.col("n_points") >= min_points).select(key)
    return df.join(keep, key, "left_semi")


def bounded(df: DataFrame, cols, lo: float = 0.0, hi: float = 100.0) -> DataFrame:
    return df.withColumns({c: clip(c, lo, hi) for c in cols})
