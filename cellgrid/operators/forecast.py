"""Forecasting many series in parallel.

The naive forecaster is pure DataFrame code (``max_by`` + ``sequence``).  For the fitted models a series is packed into one row
of arrays (one entry per period after the gold rollup, so its size is bounded by the history span, not by the raw volume of the cell);
``mapInArrow`` then fits all series of a batch that have the same length as one matrix (``seriesfit``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import clip
from .seriesfit import SIMULATIONS, fit_matrix
from .seriesfit import Z80 as Z80
from .slices import series_tail

#: model tags of rows that are no prediction: the observed tail, and a series that no method could fit
OBSERVED, REJECTED = "observed", "rejected"


def predicted(model: str = "model") -> F.Column:
    return ~F.col(model).isin(OBSERVED, REJECTED)


FC_SCHEMA = "{key} string, ds timestamp_ntz, yhat double, yhat_lower double, yhat_upper double, model string"


def _unit(step: str) -> str:
    return {"hour": "HOUR", "day": "DAY"}[step]


def naive_forecast(series: DataFrame, key: str = "cell_id", horizon: int = 12, step: str = "hour",
                   z: float = 0.0, bounds: tuple[float, float] | None = None) -> DataFrame:
    """Last value carried forward ``horizon`` steps; band yhat +- z * stddev(y) (z=0: flat band)."""
    last = series.groupBy(key).agg(F.max_by("y", "ds").alias("yhat"), F.max("ds").alias("_last"),
                                   F.coalesce(F.stddev_samp("y"), F.lit(0.0)).alias("_sd"))
    fut = last.select(key, "yhat", "_sd", "_last", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("_i"))
    fut = fut.select(key, F.timestamp_add(_unit(step), F.col("_i"), F.col("_last")).alias("ds"),
                     F.col("yhat"), (F.col("yhat") - z * F.col("_sd")).alias("yhat_lower"),
                     (F.col("yhat") + z * F.col("_sd")).alias("yhat_upper"), F.lit("naive_last").alias("model"))
    if bounds:
        fut = fut.withColumns({c: clip(c, *bounds) for c in ("yhat", "yhat_lower", "yhat_upper")})
    return fut


#: numbers (points, or simulated steps of the band) of the series that are fitted as one matrix
FIT_NUMBERS = 2_000_000

_MICROS = {"hour": 3_600_000_000, "day": 86_400_000_000}


def _fit_batches(key: str, horizon: int, step: str, methods: tuple[str, ...], season: int, hist: int, bounds: tuple[float, float] | None):
    """Packed series (key, ds, y) -> rows of the observed tail and of the forecast."""
    names = [key, "ds", "y", "yhat", "yhat_lower", "yhat_upper", "model"]

    def rows(keys, ds, y, parts, model):
        width = ds.shape[1]
        nothing = np.full(ds.size, np.nan)
        return pa.RecordBatch.from_arrays(
            [keys.take(pa.array(np.repeat(np.arange(len(ds)), width))), pa.array(ds.ravel()).cast(pa.timestamp("us")),
             *[pa.array(nothing if x is None else x.ravel()) for x in (y, *parts)], pa.array(np.repeat(model, width), pa.string())], names=names)

    def pieces(b, n):
        for length in np.unique(n):
            at = np.flatnonzero(n == length)
            rows_at_once = max(1, FIT_NUMBERS // max(int(length), SIMULATIONS * horizon))
            for start in range(0, len(at), rows_at_once):
                yield b.take(pa.array(at[start:start + rows_at_once])), length

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = np.asarray(b.column("y").value_lengths())
            for part, length in pieces(b, n):
                keys = part.column(key)
                ds = np.asarray(part.column("ds").flatten().cast(pa.int64())).reshape(-1, length)
                y = np.asarray(part.column("y").flatten(), dtype=float).reshape(-1, length)
                yield rows(keys, ds[:, -hist:], y[:, -hist:], (None, None, None), np.full(len(ds), OBSERVED, dtype=object))
                yhat, low, high, model = fit_matrix(y, methods, horizon, season, bounds)
                done = np.array([m is not None for m in model])
                ahead = ds[:, -1:] + _MICROS[step] * np.arange(1, horizon + 1)
                fitted = pa.array(np.flatnonzero(done))
                yield rows(keys.take(fitted), ahead[done], None, (yhat[done], low[done], high[done]), model[done])
                # a series that no method fits stays visible as one row without a prediction
                left = pa.array(np.flatnonzero(~done))
                yield rows(keys.take(left), ds[~done, -1:], None, (None, None, None), np.full(int((~done).sum()), REJECTED, dtype=object))
    return run


def forecast(series: DataFrame, key: str = "cell_id", horizon: int = 12, step: str = "hour",
             methods: tuple[str, ...] = ("fourier", "hw", "naive"), season: int = 24, hist: int = 24,
             bounds: tuple[float, float] | None = None, min_points: int = 0) -> DataFrame:
    """Fit each series with the first method that succeeds, stack the observed tail and the forecast.

    ``series`` is (key, ds, y) on a regular grid (see ``series.interpolate``).  Series with fewer
    than ``min_points`` points are not fitted (``series.short_series`` lists them).  Methods: ``fourier``,
    ``fourier_weekly`` (adds weekly terms), ``trend`` and ``trend_multiplicative`` (changepoints, simulated band), ``hw``, ``linear``,
    ``naive``; only a series too short for a method falls through to the next.  Past the gate every series has ``horizon`` predicted rows or
    one row of model ``rejected`` (see ``rejected_series``).  The fit reads each series once and also returns its tail.
    """
    from .series import long_enough
    if min_points:
        series = long_enough(series, min_points, key)
    # a number of partitions of its own: the rows are few and small, but each costs a fit, so they must not be merged into one task
    parts = int(series.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = series.repartition(parts, F.col(key).cast("string"))
    packed = (spread.groupBy(F.col(key).cast("string").alias(key))
              .agg(F.array_sort(F.collect_list(F.struct("ds", F.col("y").cast("double").alias("y")))).alias("s"))
              .select(key, F.col("s.ds").alias("ds"), F.col("s.y").alias("y"), F.size("s").alias("n")))
    # series of one length meet in one task (or in neighbours, where they are many), since a matrix costs little more than one series
    packed = packed.repartitionByRange(parts, "n", key).sortWithinPartitions("n", key).drop("n")
    schema = f"{key} string, ds timestamp_ntz, y double, yhat double, yhat_lower double, yhat_upper double, model string"
    out = packed.mapInArrow(_fit_batches(key, horizon, step, methods, season, hist, bounds), schema)
    return out.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast("double")) for c in ("y", "yhat", "yhat_lower", "yhat_upper")})


def rejected_series(fc: DataFrame, key: str = "cell_id") -> DataFrame:
    """Series past the gate that no method could fit."""
    return fc.filter(F.col("model") == REJECTED).select(key, F.col("ds").alias("last_ds"))


def forecast_frame(series: DataFrame, fc: DataFrame, key: str = "cell_id", hist: int = 24) -> DataFrame:
    """Observed tail (model "observed", no yhat) stacked over the predicted rows (no y)."""
    tail = series_tail(series.select(key, "ds", "y"), key, "ds", hist).withColumn("model", F.lit("observed"))
    return tail.unionByName(fc, allowMissingColumns=True).select(
        key, "ds", F.col("y").cast("double").alias("y"), *[F.col(c).cast("double").alias(c)
                                                           for c in ("yhat", "yhat_lower", "yhat_upper")], "model")


def breach_probability(fc: DataFrame, limit: float = 85.0, horizon: int = 12, key: str = "cell_id") -> DataFrame:
    """Share of the horizon's predicted steps whose upper band reaches ``limit``."""
    pred = fc.filter(predicted())
    return pred.groupBy(key).agg(
        (F.count_if(F.col("yhat_upper") >= limit) / F.lit(float(horizon))).alias("p_breach"))


def forecast_sanity(fc: DataFrame, recent_points: int = 24, key: str = "cell_id") -> DataFrame:
    """Plausibility guard: flag when min(yhat) < recent median - 2*std and the recent trend is not down."""
    obs = series_tail(fc.filter(F.col("model") == "observed"), key, "ds", recent_points)
    t = F.timestamp_diff("HOUR", F.lit("2000-01-01 00:00:00").cast("timestamp_ntz"), F.col("ds")).cast("double")
    rec = obs.groupBy(key).agg(F.percentile("y", 0.5).alias("recent_median"),
                               F.coalesce(F.stddev_samp("y"), F.lit(0.0)).alias("recent_std"),
                               F.regr_slope(F.col("y"), t).alias("recent_slope"))
    pred = fc.filter(predicted()).groupBy(key).agg(F.min("yhat").alias("min_yhat"))
    out = pred.join(rec, key, "inner")
    flag = (F.col("min_yhat") < F.col("recent_median") - 2 * F.col("recent_std")) & \
        (F.coalesce(F.col("recent_slope"), F.lit(0.0)) >= 0)
    return out.withColumn("implausible", flag)


def forecast_summary(fc: DataFrame, key: str = "cell_id") -> DataFrame:
    """Per series: observed points, forecast horizon (distinct future steps), first/last step, models."""
    pred = predicted()
    return fc.groupBy(key).agg(
        F.count_if(F.col("model") == OBSERVED).alias("n_observed"),
        F.count_distinct(F.when(pred, F.col("ds"))).alias("n_forecast"),
        F.min(F.when(pred, F.col("ds"))).alias("first_forecast"),
        F.max(F.when(pred, F.col("ds"))).alias("last_forecast"),
        F.max(F.when(F.col("model") == OBSERVED, F.col("ds"))).alias("last_observed"),
        F.array_join(F.array_sort(F.collect_set(F.when(pred, F.col("model")))), ",").alias("models"))
