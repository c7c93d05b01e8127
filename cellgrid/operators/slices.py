"""Slices, recent windows, tails and top-k reports.

Global maxima are scalar subqueries (``DataFrame.scalar()``): Spark runs the
one-row aggregate (partial + final) as its own job and inlines the value, so the
main scan keeps its filter and no join is planned.  Top-k uses
``orderBy(...).limit(n)`` (TakeOrderedAndProject: a per-task top-n, then a merge)
and per-group top-k uses ``row_number() <= n`` which Spark plans with a
WindowGroupLimit before the exchange, so a hot group ships only n rows.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def max_of(df: DataFrame, c: str):
    """Scalar subquery column: ``(SELECT max(c) FROM df)``."""
    return df.select(F.max(c)).scalar()


def slice_region_date(df: DataFrame, region: str, date: str | None = "latest") -> DataFrame:
    """Rows of one region and one date; ``date="latest"`` picks that region's last date.

    Both filters reach the scan; on a ``date``/``region`` partitioned layer they prune partitions.
    """
    part = df.filter(F.col("region") == F.lit(region))
    if date is None:
        return part
    if date == "latest":
        return part.filter(F.col("date") == max_of(part, "date"))
    return part.filter(F.col("date") == F.lit(date).cast("date"))


def on_latest_date(df: DataFrame) -> DataFrame:
    """Rows of the newest ``date``, as a literal filter that prunes the partitions of a layer.

    The newest date is one value, found from the partition column alone.  Frames without
    a ``date`` column, or without rows, come back as they are.
    """
    if "date" not in df.columns:
        return df
    last = df.select(F.max("date")).first()[0]
    return df if last is None else df.filter(F.col("date") == F.lit(last))


def latest_hour(df: DataFrame, ts: str = "ts_hour") -> DataFrame:
    """Rows at the newest timestamp; on a ``date`` partitioned layer only the last date is read."""
    last = on_latest_date(df)
    return last.filter(F.col(ts) == max_of(last, ts))


def recent_window(df: DataFrame, ts: str, hours: int, inclusive: bool = True, anchor=None) -> DataFrame:
    """Rows with ``ts >= anchor - hours`` (``>`` when not inclusive); anchor defaults to max(ts).

    On a ``date`` partitioned layer the anchor is read from the last date only, and dates before
    the window are pruned.
    """
    if anchor is None and "date" in df.columns:
        newest = on_latest_date(df).select(F.max(ts)).first()[0]  # one value
        if newest is not None:
            first_day = (newest - timedelta(hours=hours)).date()
            df, anchor = df.filter(F.col("date") >= F.lit(first_day)), F.lit(newest).cast(df.schema[ts].dataType)
    anchor = max_of(df, ts) if anchor is None else anchor
    lower = anchor - F.make_dt_interval(F.lit(0), F.lit(hours))
    cond = F.col(ts) >= lower if inclusive else F.col(ts) > lower
    return df.filter(cond)


def latest_rows(df: DataFrame, ts: str, n: int, tiebreak: list[str] | None = None) -> DataFrame:
    """Newest ``n`` rows overall, in time order."""
    keys = [F.col(ts).desc()] + [F.col(c).desc() for c in (tiebreak or [])]
    return df.orderBy(*keys).limit(n)


def series_tail(df: DataFrame, key: str, ts: str, n: int, tiebreak: list[str] | None = None) -> DataFrame:
    """Last ``n`` rows of every series (per-group top-k, partial limit before the shuffle)."""
    w = Window.partitionBy(key).orderBy(F.col(ts).desc(), *[F.col(c).desc() for c in (tiebreak or [])])
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def top_risk(scores: DataFrame, n: int, by: str = "risk_score", key: str = "cell_id") -> DataFrame:
    """Top ``n`` by score; ties by cell, then region (a cell can have two region rows in one period)."""
    ties = [F.col(key).asc()] + ([F.col("region").asc()] if "region" in scores.columns else [])
    return scores.orderBy(F.col(by).desc_nulls_last(), *ties).limit(n)


def last_hour_risk(scores: DataFrame, n: int = 50, ts: str = "ts_hour") -> DataFrame:
    """Warehouse view: rows of the newest hour, highest risk first, at most ``n``."""
    return top_risk(latest_hour(scores, ts), n)


def top_per_region(scores: DataFrame, n: int = 10, by: str = "risk_score") -> DataFrame:
    w = Window.partitionBy("region").orderBy(F.col(by).desc_nulls_last(), F.col("cell_id").asc())
    return scores.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def latest_by_region(df: DataFrame, ts: str = "ts_hour") -> DataFrame:
    """Rows at each region's newest timestamp: a small (region, max) aggregate, then a semi join.

    On a (date, region) partitioned layer each region's last date is found first; the join on the
    partition columns lets Spark prune the other dates while it runs.
    """
    if "date" in df.columns:
        days = df.groupBy("region").agg(F.max("date").alias("date"))
        df = df.join(days, ["region", "date"], "left_semi")
    last = df.groupBy("region").agg(F.max(ts).alias(ts))
    return df.join(last, ["region", ts], "left_semi")


def region_summary(gold: DataFrame) -> DataFrame:
    return gold.groupBy("region").agg(
        F.countDistinct("cell_id").alias("n_cells"),
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("n_samples").alias("n_samples"),
        F.avg("latency_ms_p95").alias("latency_ms_p95_avg"),
        F.avg("prb_util_pct_avg").alias("prb_util_pct_avg"),
        F.avg("anomaly_rate").alias("anomaly_rate"),
        F.sum("anomaly_any").cast("long").alias("anomaly_periods"),
        F.max("ts_hour").alias("last_ts"),
    )
