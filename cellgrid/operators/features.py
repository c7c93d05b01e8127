"""Model features: graph join, lags, changes, rolling means; chronological split.

Lag and rolling windows are partitioned by cell over the aggregated layer (one
row per cell and period), so partitions are bounded by the time span.  The
graph side is a per-cell table; it is joined with a plain equi-join and AQE
turns it into a broadcast only when its measured size is under the threshold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import BASE_FEATURES, GRAPH_FEATURES, TEMPORAL_BASE
from .prefix import prefix_sums


def with_centrality(df: DataFrame, cent: DataFrame | None) -> DataFrame:
    """Left-join vertex features on cell_id; cells outside the graph get 0 (one copy of each column)."""
    if cent is None:
        return df.withColumns({"neighbor_degree": F.lit(0).cast("long"), "pagerank": F.lit(0.0),
                               "betweenness": F.lit(0.0)})
    base = df.drop(*[c for c in GRAPH_FEATURES if c in df.columns])
    out = base.join(cent.select("cell_id", *GRAPH_FEATURES), "cell_id", "left")
    return out.fillna({"neighbor_degree": 0, "pagerank": 0.0, "betweenness": 0.0})


def features(gold: DataFrame, centrality: DataFrame | None = None, cols: list[str] = TEMPORAL_BASE,
             window: int = 3, label: str = "y_next_anomaly") -> DataFrame:
    """Feature matrix: base columns, lag-1, one-step change, rolling mean (min 1 row), graph columns.

    Features are computed on every row (the label is kept separate and may be NULL),
    then missing feature values are filled with 0.
    """
    w = Window.partitionBy("cell_id").orderBy("ts_hour", "region")
    wr = w.rowsBetween(-(window - 1), Window.currentRow)
    df = gold
    new = {}
    for c in cols:
        new[f"{c}_lag1"] = F.lag(c, 1).over(w)
    df = df.withColumns(new)
    df = df.withColumns({f"{c}_chg1": F.col(c) - F.col(f"{c}_lag1") for c in cols})
    df = df.withColumns({f"{c}_rm{window}": F.avg(c).over(wr) for c in cols})
    df = with_centrality(df, centrality)
    feats = (BASE_FEATURES + [f"{c}_lag1" for c in cols] + [f"{c}_chg1" for c in cols]
             + [f"{c}_rm{window}" for c in cols] + GRAPH_FEATURES)
    out = df.select("cell_id", "region", "ts_hour", label,
                    *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in feats])
    return out


def training_rows(df: DataFrame, label: str = "y_next_anomaly") -> DataFrame:
    return df.dropna(subset=[label])


def time_cutoff(df: DataFrame, ts: str = "ts_hour", frac: float = 0.8) -> DataFrame:
    """One-row frame: smallest ts whose cumulative row share reaches ``frac`` (= percentile_disc).

    Counted per distinct timestamp (partial aggregation), then running sums over the
    distinct timestamps, so no task ever holds all values.
    """
    per_ts = df.groupBy(ts).agg(F.count(F.lit(1)).alias("n"))
    cum = prefix_sums(per_ts, [F.col(ts).asc()], ["n"], totals=True)
    return cum.filter(F.col("cum_n") >= F.lit(frac) * F.col("total_n")).agg(F.min(ts).alias("cutoff"))


def time_split(df: DataFrame, ts: str = "ts_hour", frac: float = 0.8) -> DataFrame:
    """Tag each row ``train`` (ts < cutoff) or ``test`` (ts >= cutoff): a split by time, not by cell."""
    cutoff = time_cutoff(df, ts, frac).scalar()
    return df.withColumn("split", F.when(F.col(ts) < cutoff, "train").otherwise("test"))
