"""Derived inputs shared by the registered queries (all computed from the driver tables)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import layers, sketches
from ..schemas import GOLD, SILVER
from ..session import code_fingerprint, input_fingerprint, layer_path, materialize, materialize_layer
from ..sources.adapters import bronze_from_events


def bronze(spark: SparkSession, sf_dir: str, merge_cells: int | None = None) -> DataFrame:
    return bronze_from_events(spark, sf_dir, merge_cells)


def _layer_key(spark: SparkSession, sf_dir: str, *extra) -> str:
    from ..functions import scalar
    from ..sources import adapters
    return "|".join([input_fingerprint(spark, f"{sf_dir}/events.parquet"),
                     code_fingerprint(layers, adapters, scalar), *map(str, extra)])


def silver(spark: SparkSession, sf_dir: str, merge_cells: int | None = None, fresh: bool = False) -> DataFrame:
    """Silver layer.  Downstream queries read it as a written (date, region) partitioned table, as the
    batch pipeline does; ``fresh=True`` derives it from the source table in the same plan."""
    if fresh:
        return layers.silver(bronze(spark, sf_dir, merge_cells))
    return materialize_layer(spark, f"silver-m{merge_cells}", _layer_key(spark, sf_dir, merge_cells),
                             lambda: silver(spark, sf_dir, merge_cells, fresh=True), schema=SILVER)


def gold(spark: SparkSession, sf_dir: str, grain: str = "hour", merge_cells: int | None = None,
         strict_label: bool = False, fresh: bool = False) -> DataFrame:
    """Gold layer at ``grain`` with the next-period label (same convention as ``silver``)."""
    if fresh:
        return layers.gold(silver(spark, sf_dir, merge_cells, fresh=True), grain=grain, strict_label=strict_label)
    name = f"gold-{grain}-m{merge_cells}-s{int(strict_label)}"
    return materialize_layer(spark, name, _layer_key(spark, sf_dir, merge_cells),
                             lambda: layers.gold(silver(spark, sf_dir, merge_cells, fresh=merge_cells is not None),
                                                 grain=grain, strict_label=strict_label), schema=GOLD)


def latency_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantile sketches of the latency per (cell, region, hour), stored beside gold."""
    return materialize(spark, "sketch-latency", f"{_layer_key(spark, sf_dir)}|{code_fingerprint(sketches)}",
                       lambda: sketches.quantile_layer(silver(spark, sf_dir)))


def cell_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct-cell sketches per (date, region), stored beside gold."""
    return materialize(spark, "sketch-cells", f"{_layer_key(spark, sf_dir)}|{code_fingerprint(sketches)}",
                       lambda: sketches.distinct_layer(silver(spark, sf_dir)))


def gold_path(spark: SparkSession, sf_dir: str, grain: str = "hour") -> str:
    """Root folder of the written gold layer."""
    gold(spark, sf_dir, grain)
    return layer_path(spark, f"gold-{grain}-mNone-s0", _layer_key(spark, sf_dir, None))


def risk_expr() -> F.Column:
    """Deterministic stand-in risk score used where a query needs a score column with an exact oracle."""
    return F.round(0.6 * F.least(F.col("latency_ms_p95") / 150.0, F.lit(1.0))
                   + 0.004 * F.col("prb_util_pct_avg"), 6)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day-grain gold with the deterministic risk score (every labelled and unlabelled row)."""
    return gold(spark, sf_dir, "day").withColumn("risk_score", risk_expr())


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..sources.readers import load_cells_from_gold
    return load_cells_from_gold(silver(spark, sf_dir))


def edges(spark: SparkSession, sf_dir: str, k: int = 2) -> DataFrame:
    from ..operators import graph, prefix
    key = _layer_key(spark, sf_dir, k, code_fingerprint(graph, prefix))
    return materialize(spark, f"edges-k{k}", key, lambda: graph.neighbor_lattice(cells(spark, sf_dir), k=k))


def pagerank(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators import graph, prefix
    key = _layer_key(spark, sf_dir, code_fingerprint(graph, prefix))
    return materialize(spark, "pagerank", key, lambda: graph.pagerank(edges(spark, sf_dir)))


def betweenness(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators import graph, prefix
    key = _layer_key(spark, sf_dir, code_fingerprint(graph, prefix))
    return materialize(spark, "betweenness", key, lambda: graph.betweenness(edges(spark, sf_dir)))


def centrality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators import graph, prefix
    key = _layer_key(spark, sf_dir, code_fingerprint(graph, prefix))
    return materialize(spark, "centrality", key, lambda: graph.centrality(edges(spark, sf_dir), pagerank(spark, sf_dir), betweenness(spark, sf_dir)))


def scores_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest-period scores per cell with graph features (one copy, nulls -> 0.0)."""
    from ..operators.slices import latest_hour
    from ..operators.features import with_centrality
    s = latest_hour(scored(spark, sf_dir))
    s = with_centrality(s, centrality(spark, sf_dir))
    return s.select("cell_id", "region", "ts_hour", "risk_score", "latency_ms_p95", "prb_util_pct_avg",
                    "sinr_db_avg", "thrpt_mbps_avg", "rsrp_dbm_avg", "jitter_ms_avg", "pkt_loss_pct_avg",
                    "neighbor_degree", "pagerank", "betweenness")


def risk_model_path(spark: SparkSession, sf_dir: str, kind: str, grain: str = "day") -> str:
    from ..session import _key, scratch_path
    from ..operators import features, graph, model as model_mod
    key = _layer_key(spark, sf_dir, kind, grain, code_fingerprint(features, graph, model_mod))
    return scratch_path(spark, f"model-{kind}-{grain}-{_key(kind, key, os.environ.get('CELLGRID_VERSION', '1'))}")


def risk_model(spark: SparkSession, sf_dir: str, kind: str, fit, grain: str = "day"):
    """Fit once per input folder and keep the model in the shared scratch area."""
    from pyspark.ml import PipelineModel

    from ..operators.model import save_model
    path = risk_model_path(spark, sf_dir, kind, grain)
    jvm = spark.sparkContext._jvm
    jp = jvm.org.apache.hadoop.fs.Path(path + "/metadata")
    if jp.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(jp):
        return PipelineModel.load(path)
    model = fit()
    save_model(model, path)
    return model
