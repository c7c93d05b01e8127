"""Risk model (pyspark.ml), scoring, importances and linear attributions.

Training uses ``pyspark.ml`` tree ensembles, which scan the partitioned feature
table per level/iteration; nothing is collected but the model itself.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import ALL_FEATURES


def with_class_weight(train: DataFrame, label: str = "y_next_anomaly", floor: float = 1e-6,
                      out: str = "weight") -> DataFrame:
    """Positive rows weighted (1-p)/p, negatives 1 (the reference's scale_pos_weight)."""
    p = F.greatest(train.select(F.avg(F.col(label).cast("double"))).scalar(), F.lit(floor))
    return train.withColumn(out, F.when(F.col(label) == 1, (1 - p) / p).otherwise(F.lit(1.0)))


def fit_risk_model(train: DataFrame, features: list[str] = ALL_FEATURES, kind: str = "gbt",
                   label: str = "y_next_anomaly", seed: int = 7, n_trees: int | None = None) -> PipelineModel:
    """Class-weighted boosted trees (400 iterations, depth 4, step 0.07, subsample 0.9, 0.9 of
    features per tree) or a random forest (600 trees, depth 10)."""
    data = with_class_weight(train.withColumn(label, F.col(label).cast("double")), label)
    asm = VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep")
    if kind == "gbt":
        clf = GBTClassifier(labelCol=label, featuresCol="features", weightCol="weight",
                            maxIter=n_trees or 400, maxDepth=4, stepSize=0.07, subsamplingRate=0.9,
                            featureSubsetStrategy="0.9", seed=seed)
    elif kind == "rf":
        clf = RandomForestClassifier(labelCol=label, featuresCol="features", weightCol="weight",
                                     numTrees=n_trees or 600, maxDepth=10, seed=seed,
                                     featureSubsetStrategy="sqrt", subsamplingRate=1.0)
    else:
        raise ValueError(kind)
    return Pipeline(stages=[asm, clf]).fit(data)


def score(model: PipelineModel, df: DataFrame, out: str = "risk_score") -> DataFrame:
    """Positive-class probability as a column."""
    scored = model.transform(df)
    return scored.withColumn(out, vector_to_array("probability")[1]).drop(
        "features", "rawPrediction", "probability", "prediction")


def feature_importance(model: PipelineModel, features: list[str] = ALL_FEATURES) -> DataFrame:
    """(feature, importance) from the fitted ensemble; one row per feature."""
    imp = model.stages[-1].featureImportances.toArray().tolist()
    spark = SparkSession.builder.getOrCreate()  # the running session, also off the main thread
    return spark.createDataFrame(list(zip(features, [float(x) for x in imp])), "feature string, importance double")


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def linear_attributions(df: DataFrame, weights: dict[str, float], background: DataFrame | None = None) -> DataFrame:
    """Exact attributions of a linear score: coef * (x - mean(x)), means over ``background`` (default: df).

    All means come from one aggregate, used as a single struct-valued scalar subquery
    (one pass over the background rows, however many features).
    """
    bg = df if background is None else background
    means = bg.select(F.struct(*[F.avg(f).alias(f) for f in weights]).alias("m")).scalar()
    return df.withColumns({f"attr_{f}": F.lit(float(w)) * (F.col(f) - means[f]) for f, w in weights.items()})


def top_reasons(df: DataFrame, weights: dict[str, float], k: int = 3,
                keys: tuple[str, ...] = ("cell_id", "region", "ts_hour"),
                background: DataFrame | None = None) -> DataFrame:
    """Top-k feature names by absolute attribution, joined with ", " (ties by name)."""
    att = linear_attributions(df, weights, background)
    items = F.array(*[F.struct(F.abs(F.col(f"attr_{f}")).alias("a"), F.lit(f).alias("name")) for f in weights])
    ordered = F.array_sort(items, lambda x, y: F.when(x["a"] > y["a"], -1).when(x["a"] < y["a"], 1)
                           .when(x["name"] < y["name"], -1).when(x["name"] > y["name"], 1).otherwise(0))
    names = F.transform(F.slice(ordered, 1, k), lambda s: s["name"])
    return att.select(*keys, F.array_join(names, ", ").alias("top_reasons"))


def global_attribution(df: DataFrame, weights: dict[str, float], background: DataFrame | None = None) -> DataFrame:
    """Mean absolute attribution per feature over all given rows (unpivot + average)."""
    att = linear_attributions(df, weights, background)
    pairs = ", ".join(f"'{f}', `attr_{f}`" for f in weights)
    long = att.select(F.expr(f"stack({len(weights)}, {pairs}) AS (feature, attr)"))
    return long.groupBy("feature").agg(F.avg(F.abs("attr")).alias("importance"))


# fixed linear surrogate coefficients (rule: +-(1 + i mod 5) / 10, sign alternating by position)
LINEAR_WEIGHTS = {f: (1 if i % 2 == 0 else -1) * (1 + i % 5) / 10 for i, f in enumerate(ALL_FEATURES)}
