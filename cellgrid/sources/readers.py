"""Readers: layer scans, CSV, header normalisation and aliases, cell sources, metrics lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values: header aliases accepted for cell and region columns
ALIASES = {"cell": "cell_id", "cellid": "cell_id", "market": "region", "cluster": "region"}


def read_layer(spark: SparkSession, path: str, schema: T.StructType | None = None,
               partitioned: bool = False) -> DataFrame:
    """Parquet layer; hive partition columns (``date=..``/``region=..``) come back as columns.

    With a schema there is no inference pass: types (those of partition columns too, so a region
    ``007`` stays a string) are the declared ones, and a declared column that no file has is null.
    """
    if schema is None:
        return spark.read.parquet(path)
    return spark.read.schema(schema).parquet(path).select([f.name for f in schema.fields])


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    r = spark.read.option("header", True)
    if schema is not None:
        r = r.schema(schema)
    else:
        r = r.option("inferSchema", True)
    return r.csv(path)


def normalize_columns(df: DataFrame) -> DataFrame:
    """Trim and lower-case every header."""
    return df.toDF(*[c.strip().lower() for c in df.columns])


def alias_columns(df: DataFrame, aliases: dict[str, str] = ALIASES, default_region: str | None = None) -> DataFrame:
    """cell/cellid -> cell_id, market/cluster -> region; add ``region`` = default when absent."""
    ren = {c: aliases[c.lower()] for c in df.columns if c.lower() in aliases and aliases[c.lower()] not in df.columns}
    out = df.withColumnsRenamed(ren) if ren else df
    if "region" not in out.columns and default_region is not None:
        out = out.withColumn("region", F.lit(default_region))
    return out


def project_present(df: DataFrame, wanted: list[str]) -> DataFrame:
    """Select the wanted columns that exist, in the wanted order."""
    have = set(df.columns)
    return df.select([c for c in wanted if c in have])


def load_cells_from_gold(gold_or_silver: DataFrame) -> DataFrame:
    """(region, cell_id) pairs, null ids dropped, duplicates removed."""
    return gold_or_silver.select("region", "cell_id").filter(F.col("cell_id").isNotNull()).distinct()


def load_cells(spark: SparkSession, sources: list[tuple[str, str]], default_region: str = "global") -> DataFrame:
    """First source that yields cells: ("parquet", gold root), then ("csv", forecast/scores files).

    Raises FileNotFoundError when none works.
    """
    errors = []
    for kind, path in sources:
        try:
            if kind == "parquet":
                df = spark.read.parquet(path)
            else:
                df = alias_columns(normalize_columns(read_csv(spark, path)), default_region=default_region)
            if "cell_id" not in df.columns:
                raise ValueError("no cell_id column")
            if "region" not in df.columns:
                df = df.withColumn("region", F.lit(default_region))
            return load_cells_from_gold(df.select(F.col("region").cast("string"), F.col("cell_id").cast("string")))
        except Exception as e:  # noqa: BLE001 - try the next source
            errors.append(f"{path}: {type(e).__name__}")
    raise FileNotFoundError("could not derive cells from any source: " + "; ".join(errors))


def metrics_value(metrics: DataFrame, path, default: float) -> F.Column:
    """A nested metrics field (dotted path or Column) as a scalar column, default when null."""
    c = F.col(path) if isinstance(path, str) else path
    return F.coalesce(metrics.select(c.cast("double")).scalar(), F.lit(float(default)))


_REPORT = T.MapType(T.StringType(), T.StructType([
    T.StructField("precision", T.DoubleType()), T.StructField("recall", T.DoubleType()),
    T.StructField("f1-score", T.DoubleType()), T.StructField("support", T.DoubleType())]))

METRICS_SCHEMA = T.StructType([
    T.StructField("auc_roc", T.DoubleType()),
    T.StructField("auc_pr", T.DoubleType()),
    T.StructField("report", _REPORT),
    T.StructField("report_at_threshold", _REPORT),
    T.StructField("features", T.ArrayType(T.StringType())),
    T.StructField("operating_point", T.StructType([
        T.StructField("threshold", T.DoubleType()), T.StructField("precision", T.DoubleType()),
        T.StructField("recall", T.DoubleType()), T.StructField("f1", T.DoubleType())])),
])


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Metrics JSON document (one JSON object per line) parsed with the declared schema."""
    return spark.read.text(path).select(F.from_json("value", METRICS_SCHEMA).alias("m")).select("m.*")
