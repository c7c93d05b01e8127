"""Sinks: partitioned parquet layers, tables, CSV, metrics JSON, and the warehouse mirror.

Partitioned writes use the ``REBALANCE`` hint on the partition keys rather than a
plain ``repartition``: with AQE, Spark splits a skewed (date, region) partition
into several writer tasks, so a region with a third of the rows does not end up
in one task, while small partitions are still coalesced into few files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_layer(df: DataFrame, path: str, keys: tuple[str, ...] = ("date", "region"), dynamic: bool = False,
                max_records_per_file: int | None = None) -> None:
    """Overwrite a hive-partitioned parquet layer; ``dynamic`` replaces only the partitions written."""
    w = df.hint("rebalance", *keys).write.mode("overwrite").partitionBy(*keys)
    if dynamic:
        w = w.option("partitionOverwriteMode", "dynamic")
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def publish_table(df: DataFrame, name: str, path: str) -> DataFrame:
    """Create or replace a catalog table stored at ``path``; returns the table as read back."""
    df.write.mode("overwrite").option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def metrics_document(parts: dict[str, DataFrame]) -> DataFrame:
    """Nest one-row frames into one JSON document row: {name: {..fields..}}; a frame of one column of
    the part's own name stays flat.  Each part's plan runs once, as one struct-valued scalar."""
    spark: SparkSession = next(iter(parts.values())).sparkSession
    return spark.range(1).select(F.to_json(F.struct(*_part_columns(parts))).alias("value"))


def _part_columns(parts: dict[str, DataFrame]) -> list:
    return [(one.select(F.col(name)) if one.columns == [name] else one.select(F.struct(*one.columns))).scalar().alias(name)
            for name, one in parts.items()]


def report_part(report: DataFrame, name: str = "report") -> DataFrame:
    """A classification report (one row per label) as one map: label -> precision, recall, f1-score, support."""
    entry = F.struct(F.col("label"), F.struct("precision", "recall", F.col("f1_score").alias("f1-score"),
                                              F.col("support").cast("double").alias("support")))
    return report.agg(F.map_from_entries(F.collect_list(entry)).alias(name))


def features_part(spark: SparkSession, features: list[str]) -> DataFrame:
    return spark.range(1).select(F.array(*[F.lit(f) for f in features]).alias("features"))


def extend_metrics(document: DataFrame, parts: dict[str, DataFrame]) -> DataFrame:
    """A read document (``read_metrics``) reopened: ``parts`` replace or add their fields, the others stay."""
    kept = [F.col(c) for c in document.columns if c not in parts]
    return document.select(F.to_json(F.struct(*kept, *_part_columns(parts))).alias("value"))


def write_metrics(doc: DataFrame, path: str) -> None:
    doc.coalesce(1).write.mode("overwrite").text(path)


# ---- warehouse mirror -------------------------------------------------------------------

# fixed values: sink type per Spark type family (int -> BIGINT, float -> DOUBLE PRECISION,
# bool -> BOOLEAN, datetime -> TIMESTAMPTZ, anything else -> TEXT)
def sink_type(dt: T.DataType) -> str:
    if isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "BIGINT"
    if isinstance(dt, (T.FloatType, T.DoubleType, T.DecimalType)):
        return "DOUBLE PRECISION"
    if isinstance(dt, T.BooleanType):
        return "BOOLEAN"
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return "TIMESTAMPTZ"
    return "TEXT"


def mirror_plan(df: DataFrame, existing: dict[str, str] | None = None) -> DataFrame:
    """Column plan for the sink: create the table if missing, add columns it lacks, keep the rest."""
    rows = []
    for f in df.schema.fields:
        st = sink_type(f.dataType)
        if existing is None:
            rows.append((f.name, st, "create"))
        elif f.name not in existing:
            rows.append((f.name, st, "add"))
        else:
            rows.append((f.name, existing[f.name], "keep"))
    return df.sparkSession.createDataFrame(rows, "column string, sink_type string, action string")


def add_column_statements(df: DataFrame, table: str, existing: dict[str, str]) -> list[str]:
    """The statements that add the sink columns ``table`` lacks, in column order."""
    return [f'ALTER TABLE {table} ADD COLUMN IF NOT EXISTS "{f.name}" {sink_type(f.dataType)}'
            for f in df.schema.fields if f.name not in existing]


def coerce_types(df: DataFrame, target: dict[str, str]) -> DataFrame:
    """Coerce columns to sink types: integers rounded (exact halves to even), bad values -> NULL, NULL boolean -> false."""
    out = []
    for c in df.columns:
        t = target.get(c, "").lower()
        x = F.col(c)
        if t in ("smallint", "integer", "bigint"):
            e = F.bround(x.try_cast("double")).try_cast("long")
        elif t == "boolean":
            e = F.coalesce(F.bround(x.try_cast("double")), F.lit(0.0)) != 0
        elif t.startswith("timestamp"):
            e = x.cast("string").try_cast("timestamp_ntz")
        elif t in ("double precision", "double", "float"):
            e = x.try_cast("double")
        elif t == "text":
            e = x.cast("string")
        else:
            e = x
        out.append(e.alias(c))
    return df.select(out)


def mirror_jdbc(df: DataFrame, url: str, table: str, props: dict[str, str] | None = None,
                max_writers: int | None = None, batch_size: int = 10000) -> None:
    """Truncate-and-load into a JDBC table (keeps the table definition); one writer per partition, at most
    ``max_writers`` (merged without a shuffle)."""
    ((df.coalesce(max_writers) if max_writers else df).write.mode("overwrite")
     .option("truncate", True).option("batchsize", batch_size)
     .jdbc(url, table, properties=props or {}))
