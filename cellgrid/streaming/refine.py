"""Incremental bronze -> silver -> hourly gold as a Structured Streaming job.

Same silver rules and hourly rollup as the batch layers, fed by new files in a
source folder.  Event-time windows with a watermark bound the state: an hour is
finalised (appended) once the watermark passes its end, late rows inside the
allowed lateness still update it.  Later rows cannot change a finalised hour; they are
counted (``dropped_late_rows``) and still reach the silver layer (``start_silver``), from which
``operators.refresh.refresh_gold`` rebuilds the partitions concerned, with labels.  The next-hour label needs the following hour
and is left to it (window functions are not streamable).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.scalar import trunc_ntz
from ..operators.layers import gold_aggregates, silver
from ..sources.adapters import events_to_bronze

EVENTS_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def silver_stream(spark: SparkSession, source_dir: str, max_files: int = 16) -> DataFrame:
    raw = (spark.readStream.schema(EVENTS_SCHEMA).option("maxFilesPerTrigger", max_files)
           .parquet(source_dir))
    return silver(events_to_bronze(raw))


def gold_stream(silver_df: DataFrame, lateness: str = "2 hours", accuracy: int = 10000) -> DataFrame:
    """Hourly rollup per (cell, region) on event time.

    ``withWatermark`` needs TIMESTAMP; the NTZ wall clock (UTC) is turned into the same instant via
    its microseconds since the epoch, so windows align with UTC hours whatever the session time zone.
    """
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    s = (silver_df.withColumn("event_time", F.timestamp_micros(F.timestamp_diff("MICROSECOND", epoch, F.col("ts"))))
         .withColumn("ts_hour", trunc_ntz("ts", "hour"))
         .withWatermark("event_time", lateness))
    g = s.groupBy(F.window("event_time", "1 hour").alias("w"), "cell_id", "region", "ts_hour").agg(*gold_aggregates(accuracy))
    return g.drop("w").withColumn("date", F.to_date("ts_hour")).withColumn("hour", F.hour("ts_hour"))


def start_silver(spark: SparkSession, source_dir: str, sink_dir: str, checkpoint_dir: str,
                 trigger_seconds: int = 60) -> StreamingQuery:
    """Append every silver row, however late, to a (date, region) partitioned parquet layer."""
    return (silver_stream(spark, source_dir).writeStream.outputMode("append").format("parquet").option("path", sink_dir)
            .option("checkpointLocation", checkpoint_dir).partitionBy("date", "region")
            .trigger(processingTime=f"{trigger_seconds} seconds").start())


def dropped_late_rows(query: StreamingQuery) -> int:
    """Partial groups that arrived behind the watermark and were left out, over the query's recent batches.

    Rows are combined by group before the check, so one late group counts once a batch."""
    return sum(int(s["numRowsDroppedByWatermark"]) for p in query.recentProgress for s in p["stateOperators"])


def start_gold(spark: SparkSession, source_dir: str, sink_dir: str, checkpoint_dir: str,
               trigger_seconds: int = 60) -> StreamingQuery:
    """Append finalised hours to a (date, region) partitioned parquet layer, exactly once via the checkpoint."""
    g = gold_stream(silver_stream(spark, source_dir))
    return (g.writeStream.outputMode("append").format("parquet").option("path", sink_dir)
            .option("checkpointLocation", checkpoint_dir).partitionBy("date", "region")
            .trigger(processingTime=f"{trigger_seconds} seconds").start())
