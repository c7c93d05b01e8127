"""Incremental refresh of the gold layer from a silver layer whose files change.

A silver folder grows by files, some of them late (``streaming.refine.start_silver`` appends every row, however late).  Each refresh
compares the files that are there with those of the last refresh (path, length, time of change), rolls up only the (date, region)
partitions whose files differ, and repairs labels elsewhere: a label is taken from the cell's next row, which may lie in another region
or on a later date, so a touched partition can change the label of a row before it.  Only partitions with a changed row are written.

A refresh writes its rows, the partitions that are left empty and the new list of files to a pending folder first and then applies
it; one that was interrupted is applied again by the next, so gold and the list of files never part.  One refresh runs at a time.
What reaches the driver are partition values, which Spark's own file index holds there anyway, and counts.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.sinks import write_layer
from .layers import gold, next_anomaly_label

KEYS = ["date", "region"]
ROW = ["cell_id", "region", "ts_hour"]


@dataclass
class Refreshed:
    """Partitions (date, region) rolled up anew, written for a repaired label only, and removed."""

    rebuilt: list[tuple]
    relabelled: list[tuple]
    emptied: list[tuple]


def _path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _there(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return fs.exists(p)


def _delete(spark: SparkSession, path: str) -> None:
    p, fs = _path(spark, path)
    fs.delete(p, True)


def _layer(spark: SparkSession, path: str) -> DataFrame:
    """A layer whose regions are strings, also those that look like numbers."""
    found = spark.read.parquet(path).schema
    text = T.StructType([T.StructField(f.name, T.StringType() if f.name == "region" else f.dataType) for f in found.fields])
    return spark.read.schema(text).parquet(path)


def layer_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, modified, date, region) of the layer's files; their content is not read."""
    schema = "path string, modificationTime timestamp, length long, content binary, date date, region string"
    return (spark.read.format("binaryFile").schema(schema).option("pathGlobFilter", "*.parquet").load(path)
            .select("path", "length", F.unix_micros("modificationTime").alias("modified"), *KEYS))


def _inside(parts: list[tuple]) -> Column:
    """Filter on partition columns, one term for each date, so that the scan lists only these folders."""
    regions: dict = {}
    for d, r in parts:
        regions.setdefault(d, []).append(r)
    terms = [(F.col("date") == F.lit(d)) & F.col("region").isin(rs) for d, rs in sorted(regions.items())]
    while len(terms) > 1:  # a balanced tree of terms
        terms = [terms[i] | terms[i + 1] if i + 1 < len(terms) else terms[i] for i in range(0, len(terms), 2)]
    return terms[0] if terms else F.lit(False)


def _values(df: DataFrame) -> list[tuple]:
    return sorted((r["date"], r["region"]) for r in df.select(*KEYS).distinct().collect())


def _last_list(spark: SparkSession, state: str) -> int:
    """Number of the newest list of files, -1 before the first refresh."""
    p, fs = _path(spark, f"{state}/files")
    names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
    return max((int(n.split("-")[1]) for n in names if n.startswith("list-") and _there(spark, f"{state}/files/{n}/_SUCCESS")), default=-1)


def _apply(spark: SparkSession, gold_path: str, state: str) -> None:
    """Bring a complete pending refresh into effect; doing so twice changes nothing."""
    pending = f"{state}/pending"
    rows = spark.read.parquet(f"{pending}/rows")
    if not rows.isEmpty():
        write_layer(rows, gold_path, tuple(KEYS), dynamic=True)
    gone = {r["folder"] for r in spark.read.parquet(f"{pending}/emptied").collect()}
    for folder in sorted(gone):
        _delete(spark, folder)
    done = spark.read.parquet(f"{pending}/number").first()["number"]
    spark.read.parquet(f"{pending}/files").write.mode("overwrite").parquet(f"{state}/files/list-{done}")
    _delete(spark, pending)
    if done:
        _delete(spark, f"{state}/files/list-{done - 1}")


def refresh_gold(spark: SparkSession, silver_path: str, gold_path: str, state: str, grain: str = "hour", strict: bool = False) -> Refreshed:
    """Bring the gold layer at ``gold_path`` up to the silver files at ``silver_path``; ``state`` is a folder of its own.

    The result equals ``gold(silver)`` over all files.  The first call builds everything.  ``strict`` labels look one period ahead, so repairs
    read the neighbouring dates only; in row mode the next row may be any time ahead, and the cells concerned are looked up in all dates.
    """
    pending = f"{state}/pending"
    if _there(spark, f"{pending}/number/_SUCCESS"):
        _apply(spark, gold_path, state)
    elif _there(spark, pending):
        _delete(spark, pending)
    last = _last_list(spark, state)
    layer_files(spark, silver_path).write.parquet(f"{pending}/files")
    now = spark.read.parquet(f"{pending}/files")
    before = now.limit(0) if last < 0 else spark.read.parquet(f"{state}/files/list-{last}")
    same = ["path", "length", "modified"]
    touched = _values(now.join(before, same, "left_anti").unionByName(before.join(now, same, "left_anti")))
    alive = set(_values(now))
    emptied = [p for p in touched if p not in alive]
    rebuilt = [p for p in touched if p in alive]

    silver = _layer(spark, silver_path)
    fresh = gold(silver.filter(_inside(rebuilt)), grain=grain, label=False)
    relabelled: list[tuple] = []
    if last < 0 or not _there(spark, gold_path) or not touched:
        rows = next_anomaly_label(fresh, strict=strict, grain=grain)
    else:
        fresh.write.parquet(f"{pending}/fresh")
        fresh = spark.read.parquet(f"{pending}/fresh")
        stored = _layer(spark, gold_path)
        inside = _inside(touched)
        cells = fresh.select("cell_id").unionByName(stored.filter(inside).select("cell_id")).distinct()
        rest = stored.filter(~inside)
        if strict:  # labels look at most a day ahead: rows from a day before to a day after the touched dates decide and change
            near = sorted({d + timedelta(days=k) for d, _ in touched for k in (-1, 0, 1, 2)})
            judged = sorted({d + timedelta(days=k) for d, _ in touched for k in (-1, 0)})
            rest = rest.filter(F.col("date").isin(near))
        narrow = [*ROW, "anomaly_any"]
        line = (fresh.select(*narrow, "date", F.lit(None).cast("int").alias("was"), F.lit(True).alias("fresh"))
                .unionByName(rest.join(cells, "cell_id", "left_semi").select(*narrow, "date", F.col("y_next_anomaly").alias("was"), F.lit(False).alias("fresh"))))
        next_anomaly_label(line, strict=strict, grain=grain).write.parquet(f"{pending}/labels")
        labels = spark.read.parquet(f"{pending}/labels")
        repair = labels.filter(~F.col("fresh") & ~F.col("was").eqNullSafe(F.col("y_next_anomaly")))
        if strict:
            repair = repair.filter(F.col("date").isin(judged))
        relabelled = _values(repair)
        mine = labels.filter("fresh").select(*ROW, "y_next_anomaly")
        repaired = repair.select(*ROW, F.col("y_next_anomaly").alias("now"), F.lit(True).alias("hit"))
        kept = (stored.filter(_inside(relabelled)).join(repaired, ROW, "left")
                .withColumn("y_next_anomaly", F.when(F.col("hit"), F.col("now")).otherwise(F.col("y_next_anomaly"))).drop("now", "hit"))
        rows = fresh.join(mine, ROW, "left").unionByName(kept)
    rows.write.parquet(f"{pending}/rows")
    folders: list[tuple] = []
    if emptied and _there(spark, gold_path):
        folders = [(r["folder"],) for r in layer_files(spark, gold_path).filter(_inside(emptied))
                   .select(F.regexp_replace("path", "/[^/]*$", "").alias("folder")).distinct().collect()]
    spark.createDataFrame(folders, "folder string").write.parquet(f"{pending}/emptied")
    spark.createDataFrame([(last + 1,)], "number int").write.parquet(f"{pending}/number")
    _apply(spark, gold_path, state)
    return Refreshed(rebuilt, relabelled, emptied)
