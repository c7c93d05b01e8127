"""Session construction and the shared scratch area.

Intermediate tables (layers, edges, centrality, models, round-trip sinks) are
written under the application's checkpoint folder, inside the folder the cluster
names in ``spark.checkpoint.dir``.  Only when that setting is absent in local mode
(unit tests, a laptop) do we pick a local folder ourselves.
"""

from __future__ import annotations

import hashlib
import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Session settings the library relies on.  Shuffle partition count is a
# parameter: 8 for local tests, a few thousand on a large cluster so that each
# shuffle partition stays in the 100-200 MB range.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_spark(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "cellgrid",
              extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def cluster_conf(input_bytes: int, total_cores: int, target_partition_mb: int = 128,
                 shuffle_ratio: float = 0.5) -> dict:
    """Settings for a cluster run, sized from the input volume.

    Scan splits of ``target_partition_mb``; shuffle partitions so that the shuffled bytes
    (``shuffle_ratio`` of the input after pruning and partial aggregation) land near the
    target per partition, at least 2 per core; AQE coalesces small ones and
    splits skewed ones at runtime.
    """
    target = target_partition_mb * 1024 * 1024
    shuffle = int(max(2 * total_cores, input_bytes * shuffle_ratio // target))
    return {
        "spark.sql.files.maxPartitionBytes": f"{target_partition_mb}m",
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{target_partition_mb}m",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.autoBroadcastJoinThreshold": "64m",
        "spark.sql.session.timeZone": "UTC",
    }


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of every executor.

    A zip of the package's sources goes into the shared checkpoint folder and is added to the
    application once.  Not needed where the package is installed on the nodes or on PYTHONPATH.
    """
    import io
    import zipfile
    from pathlib import Path

    sc = spark.sparkContext
    root = Path(__file__).parent
    if getattr(sc, "_cellgrid_shipped", False):
        return
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f"{root.name}/{f.relative_to(root)}")
    target = scratch_path(spark, "cellgrid.zip")
    jvm = sc._jvm
    path = jvm.org.apache.hadoop.fs.Path(target)
    out = path.getFileSystem(sc._jsc.hadoopConfiguration()).create(path, True)
    try:
        out.write(packed.getvalue())
    finally:
        out.close()
    sc.addPyFile(target)
    sc._cellgrid_shipped = True


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/...) for this cluster")
        configured = tempfile.mkdtemp(prefix="cellgrid-ckpt-")  # local runs and tests only
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path inside the shared scratch area (sibling of the checkpoint dir)."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([root, "cellgrid-tables", *parts])


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared scratch area (any Hadoop file system)."""
    if not path.startswith(scratch_path(spark) + "/"):
        raise ValueError(f"{path} is not in the scratch area")
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(jpath, True)


def free_shuffles(spark: SparkSession) -> None:
    """Give back the shuffle files that no plan refers to any more.

    Spark deletes them when the driver's garbage collector finds that out, so it is asked to look.  The scheduler still refers to the
    plan of its last job, hence one without a shuffle first.
    """
    spark.range(0, 1, 1, 1).collect()
    spark.sparkContext._jvm.System.gc()


def cut(df: DataFrame) -> DataFrame:
    """``df`` in a reliable checkpoint; shuffle files that no plan refers to any more are given back."""
    df = df.checkpoint()
    free_shuffles(df.sparkSession)
    return df


def _key(*parts: str) -> str:
    return hashlib.sha1("|".join(parts).encode()).hexdigest()[:16]


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(jvm.org.apache.hadoop.fs.Path(path + "/_SUCCESS"))


def input_fingerprint(spark: SparkSession, *paths: str) -> str:
    """Identify inputs by the names, lengths and modification times of all their files (any Hadoop file system)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    parts = []
    for p in paths:
        jp = jvm.org.apache.hadoop.fs.Path(p)
        files = jp.getFileSystem(conf).listFiles(jp, True)  # a folder's own length and time say nothing of its files
        found = []
        while files.hasNext():
            st = files.next()
            found.append(f"{st.getPath().getName()}:{st.getLen()}:{st.getModificationTime()}")
        parts.append(f"{p}:{hashlib.sha1('|'.join(sorted(found)).encode()).hexdigest()}")
    return "|".join(parts)


def code_fingerprint(*modules) -> str:
    """Hash of the source of the modules that define a materialized table."""
    import inspect
    return hashlib.sha1("".join(inspect.getsource(m) for m in modules).encode()).hexdigest()[:12]


def layer_path(spark: SparkSession, name: str, source_key: str) -> str:
    """Folder of a materialized layer."""
    return scratch_path(spark, f"{name}-{_key(name, source_key, os.environ.get('CELLGRID_VERSION', '1'))}")


def materialize_layer(spark: SparkSession, name: str, source_key: str, build, keys=("date", "region"),
                      schema=None) -> DataFrame:
    """Write ``build()`` once as a hive-partitioned layer in the shared scratch area and read it back."""
    from .sources.readers import read_layer
    from .sources.sinks import write_layer
    path = layer_path(spark, name, source_key)
    if not _exists(spark, path):
        write_layer(build(), path, keys)
    return read_layer(spark, path, schema, partitioned=True)


def materialize(spark: SparkSession, name: str, source_key: str, build) -> DataFrame:
    """Write ``build()`` once as parquet in the shared scratch area and read it back.

    Used to cut lineage of iterative results (graph metrics) and to share them
    between queries.  ``source_key`` identifies the inputs and the code that builds the
    table (see ``input_fingerprint`` / ``code_fingerprint``).
    """
    path = scratch_path(spark, f"{name}-{_key(name, source_key, os.environ.get('CELLGRID_VERSION', '1'))}")
    if not _exists(spark, path):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
