"""Running sums and row numbers over a global order without a single-partition window.

``Window.orderBy(x)`` with no partition key moves every row into one task.  Here
the frame is range-partitioned on the order key, each range computes its local
running sum, the per-range totals (one row per partition, a proven small size)
are turned into offsets and broadcast back.  Work and memory per task stay
bounded by the range size at any scale.

Two branches read the ranges (rows and totals).  Range bounds are sampled anew by every
exchange, so the ranged frame is stored once with its range number in a reliable checkpoint;
both branches, and any recomputation after a lost executor, see the same ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def _n_parts(df: DataFrame, num_partitions: int | None) -> int:
    if num_partitions:
        return num_partitions
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def prefix_sums(df: DataFrame, order: list[Column], sums: list[str], prefix: str = "cum_",
                num_partitions: int | None = None, totals: bool = False) -> DataFrame:
    """Add ``cum_<c>`` = inclusive running sum of ``c`` in the global ``order``.

    ``order`` must be a total order (add tie-break keys) when the result has to be deterministic.
    ``totals`` also adds ``total_<c>`` (grand total), taken from the per-partition totals at no
    extra pass over the data.
    """
    n = _n_parts(df, num_partitions)
    ensure_checkpoint_dir(df.sparkSession)
    # an explicit partition count makes this a REPARTITION_BY_NUM shuffle, which AQE never coalesces,
    # so spark_partition_id() is the range index when the checkpoint is written
    ranged = df.repartitionByRange(n, *order).withColumn("_pid", F.spark_partition_id()).checkpoint()
    w_local = Window.partitionBy("_pid").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = ranged.select("*", *[F.sum(c).over(w_local).alias(f"_loc_{c}") for c in sums])
    parts = ranged.groupBy("_pid").agg(*[F.sum(c).alias(f"_tot_{c}") for c in sums])
    w_off = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    w_all = Window.partitionBy(F.lit(0))                                       # same bounded frame
    offsets = parts.select("_pid", *[F.coalesce(F.sum(f"_tot_{c}").over(w_off), F.lit(0)).alias(f"_off_{c}")
                                      for c in sums],
                            *[F.sum(f"_tot_{c}").over(w_all).alias(f"_all_{c}") for c in sums])
    out = local.join(F.broadcast(offsets), "_pid")
    keep = [c for c in df.columns]
    extra = [F.col(f"_all_{c}").alias(f"total_{c}") for c in sums] if totals else []
    return out.select(*keep, *[(F.col(f"_loc_{c}") + F.col(f"_off_{c}")).alias(f"{prefix}{c}") for c in sums],
                      *extra)


def global_row_number(df: DataFrame, order: list[Column], name: str = "row_idx",
                      num_partitions: int | None = None) -> DataFrame:
    """1-based row number over a global order (distributed ``row_number() over (order by ...)``)."""
    one = df.withColumn("_one", F.lit(1).cast("long"))
    out = prefix_sums(one, order, ["_one"], prefix="_cum", num_partitions=num_partitions)
    return out.withColumnRenamed("_cum_one", name).drop("_one")
