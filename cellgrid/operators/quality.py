"""Data-quality checks: gaps, freshness and null shares, rule counts, schema drift.

Each check is one aggregation pass (``count_if`` per rule) that reduces to a few
rows, so the cost is a single scan regardless of how many rules are evaluated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def gap_check(gold: DataFrame, grain: str = "hour", key: str = "cell_id", ts: str = "ts_hour") -> DataFrame:
    """Per series: expected periods between first and last, present periods, missing periods."""
    unit = {"hour": "HOUR", "day": "DAY"}[grain]
    agg = gold.groupBy(key).agg(F.min(ts).alias("start"), F.max(ts).alias("end"),
                                F.countDistinct(ts).alias("present"))
    expected = F.timestamp_diff(unit, F.col("start"), F.col("end")) + 1
    return agg.withColumn("expected", expected.cast("long")).withColumn(
        "missing", (F.col("expected") - F.col("present")).cast("long"))


def dq_freshness(gold: DataFrame, as_of, max_hours: float = 2.0, max_null: float = 0.05,
                 ts: str = "ts_hour", cols=("prb_util_pct_avg", "latency_ms_p95")) -> DataFrame:
    """One row: newest period, null shares of two columns, hours behind ``as_of``, and the OK flag."""
    aggs = [F.max(ts).alias("max_ts")]
    names = []
    for c in cols:
        name = "null_" + c
        names.append(name)
        aggs.append(F.try_divide(F.count_if(F.col(c).isNull()), F.count(F.lit(1))).alias(name))
    one = gold.agg(*aggs)
    hours = F.timestamp_diff("MICROSECOND", F.col("max_ts"), as_of) / F.lit(3.6e9)
    one = one.withColumn("hours_behind", hours)
    ok = F.col("hours_behind") <= max_hours
    for n in names:
        ok = ok & (F.col(n) < max_null)
    return one.withColumn("ok", F.coalesce(ok, F.lit(False)))


def dq_rules(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """Evaluate SQL predicate rules in one pass: rows (rule, failed, total).

    A row fails when the predicate is false or NULL.
    """
    aggs = [F.count(F.lit(1)).alias("_total")]
    names = list(rules)
    for i, n in enumerate(names):
        aggs.append(F.expr(f"count_if(NOT coalesce(({rules[n]}), false))").alias(f"_r{i}"))
    one = df.agg(*aggs)
    pairs = ", ".join(f"'{n}', _r{i}" for i, n in enumerate(names))
    return one.select(F.expr(f"stack({len(names)}, {pairs}) AS (rule, failed)"), "_total") \
        .withColumnRenamed("_total", "total")


def schema_drift(df: DataFrame, contract: T.StructType, check_values: bool = False) -> DataFrame:
    """One row per difference between the frame's schema and the contract (missing, extra, type).

    ``check_values`` adds ``n_unfit``: for changed types, the number of non-null values that do
    not survive a cast to the contract type (one aggregation pass over the data).
    """
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rows = []
    for f in contract.fields:
        exp = f.dataType.simpleString()
        if f.name not in actual:
            rows.append((f.name, exp, None, "missing"))
        elif actual[f.name] != exp:
            rows.append((f.name, exp, actual[f.name], "type_changed"))
    names = {f.name for f in contract.fields}
    for n, t in actual.items():
        if n not in names:
            rows.append((n, None, t, "extra"))
    spark: SparkSession = df.sparkSession
    out = spark.createDataFrame(rows, "column string, expected string, actual string, status string")
    if not check_values:
        return out
    changed = [(n, f.dataType) for f in contract.fields for n in [f.name]
               if n in actual and actual[n] != f.dataType.simpleString()]
    if not changed:
        return out.withColumn("n_unfit", F.lit(None).cast("long"))
    counts = df.agg(*[F.count_if(F.col(n).isNotNull() & F.col(n).try_cast(t).isNull()).alias(n)
                      for n, t in changed])
    pairs = ", ".join(f"'{n}', `{n}`" for n, _ in changed)
    long = counts.select(F.expr(f"stack({len(changed)}, {pairs}) AS (column, n_unfit)"))
    return out.join(long, "column", "left")
