"""Slices, windows and top-k reports on tiny frames."""

import datetime as dt

from cellgrid.operators import aggregates as A
from cellgrid.operators import slices as L
from cellgrid.operators.prefix import global_row_number, prefix_sums
from pyspark.sql import functions as F

T0 = dt.datetime(2024, 1, 1)
COLS = "cell_id string, region string, ts_hour timestamp_ntz, risk_score double"


def test_latest_and_recent_windows(spark):
    df = spark.createDataFrame([("a", "r1", T0, 0.1), ("b", "r1", T0 + dt.timedelta(hours=12), 0.2),
                                ("c", "r2", T0 + dt.timedelta(hours=13), 0.3)], COLS)
    assert [r.cell_id for r in L.latest_hour(df).collect()] == ["c"]
    assert sorted(r.cell_id for r in L.recent_window(df, "ts_hour", 13).collect()) == ["a", "b", "c"]
    assert sorted(r.cell_id for r in L.recent_window(df, "ts_hour", 13, inclusive=False).collect()) == ["b", "c"]
    assert sorted((r.region, r.cell_id) for r in L.latest_by_region(df).collect()) == [("r1", "b"), ("r2", "c")]


def test_top_k_ties_are_deterministic(spark):
    df = spark.createDataFrame([("b", "r1", T0, 0.5), ("a", "r2", T0, 0.5), ("a", "r1", T0, 0.5),
                                ("c", "r1", T0, None)], COLS)
    assert [(r.cell_id, r.region) for r in L.top_risk(df, 2).collect()] == [("a", "r1"), ("a", "r2")]
    per = {(r.region, r.rank): r.cell_id for r in L.top_per_region(df, 2).collect()}
    assert per == {("r1", 1): "a", ("r1", 2): "b", ("r2", 1): "a"}


def test_series_tail_and_slice(spark):
    rows = [("a", "r1", T0 + dt.timedelta(days=i), float(i)) for i in range(5)]
    df = spark.createDataFrame(rows, COLS)
    assert sorted(r.risk_score for r in L.series_tail(df, "cell_id", "ts_hour", 2).collect()) == [3.0, 4.0]
    d = df.withColumn("date", F.to_date("ts_hour"))
    got = L.slice_region_date(d, "r1", "latest").collect()
    assert len(got) == 1 and got[0].risk_score == 4.0


def test_prefix_sums_and_row_numbers_cross_partitions(spark):
    df = spark.range(0, 1000).select(F.col("id"), (F.col("id") % 7).alias("v"))
    assert prefix_sums(df, [F.col("id").asc()], ["v"]).columns == [*df.columns, "cum_v"]
    assert prefix_sums(df, [F.col("id").asc()], ["v"], totals=True).columns == [*df.columns, "cum_v", "total_v"]
    out = prefix_sums(df, [F.col("id").asc()], ["v"], num_partitions=5).orderBy("id").collect()
    run = 0
    for r in out:
        run += r.v
        assert r.cum_v == run
    rn = global_row_number(df, [F.col("id").desc()], num_partitions=7).collect()
    assert sorted((r.row_idx, r.id) for r in rn)[0] == (1, 999) and len({r.row_idx for r in rn}) == 1000


def test_slo_counts_null_as_miss(spark):
    df = spark.createDataFrame([(T0, 10.0, 10.0, 0.1), (T0, None, 70.0, 0.9)],
                               "ts_hour timestamp_ntz, prb_util_pct_avg double, latency_ms_p95 double, "
                               "drop_rate_pct_avg double")
    r = A.slo_daily(df).first()
    assert (r.capacity_slo, r.latency_slo, r.reliability_slo, r.n_cell_hours) == (0.5, 0.5, 0.5, 2)
