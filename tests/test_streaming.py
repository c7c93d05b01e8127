"""The streaming rollup equals the batch rollup once all hours are finalised."""

import tempfile

from pyspark.sql import functions as F

from cellgrid.operators import layers
from cellgrid.sources.adapters import bronze_from_events, events_to_bronze
from cellgrid.streaming.refine import gold_stream, silver_stream

SF = "/root/testdata/sf0.001"


def test_stream_gold_matches_batch(spark):
    ckpt = tempfile.mkdtemp(prefix="cellgrid-stream-")
    g = gold_stream(silver_stream(spark, f"{SF}/events*.parquet"), lateness="0 seconds")
    q = (g.writeStream.outputMode("complete").format("memory").queryName("gold_stream_test")
         .option("checkpointLocation", ckpt).start())
    q.processAllAvailable()
    q.stop()
    got = spark.table("gold_stream_test")
    batch = layers.gold(layers.silver(bronze_from_events(spark, SF)), label=False)
    cols = ["cell_id", "region", "ts_hour", "n_samples", "latency_ms_p95", "anomaly_any"]
    a = sorted(tuple(r) for r in got.select(*cols).collect())
    b = sorted(tuple(r) for r in batch.select(*cols).collect())
    assert a == b
    diff = got.join(batch, ["cell_id", "region", "ts_hour"]).select(
        F.max(F.abs(got.latency_ms_avg - batch.latency_ms_avg))).first()[0]
    assert diff is None or diff < 1e-9


def test_append_mode_finalises_hours_and_counts_late_rows(spark, tmp_path):
    import datetime as dt

    from cellgrid.streaming.refine import dropped_late_rows, start_gold
    src, sink = tmp_path / "in", str(tmp_path / "gold")
    start = dt.datetime(2024, 1, 1)
    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"

    def put(rows):
        spark.createDataFrame([(i, ts, u, "click", 10.0, "{}") for i, (ts, u) in enumerate(rows, 1)], schema).coalesce(1).write.mode("append").parquet(str(src))

    put([(start + dt.timedelta(minutes=10 * i), 1 + i % 3) for i in range(40)])
    q = start_gold(spark, str(src), sink, str(tmp_path / "ckpt"), trigger_seconds=0)
    try:
        q.processAllAvailable()
        put([(start + dt.timedelta(hours=30), 1)])
        q.processAllAvailable()
        put([(start + dt.timedelta(minutes=5), 1), (start + dt.timedelta(hours=31), 2)])  # the first is far behind
        q.processAllAvailable()
        assert dropped_late_rows(q) >= 1
    finally:
        q.stop()
    got = spark.read.parquet(sink)
    batch = layers.gold(layers.silver(events_to_bronze(spark.createDataFrame(
        [(i + 1, start + dt.timedelta(minutes=10 * i), 1 + i % 3, "click", 10.0, "{}") for i in range(40)], schema))), label=False)
    cols = ["cell_id", "ts_hour", "n_samples", "anomaly_any"]
    assert sorted(tuple(r) for r in got.select(*cols).collect()) == sorted(tuple(r) for r in batch.select(*cols).collect())
