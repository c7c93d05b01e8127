"""Sources and sinks: partitioned layers, dynamic overwrite, CSV fallback with header aliases, metrics JSON."""

import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from cellgrid.sources import readers as R
from cellgrid.sources import sinks as K

D0 = dt.date(2024, 1, 1)


def _tmp():
    return tempfile.mkdtemp(prefix="cellgrid-io-")


def test_partitioned_layer_round_trip_and_dynamic_overwrite(spark):
    root = os.path.join(_tmp(), "layer")
    df = spark.createDataFrame([(1, D0, "a"), (2, D0, "b"), (3, D0 + dt.timedelta(days=1), "a")],
                               "v int, date date, region string")
    K.write_layer(df, root)
    back = R.read_layer(spark, root)
    assert sorted(back.columns) == ["date", "region", "v"]
    assert back.filter((F.col("region") == "a") & (F.col("date") == D0)).count() == 1
    # rewrite only (D0, a): other partitions survive with dynamic overwrite
    K.write_layer(spark.createDataFrame([(9, D0, "a")], "v int, date date, region string"), root, dynamic=True)
    got = sorted(tuple(r) for r in R.read_layer(spark, root).select("v", "date", "region").collect())
    assert got == [(2, D0, "b"), (3, D0 + dt.timedelta(days=1), "a"), (9, D0, "a")]


def test_load_cells_falls_back_to_csv_with_aliases(spark):
    d = _tmp()
    csv = os.path.join(d, "scores")
    spark.createDataFrame([("C1", 0.2), ("C2", 0.3), ("C1", 0.5)], "CellID string, risk double") \
        .write.option("header", True).csv(csv)
    cells = R.load_cells(spark, [("parquet", os.path.join(d, "missing")), ("csv", csv)], default_region="dfw")
    assert sorted(tuple(r) for r in cells.collect()) == [("dfw", "C1"), ("dfw", "C2")]
    market = os.path.join(d, "fc")
    spark.createDataFrame([(" x ", "C3")], "Market string, Cell string").write.option("header", True).csv(market)
    got = R.load_cells(spark, [("csv", market)]).collect()
    assert [(r.region, r.cell_id) for r in got] == [("x", "C3")]   # the CSV writer trims values


def test_load_cells_raises_when_nothing_works(spark):
    import pytest
    with pytest.raises(FileNotFoundError):
        R.load_cells(spark, [("parquet", os.path.join(_tmp(), "nope"))])


def test_metrics_json_round_trip_with_default(spark):
    path = os.path.join(_tmp(), "metrics")
    doc = K.metrics_document({"auc_roc": spark.createDataFrame([(0.75,)], "auc_roc double"),
                              "operating_point": spark.createDataFrame([(0.085, 0.33, 0.64, 0.44)],
                                                                       "threshold double, precision double, "
                                                                       "recall double, f1 double")})
    K.write_metrics(doc, path)
    m = R.read_metrics(spark, path)
    row = spark.range(1).select(R.metrics_value(m, "operating_point.threshold", 0.5).alias("t"),
                                R.metrics_value(m, "auc_pr", 0.0).alias("missing")).first()
    assert row.t == 0.085 and row.missing == 0.0


def test_publish_table_and_normalize(spark):
    path = os.path.join(_tmp(), "tbl")
    df = spark.createDataFrame([(1, "a")], "x int, y string").toDF(" X ", "Y")
    t = K.publish_table(R.normalize_columns(df), "cellgrid_test_tbl", path)
    assert t.columns == ["x", "y"] and t.count() == 1
    assert R.project_present(t, ["y", "zz", "x"]).columns == ["y", "x"]


def test_cluster_conf_sizes_partitions():
    from cellgrid.session import cluster_conf
    c = cluster_conf(100 * 1024 ** 4, 8000)
    assert int(c["spark.sql.shuffle.partitions"]) == 409_600        # about 128 MB each, no cap
    small = cluster_conf(10 * 1024 ** 3, 64)
    assert int(small["spark.sql.shuffle.partitions"]) == 128         # 2 per core floor


def test_read_layer_keeps_declared_types(spark, tmp_path):
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("v", T.IntegerType()), T.StructField("missing", T.DoubleType()),
                           T.StructField("region", T.StringType())])
    spark.createDataFrame([(1, "007"), (2, "7")], "v int, region string").write.partitionBy("region").parquet(str(tmp_path / "t"))
    got = R.read_layer(spark, str(tmp_path / "t"), schema, partitioned=True)
    assert got.schema == schema
    assert sorted((r.v, r.missing, r.region) for r in got.collect()) == [(1, None, "007"), (2, None, "7")]


def test_metrics_document_is_extended_and_read_back(spark, tmp_path):
    from cellgrid.sources import sinks as K
    first, second = str(tmp_path / "a"), str(tmp_path / "b")
    report = spark.createDataFrame([("0", 0.9, 0.8, 0.85, 90), ("1", 0.5, 0.4, 0.44, 10)],
                                   "label string, precision double, recall double, f1_score double, support long")
    K.write_metrics(K.metrics_document({"auc_roc": spark.sql("SELECT 0.75D AS auc_roc"), "report": K.report_part(report),
                                        "features": K.features_part(spark, ["a", "b"])}), first)
    point = spark.sql("SELECT 0.3D AS threshold, 0.5D AS precision, 0.6D AS recall, 0.55D AS f1")
    K.write_metrics(K.extend_metrics(R.read_metrics(spark, first), {
        "operating_point": point, "report_at_threshold": K.report_part(report.limit(1), "report_at_threshold")}), second)
    m = R.read_metrics(spark, second).first()
    assert m.auc_roc == 0.75 and m.features == ["a", "b"] and m.operating_point.threshold == 0.3
    assert m.report["1"]["f1-score"] == 0.44 and set(m.report_at_threshold) == {"0"}


def test_add_column_statements(spark):
    from cellgrid.sources import sinks as K
    df = spark.createDataFrame([(1, 2.0, True)], "a long, b double, c boolean")
    assert K.add_column_statements(df, "t", {"a": "BIGINT"}) == [
        'ALTER TABLE t ADD COLUMN IF NOT EXISTS "b" DOUBLE PRECISION', 'ALTER TABLE t ADD COLUMN IF NOT EXISTS "c" BOOLEAN']


def test_coerce_rounds_halves_to_even(spark):
    from cellgrid.sources import sinks as K
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (-0.5,)], "x double")
    assert [r.x for r in K.coerce_types(df, {"x": "bigint"}).collect()] == [0, 2, 2, 0]


def test_fingerprint_follows_the_files_of_a_folder(spark, tmp_path):
    from cellgrid.session import input_fingerprint
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(path)
    before = input_fingerprint(spark, path)
    assert before == input_fingerprint(spark, path)
    spark.range(5).write.mode("append").parquet(path)
    assert before != input_fingerprint(spark, path)
