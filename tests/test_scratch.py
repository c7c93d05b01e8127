import re
import time

from pyspark.sql import functions as F

from cellgrid.session import scratch_path


def _shuffles(spark):
    """Ids of the shuffles whose files are on disk."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {int(i) for i in re.findall(r"/shuffle_(\d+)_", files.mkString("\n"))}


def _left(spark, before, most):
    for _ in range(40):  # the files go a moment later
        left = _shuffles(spark) - before
        if len(left) <= most:
            break
        time.sleep(0.25)
    return left


def test_stored_tables_of_toxicity_leave_no_shuffle_files(spark, tmp_path):
    from cellgrid.llm.toxicity import _stored
    before = _shuffles(spark)
    sums = spark.range(0, 50_000, 1, 4).groupBy((F.col("id") % 1000).alias("g")).agg(F.sum("id").alias("s"))
    table = _stored(sums, str(tmp_path / "table"))
    assert not _left(spark, before, 0)
    assert table.count() == 1000


def test_component_search_gives_back_the_shuffle_files_of_its_rounds(spark):
    from cellgrid.llm.components import connected_components
    scratch_path(spark)  # sets the checkpoint folder
    before = _shuffles(spark)
    found = connected_components(spark.range(40).selectExpr("id AS u", "id + 1 AS v"))
    # about 38 shuffles in all; those of the last rounds stay until the result is read
    assert len(_left(spark, before, 24)) <= 24
    assert [r.component for r in found.select("component").distinct().collect()] == [0]
