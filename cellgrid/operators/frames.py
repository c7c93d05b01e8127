"""Frame-shape helpers that need one small decision from the data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def drop_empty_columns(df: DataFrame) -> DataFrame:
    """Drop columns with no non-null value.

    One aggregation pass computes ``count(c)`` for every column; only that one row
    of counts reaches the driver to decide the projection.
    """
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns]).first().asDict()
    return df.select([F.col(f"`{c}`") for c in df.columns if counts[c] > 0])
