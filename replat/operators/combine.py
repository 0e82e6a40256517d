"""Putting one-row results side by side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_one_row(left: DataFrame, right: DataFrame) -> DataFrame:
    """``left`` plus the columns of ``right``, a global aggregate (exactly one row)."""
    packed = right.select(F.struct(*right.columns)).scalar()
    return left.withColumn("_right", packed).select(*left.columns, "_right.*")
