"""Position of a row within its group, for groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DAY_MS = 86_400_000
BLOCK = 4096


def position_in_group(df: DataFrame, key: str, date: str, seq: str, name: str = "position") -> DataFrame:
    """Adds the 1-based position of each row among the rows with its key, by ``date`` and then ``seq``.

    A window over a group would sort all of it in one task. Here rows are counted by nested buckets of the
    order (day, exact date, block of ``seq``); running sums over these counts give each bucket's offset, level by
    level, and only the rows of one block, at most ``BLOCK`` as ``seq`` is unique, are sorted together.
    """
    levels: dict[str, Column] = {
        "_day": F.floor(F.col(date) / DAY_MS),
        "_date": F.col(date),
        "_block": F.floor(F.col(seq) / BLOCK),
    }
    rows = df.withColumns(levels)
    within = [key]
    counts = rows.groupBy(key, *levels).agg(F.count(F.lit(1)).alias("_rows"))
    offset = F.lit(0)
    placed = counts
    for level in levels:
        own = counts.groupBy(*within, level).agg(F.sum("_rows").alias("_n"))
        earlier = Window.partitionBy(*within).orderBy(level).rowsBetween(Window.unboundedPreceding, -1)
        before = own.select(*within, level, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias(f"_before{level}"))
        within = [*within, level]
        placed = placed.join(before, within)
        offset = offset + F.col(f"_before{level}")
    inside = F.row_number().over(Window.partitionBy(*within).orderBy(seq))
    ranked = rows.withColumn("_inside", inside).join(placed.select(*within, offset.alias("_offset")), within)
    return ranked.select(*df.columns, (F.col("_offset") + F.col("_inside")).alias(name))
