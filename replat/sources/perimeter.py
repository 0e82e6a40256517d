"""Which regions belong to the event area: the perimeter's box, regions touching it, their children."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replat.functions import geometry as geo


def envelope(perimeter: DataFrame) -> DataFrame:
    """One row (xmin, ymin, xmax, ymax) over every ring point; nulls when there is none."""
    box = perimeter.select(geo.bounds(F.col("geometry.rings")).alias("b"))
    return box.agg(
        F.min("b.xmin").alias("xmin"),
        F.min("b.ymin").alias("ymin"),
        F.max("b.xmax").alias("xmax"),
        F.max("b.ymax").alias("ymax"),
    )


def require_envelope(perimeter: DataFrame) -> tuple[float, float, float, float]:
    """The envelope as four numbers; an error when the perimeter has no usable point."""
    row = envelope(perimeter).first()
    if row["xmin"] is None or row["ymin"] is None:
        raise ValueError("perimeter has no usable ring coordinates")
    return row["xmin"], row["ymin"], row["xmax"], row["ymax"]


def regions_in_envelope(regions: DataFrame, perimeter: DataFrame) -> DataFrame:
    """Regions whose polygon meets the perimeter's box (touching counts).

    The box is a one-row subquery, so each region is tested once and nothing is joined.
    """
    box = envelope(perimeter)
    packed = box.select(F.struct(*box.columns)).scalar()
    staged = regions.withColumn("_box", packed).withColumn("_own", geo.bounds(F.col("geometry.rings")))
    b, own = F.col("_box"), F.col("_own")
    near = (
        (own["xmax"] >= b["xmin"])
        & (own["xmin"] <= b["xmax"])
        & (own["ymax"] >= b["ymin"])
        & (own["ymin"] <= b["ymax"])
    )
    exact = geo.intersects_box(
        F.col("geometry.rings"), b["xmin"], b["ymin"], b["xmax"], b["ymax"]
    )
    return staged.filter(near & exact).drop("_box", "_own")


def children_of(subregions: DataFrame, regions: DataFrame, key: str = "ct20") -> DataFrame:
    """Sub-regions of the given regions, so that they partition them exactly."""
    return subregions.join(regions.select(key).distinct(), key, "left_semi")
