"""Parcel centroids to regions: containment first, then the nearest candidate whose box holds the point.

Candidates come from an equi-join on grid cells, never from comparing every parcel with every region.
A region goes into the cells of the grid level that fits its own size, so it covers at most a few cells
however large it is; a parcel looks up its cell on each level that occurs. Catalyst broadcasts the
region side when its size allows and shuffles on the cell otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replat.functions import geometry as geo

# A cell is 4 ** level wide and a region lies in cells of its own size, at most two in each direction, so a
# point meets the regions around it and not a whole city's.
_CELL_BASE = 4.0
_SMALLEST_LEVEL = -12


def centroids(parcels: DataFrame) -> DataFrame:
    """(parcel_seq, px, py): centroid of the largest ring; rows without a usable geometry drop out.

    The point comes out of a generator, so the join's null checks on it stay above and the ring sums
    are computed once per row.
    """
    point = F.array(geo.centroid(F.col("geometry.rings")))
    found = F.transform(
        F.filter(point, lambda c: c.isNotNull()),
        lambda c: F.struct(c["cx"].alias("px"), c["cy"].alias("py")),
    )
    return parcels.select(F.col("seq").alias("parcel_seq"), F.inline(found))


def region_shapes(regions: DataFrame, key: str) -> DataFrame:
    """Matching form of a region layer: key, order, box and edges. Regions that draw no area drop out.

    Identical polygons are merged onto the first of them, which is the one that would win anyway.
    """
    rings = F.col("geometry.rings")
    shapes = (
        regions.select(
            F.col("region_idx").cast("bigint").alias("region_idx"),
            F.col(key).cast("string").alias("region_key"),
            rings.alias("rings"),
        )
        .groupBy("rings")
        .agg(
            F.min_by("region_key", "region_idx").alias("region_key"),
            F.min("region_idx").alias("region_idx"),
        )
        .withColumn("edges", geo.polygon_edges(F.col("rings")))
        .filter(F.size("edges") > 0)
        .withColumn("box", geo.bounds(F.col("rings")))
    )
    extent = F.greatest(F.expr("box.xmax - box.xmin"), F.expr("box.ymax - box.ymin"))
    level = F.ceil(F.log(_CELL_BASE, F.nullif(extent, F.lit(0.0)))).cast("int")
    floor = F.lit(_SMALLEST_LEVEL)
    return shapes.drop("rings").withColumn("level", F.greatest(floor, F.coalesce(level, floor)))


def _cell(value: Column, level: Column) -> Column:
    return F.floor(value / F.pow(F.lit(_CELL_BASE), level))


def assign_regions(parcels: DataFrame, layers: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """``parcel_seq`` plus one column per layer holding the key of the parcel's region, or null.

    ``layers`` maps an output column to (regions, key column). All layers share one candidate join and
    one aggregation. Lowest region index wins among equal candidates.
    """
    shapes = None
    for name, (regions, key) in layers.items():
        part = region_shapes(regions, key).withColumn("layer", F.lit(name))
        shapes = part if shapes is None else shapes.unionByName(part)
    # A handful of integers, whatever the number of regions; found when the query runs.
    levels = shapes.agg(F.collect_set("level").alias("levels")).scalar()

    lvl = F.col("level")
    spread = (
        shapes.withColumn(
            "cell_x", F.explode(F.sequence(_cell(F.col("box.xmin"), lvl), _cell(F.col("box.xmax"), lvl)))
        )
        .withColumn(
            "cell_y", F.explode(F.sequence(_cell(F.col("box.ymin"), lvl), _cell(F.col("box.ymax"), lvl)))
        )
    )
    points = (
        centroids(parcels)
        .withColumn("level", F.explode(levels))
        .withColumn("cell_x", _cell(F.col("px"), lvl))
        .withColumn("cell_y", _cell(F.col("py"), lvl))
    )
    in_box = F.col("px").between(F.col("box.xmin"), F.col("box.xmax")) & F.col("py").between(
        F.col("box.ymin"), F.col("box.ymax")
    )
    inside = geo.contains(F.col("edges"), F.col("px"), F.col("py"))
    candidates = (
        points.join(spread, ["level", "cell_x", "cell_y"])
        .filter(in_box)
        .withColumn("inside", inside)
        .select(
            "parcel_seq",
            "layer",
            F.struct(
                (~F.col("inside")).alias("outside"),
                F.when(F.col("inside"), F.lit(0.0))
                .otherwise(geo.boundary_distance(F.col("edges"), F.col("px"), F.col("py")))
                .alias("distance"),
                F.col("region_idx"),
                F.col("region_key"),
            ).alias("choice"),
        )
    )
    # the smallest struct: containing before nearest, then distance, then region order
    picked = candidates.groupBy("parcel_seq").agg(
        *[F.min(F.when(F.col("layer") == name, F.col("choice"))).alias(name) for name in layers]
    )
    return picked.select(
        "parcel_seq",
        *[F.col(f"{n}.region_key").alias(n) for n in layers],
        *[F.col(f"{n}.outside").alias(f"{n}_by_distance") for n in layers],
        *[F.col(f"{n}.distance").alias(f"{n}_distance") for n in layers],
    )


def with_regions(analysis: DataFrame, assignment: DataFrame) -> DataFrame:
    """Attach the assigned region keys to the result rows; unassigned parcels keep nulls."""
    return analysis.join(assignment, "parcel_seq", "left")


def unassigned(assigned: DataFrame, layer: str) -> DataFrame:
    return assigned.filter(F.col(layer).isNull()).select("parcel_seq", "ain")
