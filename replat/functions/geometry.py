"""Planar geometry on ``rings`` (array of rings of ``[x, y]`` points) as column expressions.

Every ring counts as a polygon of its own, holes included. A ring may be open or closed.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from replat.functions.orientation import side

RINGS_TYPE = "array<array<array<double>>>"
GEOMETRY_TYPE = (
    f"struct<rings:{RINGS_TYPE},x:double,y:double,paths:array<array<array<double>>>>"
)


def _edges(ring: Column) -> Column:
    """Consecutive point pairs, with the closing edge back to the first point."""
    ahead = F.concat(F.slice(ring, 2, F.size(ring)), F.slice(ring, 1, 1))
    return F.zip_with(
        ring,
        ahead,
        lambda a, b: F.struct(
            F.get(a, F.lit(0)).alias("x1"),
            F.get(a, F.lit(1)).alias("y1"),
            F.get(b, F.lit(0)).alias("x2"),
            F.get(b, F.lit(1)).alias("y2"),
        ),
    )


def polygon_edges(rings: Column) -> Column:
    """Edge lists of the rings that can bound an area (three points or more)."""
    return F.transform(F.filter(rings, lambda r: F.size(r) >= 3), _edges)


def bounds(rings: Column) -> Column:
    """``struct<xmin, ymin, xmax, ymax>`` over every point of every ring."""
    points = F.flatten(rings)
    xs = F.transform(points, lambda p: F.get(p, F.lit(0)))
    ys = F.transform(points, lambda p: F.get(p, F.lit(1)))
    return F.struct(
        F.array_min(xs).alias("xmin"),
        F.array_min(ys).alias("ymin"),
        F.array_max(xs).alias("xmax"),
        F.array_max(ys).alias("ymax"),
    )


def _ring_moments(ring: Column) -> Column:
    """Area and centroid of one ring.

    Coordinates are taken relative to the first point: parcels are tiny against their longitude, and
    the products of the shoelace sum would lose those digits. A ring without area falls back to the
    length-weighted middle of its edges, and one without length to its first point.
    """
    x0, y0 = F.get(F.get(ring, F.lit(0)), F.lit(0)), F.get(F.get(ring, F.lit(0)), F.lit(1))
    zero = F.struct(*[F.lit(0.0).alias(n) for n in ("area2", "mx", "my", "len", "lx", "ly")])

    def step(acc: Column, e: Column) -> Column:
        ax, ay, bx, by = e["x1"] - x0, e["y1"] - y0, e["x2"] - x0, e["y2"] - y0
        cross = ax * by - bx * ay
        length = F.hypot(bx - ax, by - ay)
        return F.struct(
            (acc["area2"] + cross).alias("area2"),
            (acc["mx"] + (ax + bx) * cross).alias("mx"),
            (acc["my"] + (ay + by) * cross).alias("my"),
            (acc["len"] + length).alias("len"),
            (acc["lx"] + (ax + bx) / 2 * length).alias("lx"),
            (acc["ly"] + (ay + by) / 2 * length).alias("ly"),
        )

    def finish(acc: Column) -> Column:
        area3 = F.nullif(acc["area2"], F.lit(0.0)) * 3
        length = F.nullif(acc["len"], F.lit(0.0))
        return F.struct(
            (F.abs(acc["area2"]) / 2).alias("area"),
            (x0 + F.coalesce(acc["mx"] / area3, acc["lx"] / length, F.lit(0.0))).alias("cx"),
            (y0 + F.coalesce(acc["my"] / area3, acc["ly"] / length, F.lit(0.0))).alias("cy"),
        )

    return F.aggregate(_edges(ring), zero, step, finish)


def centroid(rings: Column) -> Column:
    """``struct<area, cx, cy>`` of the largest ring (first on equal areas); null without a usable ring."""
    usable = F.filter(rings, lambda r: F.size(r) >= 3)
    moments = F.transform(usable, _ring_moments)
    return F.aggregate(
        moments,
        F.lit(None).cast("struct<area:double,cx:double,cy:double>"),
        lambda best, m: F.when(best.isNull() | (m["area"] > best["area"]), m).otherwise(best),
    )


def parity(edges: Column, px: Column, py: Column) -> Column:
    """Of a point against one ring's edges: 1 strictly inside, 0 outside, -1 on the boundary.

    Counts crossings of a ray to the right. Only edges that reach the point's height matter, so these are all that
    has to be given.
    """

    def step(acc: Column, e: Column) -> Column:
        reaches = py.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"]))
        at = side(e, px, py)
        on = px.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"])) & (at == 0)
        up = (e["y1"] <= py) & (e["y2"] > py) & (at > 0)
        down = (e["y2"] <= py) & (e["y1"] > py) & (at < 0)
        return F.when((acc < 0) | ~reaches, acc).when(on, -1).when(up | down, 1 - acc).otherwise(acc)

    return F.aggregate(edges, F.lit(0), step)


def contains(edge_rings: Column, px: Column, py: Column) -> Column:
    """Strictly inside any ring."""
    return F.exists(edge_rings, lambda ring: parity(ring, px, py) == 1)


def edge_distance(e: Column, px: Column, py: Column) -> Column:
    dx, dy = e["x2"] - e["x1"], e["y2"] - e["y1"]
    along = ((px - e["x1"]) * dx + (py - e["y1"]) * dy) / F.nullif(dx * dx + dy * dy, F.lit(0.0))
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(along, F.lit(0.0))))
    return F.hypot(px - (e["x1"] + t * dx), py - (e["y1"] + t * dy))


def boundary_distance(edge_rings: Column, px: Column, py: Column) -> Column:
    """Distance to the nearest edge; for a point outside this is the distance to the polygon."""
    return F.array_min(
        F.transform(edge_rings, lambda ring: F.array_min(F.transform(ring, lambda e: edge_distance(e, px, py))))
    )


def intersects_box(
    rings: Column, xmin: Column, ymin: Column, xmax: Column, ymax: Column
) -> Column:
    """Polygon against a rectangle, touching included: a shared corner, an edge crossing, or nesting."""

    def inside(x: Column, y: Column) -> Column:
        return x.between(xmin, xmax) & y.between(ymin, ymax)

    def crosses(e: Column) -> Column:
        # the edge's box meets the rectangle and the rectangle's corners do not all lie on one side
        boxes = (
            (F.greatest(e["x1"], e["x2"]) >= xmin)
            & (F.least(e["x1"], e["x2"]) <= xmax)
            & (F.greatest(e["y1"], e["y2"]) >= ymin)
            & (F.least(e["y1"], e["y2"]) <= ymax)
        )
        sides = [side(e, x, y) for x in (xmin, xmax) for y in (ymin, ymax)]
        return boxes & (F.least(*sides) <= 0) & (F.greatest(*sides) >= 0)

    edges = polygon_edges(rings)
    return (
        F.exists(edges, lambda ring: F.exists(ring, lambda e: inside(e["x1"], e["y1"]) | crosses(e)))
        | contains(edges, xmin, ymin)
    )


def to_geojson(geometry: Column) -> Column:
    """GeoJSON text of an Esri-style geometry struct; null when there is nothing to draw."""

    def shape(kind: str, coordinates: Column) -> Column:
        return F.concat(
            F.lit(f'{{"type":"{kind}","coordinates":'), F.to_json(coordinates), F.lit("}")
        )

    rings, paths = geometry["rings"], geometry["paths"]
    return (
        F.when(F.size(rings) == 1, shape("Polygon", rings))
        .when(F.size(rings) > 1, shape("MultiPolygon", F.transform(rings, lambda r: F.array(r))))
        .when(
            geometry["x"].isNotNull() & geometry["y"].isNotNull(),
            shape("Point", F.array(geometry["x"], geometry["y"])),
        )
        .when(F.size(paths) == 1, shape("LineString", F.get(paths, F.lit(0))))
        .when(F.size(paths) > 1, shape("MultiLineString", paths))
    )
