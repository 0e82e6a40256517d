from __future__ import annotations

import math
import random
from fractions import Fraction

import pytest
from builders import PARCEL, REGION, frame, parcel, square
from pyspark.sql import functions as F

from replat.functions import geometry as geo
from replat.operators import counts, spatial
from replat.sources import perimeter


def region(i, key, rings, parent=None):
    return {"region_idx": i, "ct20": parent or key, "bg20": key, "label": f"L{key}", "geometry": (rings,)}


def box(x0, y0, x1, y1):
    return [[[x0, y0], [x1, y0], [x1, y1], [x0, y1], [x0, y0]]]


def at(seq, x, y, half=0.25):
    return parcel(seq, f"P{seq}", geometry=square(x, y, half))


def assign(spark, parcel_rows, region_rows):
    p, r = frame(spark, PARCEL, parcel_rows), frame(spark, REGION, region_rows)
    out = spatial.assign_regions(p, {"region": (r, "bg20")})
    return {x["parcel_seq"]: x["region"] for x in out.collect()}


def test_squares_and_outside(spark):
    rows = [at(0, 2.5, 5), at(1, 5, 5), at(2, 15, 5), at(3, 100, 100), parcel(4, "P4", geometry=None)]
    got = assign(spark, rows, [region(0, "A", box(0, 0, 10, 10)), region(1, "B", box(10, 0, 20, 10))])
    assert got == {0: "A", 1: "A", 2: "B"}


def test_shared_edge_goes_to_the_first_region(spark):
    rows = [at(0, 10, 5), at(1, 0, 5)]
    got = assign(spark, rows, [region(1, "B", box(10, 0, 20, 10)), region(0, "A", box(0, 0, 10, 10))])
    assert got == {0: "A", 1: "A"}


def test_nearest_candidate_inside_boxes_only(spark):
    low = [[[0, 0], [10, 0], [0, 10]]]
    high = [[[10, 10], [10, 9.5], [9.5, 10]]]
    regions = [region(0, "low", low), region(1, "high", high), region(2, "far", box(11, 0, 12, 10))]
    rows = [at(0, 1, 1), at(1, 9, 9), at(2, 9.6, 9.6), at(3, 10.5, 5)]
    assert assign(spark, rows, regions) == {0: "low", 1: "low", 2: "high"}


def test_rings_are_solid_and_the_largest_parcel_ring_wins(spark):
    nested = [box(0, 0, 10, 10)[0], box(4, 4, 6, 6)[0]]
    two_rings = ([square(1, 1, 0.1)[0][0], square(25, 5, 1)[0][0]],)
    rows = [at(0, 5, 5, 0.1), parcel(1, "P1", geometry=two_rings)]
    got = assign(spark, rows, [region(0, "A", nested), region(1, "B", box(20, 0, 30, 10))])
    assert got == {0: "A", 1: "B"}


def test_degenerate_geometry(spark):
    flat = ([[[1.0, 1.0], [3.0, 1.0], [1.0, 1.0]]],)
    dot = ([[[4.0, 4.0], [4.0, 4.0], [4.0, 4.0]]],)
    short = ([[[4.0, 4.0], [5.0, 4.0]]],)
    rows = [parcel(i, f"P{i}", geometry=g) for i, g in enumerate([flat, dot, short, ([],)])]
    got = assign(spark, rows, [region(0, "A", box(0, 0, 10, 10)), region(1, "N", []), region(2, "S", [[[1, 1]]])])
    assert got == {0: "A", 1: "A"}


def test_centroid_keeps_digits_far_from_the_origin(spark):
    p = frame(spark, PARCEL, [at(0, -118.123456, 34.654321, 0.0001)])
    row = spatial.centroids(p).first()
    assert row["px"] == pytest.approx(-118.123456, abs=1e-12)
    assert row["py"] == pytest.approx(34.654321, abs=1e-12)


def inside(ring, x, y):
    odd = False
    for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1], strict=True):
        if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
            odd = not odd
    return odd


def distance(ring, x, y):
    best = float("inf")
    for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1], strict=True):
        dx, dy = x2 - x1, y2 - y1
        n = dx * dx + dy * dy
        t = max(0.0, min(1.0, ((x - x1) * dx + (y - y1) * dy) / n)) if n else 0.0
        best = min(best, ((x - x1 - t * dx) ** 2 + (y - y1 - t * dy) ** 2) ** 0.5)
    return best


def test_random_layout_equals_brute_force(spark):
    """Regions of very different sizes: the grid levels must not lose a candidate."""
    rnd = random.Random(7)
    regions = []
    for i in range(60):
        size = rnd.choice([0.01, 0.3, 1, 8, 60])
        cx, cy = rnd.uniform(-50, 50), rnd.uniform(-50, 50)
        ring = [[cx + rnd.uniform(-size, size), cy + rnd.uniform(-size, size)] for _ in range(rnd.choice([3, 4, 5]))]
        regions.append(region(i, f"R{i:02}", [ring]))
    points = [(rnd.uniform(-60, 60), rnd.uniform(-60, 60)) for _ in range(300)]
    got = assign(spark, [at(i, x, y, 1e-6) for i, (x, y) in enumerate(points)], regions)
    for i, (x, y) in enumerate(points):
        near = []
        for r in regions:
            ring = r["geometry"][0][0]
            xs, ys = [p[0] for p in ring], [p[1] for p in ring]
            if min(xs) <= x <= max(xs) and min(ys) <= y <= max(ys):
                hit = inside(ring, x, y)
                near.append((not hit, 0.0 if hit else distance(ring, x, y), r["region_idx"], r["bg20"]))
        assert got.get(i) == (min(near)[3] if near else None), (x, y)


def test_copies_of_one_polygon_collapse_onto_the_first(spark):
    same = [region(i, f"R{i}", box(0, 0, 10, 10)) for i in range(40)]
    shapes = spatial.region_shapes(frame(spark, REGION, same), "bg20")
    assert [(r["region_idx"], r["region_key"]) for r in shapes.collect()] == [(0, "R0")]
    assert assign(spark, [at(0, 5, 5)], list(reversed(same))) == {0: "R0"}


def test_large_regions_cover_few_cells(spark):
    rows = [region(0, "big", box(-1e6, -1e6, 1e6, 1e6)), region(1, "small", box(0, 0, 0.001, 0.001))]
    p = frame(spark, PARCEL, [at(0, 5, 5)])
    assigned = spatial.assign_regions(p, {"region": (frame(spark, REGION, rows), "bg20")})
    assert assigned.first()["region"] == "big"


def test_region_join_does_not_compare_all_pairs(spark, tmp_path):
    frame(spark, PARCEL, [at(0, 5, 5)]).write.parquet(str(tmp_path / "p"))
    frame(spark, REGION, [region(0, "A", box(0, 0, 10, 10))]).write.parquet(str(tmp_path / "r"))
    p, r = spark.read.parquet(str(tmp_path / "p")), spark.read.parquet(str(tmp_path / "r"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = spatial.assign_regions(p, {"region": (r, "bg20")})
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan
        assert "Cartesian" not in plan
        assert out.first()["region"] == "A"
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_region_counts_zero_fill_and_sum(spark):
    regions = frame(spark, REGION, [region(0, "A", box(0, 0, 10, 10)), region(1, "B", box(90, 90, 91, 91))])
    p = frame(spark, PARCEL, [at(0, 5, 5), at(1, 6, 6), at(2, 50, 50)])
    base = p.select(
        F.col("seq").alias("parcel_seq"), F.lit("destroyed").alias("damage"), F.lit("red").alias("bsd_status"),
        F.lit(7).alias("rebuild_progress_num"), F.lit(True).alias("lfl_claimed"), F.lit(10).alias("pre_sfr_sqft"),
        F.lit(10).alias("post_sfr_sqft"), F.lit(False).alias("adds_sb9"), F.lit(0).alias("added_adu_count"),
        F.lit(1).alias("post_sfr_count"), F.lit(0).alias("post_adu_count"),
    )
    assigned = spatial.with_regions(base, spatial.assign_regions(p, {"tract": (regions, "ct20")}))
    cells = counts.count_cells(assigned, ["tract"])
    got = {r["ct20"]: r.asDict() for r in counts.region_counts(cells, regions, "ct20", "tract", ["CT20", "LABEL"]).collect()}
    assert got["A"]["total_parcels"] == got["A"]["completed_count"] == 2
    assert all(got["B"][n] == 0 for n in counts.COUNT_FIELDS)
    assert counts.summary_of(cells).first()["total_parcels"] == 3
    assert spatial.unassigned(assigned.withColumn("ain", F.lit("x")), "tract").count() == 1


def test_perimeter_box_and_regions_touching_it(spark):
    fire = frame(spark, PARCEL, [at(0, 2, 2, 1), at(1, 5, 3, 1), parcel(2, "none", geometry=None)])
    assert perimeter.require_envelope(fire) == (1, 1, 6, 4)
    regions = [
        region(0, "inside", box(2, 2, 3, 3)),
        region(1, "around", box(-100, -100, 100, 100)),
        region(2, "touching", box(6, 0, 8, 5)),
        region(3, "away", box(7, 7, 8, 8)),
        region(4, "crossing", [[[-10, 2], [20, 2.5], [20, 2.6]]]),
        # its box covers the perimeter's box, the triangle itself does not reach it
        region(5, "corner only", [[[-10, 20], [20, 20], [20, -0.5]]]),
        region(6, "empty", []),
    ]
    got = perimeter.regions_in_envelope(frame(spark, REGION, regions), fire)
    kept = {r["bg20"] for r in got.collect()}
    assert kept == {"inside", "around", "touching", "crossing"}
    children = frame(spark, REGION, [region(0, "x1", box(0, 0, 1, 1), "inside"), region(1, "y1", box(0, 0, 1, 1), "away")])
    assert [r["bg20"] for r in perimeter.children_of(children, got).collect()] == ["x1"]
    with pytest.raises(ValueError, match="no usable ring"):
        perimeter.require_envelope(frame(spark, PARCEL, [parcel(2, "none", geometry=None)]))


def test_geojson_kinds(spark):
    ring = "array(array(0D,0D),array(1D,0D),array(1D,1D))"
    kinds = {
        f"struct(array({ring}) as rings, null as x, null as y, null as paths)":
            '{"type":"Polygon","coordinates":[[[0.0,0.0],[1.0,0.0],[1.0,1.0]]]}',
        f"struct(array({ring},{ring}) as rings, null as x, null as y, null as paths)":
            '{"type":"MultiPolygon","coordinates":[[[[0.0,0.0],[1.0,0.0],[1.0,1.0]]],[[[0.0,0.0],[1.0,0.0],[1.0,1.0]]]]}',
        "struct(null as rings, 1D as x, 2D as y, null as paths)": '{"type":"Point","coordinates":[1.0,2.0]}',
        f"struct(null as rings, null as x, null as y, array({ring}) as paths)":
            '{"type":"LineString","coordinates":[[0.0,0.0],[1.0,0.0],[1.0,1.0]]}',
        f"struct(null as rings, null as x, null as y, array({ring},{ring}) as paths)":
            '{"type":"MultiLineString","coordinates":[[[0.0,0.0],[1.0,0.0],[1.0,1.0]],[[0.0,0.0],[1.0,0.0],[1.0,1.0]]]}',
        "struct(null as rings, null as x, null as y, null as paths)": None,
    }
    for sql, want in kinds.items():
        row = spark.range(1).select(F.expr(sql).cast(geo.GEOMETRY_TYPE).alias("g"))
        assert row.select(geo.to_geojson(F.col("g")).alias("v")).first()["v"] == want


# ---------------------------------------------------------------- exact sides


def exact_parity(ring, x, y):
    """With rationals: 1 strictly inside, 0 outside, -1 on the boundary."""
    x, y, odd = Fraction(x), Fraction(y), 0
    for a, b in zip(ring, ring[1:] + ring[:1], strict=True):
        (x1, y1), (x2, y2) = (tuple(map(Fraction, p)) for p in (a, b))
        turn = (x2 - x1) * (y - y1) - (x - x1) * (y2 - y1)
        if turn == 0 and min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2):
            return -1
        odd ^= (y1 <= y < y2 and turn > 0) or (y2 <= y < y1 and turn < 0)
    return int(odd)


def near(ring, rng):
    """Vertices, places on and beside edges, and their neighbours in doubles."""
    out = []
    for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1], strict=True):
        t = rng.choice([0.0, 0.5, rng.random()])
        x, y = x1 + t * (x2 - x1), y1 + t * (y2 - y1)
        out += [(x, y), (math.nextafter(x, 1e9), y), (x, math.nextafter(y, -1e9)), (math.nextafter(x, -1e9), math.nextafter(y, 1e9))]
    return out


def located(spark, ring, points):
    one = spark.createDataFrame([([[list(p) for p in ring]],)], f"rings {geo.RINGS_TYPE}")
    edges = geo.polygon_edges(F.col("rings"))[0]
    asked = spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "i int, x double, y double").repartition(4)
    rows = one.select(edges.alias("edges")).join(asked).select("i", geo.parity(F.col("edges"), F.col("x"), F.col("y")).alias("parity"))
    return [r["parity"] for r in sorted(rows.collect())]


def star(n, rng, cx=-118.1, cy=34.2, size=0.05):
    turns = sorted(rng.random() for _ in range(n))
    arms = [(t * 2 * math.pi, size * rng.uniform(0.5, 1)) for t in turns]
    return [(cx + r * math.cos(a), cy + r * math.sin(a)) for a, r in arms]


@pytest.mark.parametrize("corners", [3, 12, 60])
def test_sides_are_exact_near_edges(spark, corners):
    rng = random.Random(corners)
    ring = star(corners, rng)
    points = near(ring, rng)
    want = [exact_parity(ring, *p) for p in points]
    assert located(spark, ring, points) == want and {0, 1, -1} <= set(want)
