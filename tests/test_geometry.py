import math
import random

import pytest
from pyspark.sql import functions as F

from tributary.functions import crs
from tributary.operators import geometry as G
from tributary.plans.fixtures import boxes


def box_layer(spark, rows):
    df = spark.createDataFrame(rows, "id long, x0 double, y0 double, x1 double, y1 double")
    return boxes(df, "id", *[F.col(c) for c in ("x0", "y0", "x1", "y1")])


def ring_layer(spark, rows):
    df = spark.createDataFrame([(i, [[{"x": float(x), "y": float(y)} for x, y in ring] for ring in rings]) for i, rings in rows], "id long, rings array<array<struct<x: double, y: double>>>")
    return G.edges_from_rings(df, "id", "rings")


def line_layer(spark, rows):
    return spark.createDataFrame(rows, "feature_id long, part int, seq int, x1 double, y1 double, x2 double, y2 double")


HOLED = [[(0, 0), (10, 0), (10, 10), (0, 10)], [(3, 3), (3, 7), (7, 7), (7, 3)]]


def test_area_fractions(spark):
    zones = box_layer(spark, [(1, 0.0, 0.0, 50.0, 100.0), (2, 50.0, 0.0, 100.0, 100.0)])
    unit = box_layer(spark, [(9, 0.0, 0.0, 100.0, 100.0)])
    got = {r.zone_id: r for r in G.overlay_area(zones, unit).collect()}
    assert got[1].intersection_area_km2 == pytest.approx(0.005) and got[1].zone_fraction == pytest.approx(1.0) and got[1].unit_fraction == pytest.approx(0.5)


def test_line_through_box(spark):
    unit = box_layer(spark, [(1, 0.0, 0.0, 100.0, 100.0)])
    got = G.overlay_length(unit, line_layer(spark, [(7, 0, 0, -20.0, 50.0, 120.0, 50.0)]), keep_geometry=True).collect()
    assert len(got) == 1 and got[0].intersection_length_km == pytest.approx(0.1) and got[0].intersection_wkt == "LINESTRING (0 50, 100 50)" and not got[0].boundary_case


def test_line_along_a_shared_edge_belongs_to_both(spark):
    zones = box_layer(spark, [(1, 0.0, 0.0, 10.0, 10.0), (2, 10.0, 0.0, 20.0, 10.0)])
    got = {r.zone_id: (round(r.intersection_length_km * 1000, 6), r.boundary_case) for r in G.overlay_length(zones, line_layer(spark, [(7, 0, 0, 10.0, -5.0, 10.0, 8.0)])).collect()}
    assert got == {1: (8.0, True), 2: (8.0, True)}


def test_column_named_like_an_output(spark):
    unit = box_layer(spark, [(1, 0.0, 0.0, 1.0, 1.0)])
    with pytest.raises(ValueError):
        G.overlay_length(unit, line_layer(spark, [(7, 0, 0, 0.0, 0.0, 1.0, 1.0)]), spark.createDataFrame([(7, 1)], "feature_id long, zone_id int"))


def test_point_on_shared_edge(spark):
    zones = box_layer(spark, [(1, 0.0, 0.0, 10.0, 10.0), (2, 10.0, 0.0, 20.0, 10.0)])
    got = G.join_points_zones(spark.createDataFrame([("p", 10.0, 5.0), ("q", 5.0, 5.0), ("r", 50.0, 5.0)], "point_id string, x double, y double"), zones).collect()
    assert {(r.point_id, r.zone_id, r.nearest_boundary_tie, r.within) for r in got} == {("p", 1, True, False), ("p", 2, True, False), ("q", 1, False, True)}


def test_hole(spark):
    layer = ring_layer(spark, [(1, HOLED)])
    pts = spark.createDataFrame([(1, 5.0, 5.0), (2, 1.0, 5.0), (3, 3.0, 5.0)], "point_id long, x double, y double")
    assert {(r.point_id, r.touches) for r in G.join_points_zones(pts, layer).collect()} == {(2, False), (3, True)}
    assert G.measure(layer).first().area == pytest.approx(84.0)
    cut = G.overlay_area(layer, box_layer(spark, [(5, 0.0, 0.0, 5.0, 10.0)])).first()
    assert cut.intersection_area_km2 * 1e6 == pytest.approx(50 - 8)


@pytest.mark.parametrize("cell", [0.7, 3.0, 1000.0])
def test_result_does_not_depend_on_bins(spark, cell):
    star = ring_layer(spark, [(1, [[(0, 0), (4, 1), (9, 0), (6, 4), (8, 9), (4, 6), (0, 8), (2, 4)]])])
    other = ring_layer(spark, [(2, [[(1, 1), (7, 2), (5, 8)]])])
    a, b = (G.overlay_area(*p, cell=cell).first().intersection_area_km2 for p in ((star, other), (other, star)))
    assert a == pytest.approx(b) and a * 1e6 == pytest.approx(G.overlay_area(star, other, cell=2.0).first().intersection_area_km2 * 1e6)
    inside = sum(1 for i in range(200) for j in range(200) if _in(star_points(), (i + .5) / 20, (j + .5) / 20) and _in([(1, 1), (7, 2), (5, 8)], (i + .5) / 20, (j + .5) / 20)) / 400
    assert a * 1e6 == pytest.approx(inside, abs=0.15)


def star_points():
    return [(0, 0), (4, 1), (9, 0), (6, 4), (8, 9), (4, 6), (0, 8), (2, 4)]


def _in(ring, px, py):
    odd = False
    for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1], strict=True):
        if (y1 > py) != (y2 > py) and px < x1 + (py - y1) * (x2 - x1) / (y2 - y1):
            odd = not odd
    return odd


def test_t_junction_dissolves(spark):
    layer = box_layer(spark, [(1, 0.0, 0.0, 10.0, 4.0), (2, 0.0, 4.0, 5.0, 8.0), (3, 5.0, 4.0, 10.0, 8.0)])
    one = G.measure(G.dissolve(layer)).first()
    assert one.area == pytest.approx(80.0) and one.length == pytest.approx(36.0)


def test_identical_and_disjoint_boxes(spark):
    layer = box_layer(spark, [(1, 0.0, 0.0, 2.0, 2.0), (2, 0.0, 0.0, 2.0, 2.0), (3, 5.0, 5.0, 6.0, 6.0)])
    got = {(r.zone_id, r.unit_id): r.zone_fraction for r in G.overlay_area(layer, layer).collect()}
    assert got == {(a, b): pytest.approx(1.0) for a, b in [(1, 1), (1, 2), (2, 1), (2, 2), (3, 3)]}


def test_interior_point_lies_inside(spark):
    layer = ring_layer(spark, [(1, HOLED), (2, [star_points()])])
    spots = G.interior_point(layer).withColumnRenamed("feature_id", "point_id")
    got = {(r.point_id, r.zone_id) for r in G.join_points_zones(spots, layer).filter("within").collect()}
    assert {(1, 1), (2, 2)} <= got


def test_bow_tie_is_flagged(spark):
    layer = ring_layer(spark, [(1, [[(0, 0), (2, 2), (2, 0), (0, 2)]]), (2, HOLED)])
    assert {r.feature_id: r.valid for r in G.flag_invalid_geometry(layer).collect()} == {1: False, 2: True}


def test_within_distance(spark):
    area = box_layer(spark, [(1, 0.0, 0.0, 10.0, 10.0)])
    pts = spark.createDataFrame([(1, 5.0, 5.0), (2, 13.0, 14.0), (3, 13.1, 14.0), (4, -5.0, 5.0)], "point_id long, x double, y double")
    assert {r.point_id for r in G.within_distance(pts, area, 5.0).collect()} == {1, 2, 4}


def test_no_nested_loop(spark):
    layer = box_layer(spark, [(1, 0.0, 0.0, 2.0, 2.0)])
    for df in (G.overlay_area(layer, layer), G.overlay_length(layer, line_layer(spark, [(1, 0, 0, 0.0, 0.0, 1.0, 1.0)])), G.join_points_zones(spark.createDataFrame([(1, 1.0, 1.0)], "point_id long, x double, y double"), layer)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_utm(spark):
    e2 = 2 / 298.257223563 - (1 / 298.257223563) ** 2
    n = 200_000
    step = math.radians(21) / n
    arc = sum(6378137 * (1 - e2) / (1 - e2 * math.sin((i + 0.5) * step) ** 2) ** 1.5 for i in range(n)) * step
    df = spark.createDataFrame([(105.0, 21.0), (103.5, 20.25)], "lon double, lat double")
    e, north = crs.geographic_to_utm(F.col("lon"), F.col("lat"))
    df = df.withColumns({"e": e, "n": north})
    lon, lat = crs.utm_to_geographic(F.col("e"), F.col("n"))
    rows = df.select("lon", "lat", "e", "n", lon.alias("lon2"), lat.alias("lat2")).collect()
    assert rows[0].e == pytest.approx(500000, abs=1e-6) and rows[0].n == pytest.approx(0.9996 * arc, abs=1e-3)
    for r in rows:
        assert r.lon == pytest.approx(r.lon2, abs=1e-11) and r.lat == pytest.approx(r.lat2, abs=1e-11)


def test_union_of_overlapping_features(spark):
    """Three boxes that overlap all at once, one inside another, one apart, and a copy of one."""
    layer = box_layer(spark, [(1, 0.0, 0.0, 10.0, 10.0), (2, 5.0, 5.0, 15.0, 15.0), (3, 4.0, 4.0, 12.0, 12.0), (4, 6.0, 6.0, 7.0, 7.0), (5, 100.0, 0.0, 110.0, 10.0), (6, 0.0, 0.0, 10.0, 10.0), (7, 110.0, 0.0, 120.0, 10.0)])
    cells = {(x, y) for x0, y0, x1, y1 in ((0, 0, 10, 10), (5, 5, 15, 15), (4, 4, 12, 12)) for x in range(x0, x1) for y in range(y0, y1)}
    one = G.measure(G.dissolve(layer, cell=7.0)).first()
    assert one.area == pytest.approx(len(cells) + 200)
    frame = box_layer(spark, [(1, 0.0, 0.0, 20.0, 20.0)])
    total = 100 + 100 + 64 + 1 + 100 + 100 + 100
    got = G.gap_overlap(layer, frame, cell=3.0).first()
    assert got.overlap_percent == pytest.approx((total - len(cells) - 200) / 4) and got.gap_percent == pytest.approx((400 - len(cells)) / 4)
    by = spark.createDataFrame([(1, 8), (2, 9), (5, 8), (7, 8)], "feature_id long, group long")
    areas = {r.feature_id: r.area for r in G.measure(G.dissolve(layer, by)).collect()}
    assert areas[8] == pytest.approx(300) and areas[9] == pytest.approx(100)


def test_overlays_do_not_depend_on_the_cell(spark):
    zones = ring_layer(spark, [(1, HOLED), (2, [[(10, 0), (30, 5), (25, 30), (8, 22)]])])
    lines = line_layer(spark, [(i, 0, 0, -5.0 + i, -3.0, 30.0 - 2 * i, 28.0) for i in range(12)] + [(50, 0, 0, 4.0, 4.0, 6.0, 6.0), (51, 0, 0, 1.0, 1.0, 2.0, 2.0), (52, 0, 0, 0.0, 0.0, 10.0, 0.0)])
    want = None
    for cell in (0.7, 3.0, 100.0):
        got = {(r.line_id, r.zone_id): (round(r.intersection_length_km, 9), r.boundary_case) for r in G.overlay_length(zones, lines, cell=cell).collect()}
        want = want or got
        assert got == want
    assert (50, 1) not in want and want[(51, 1)] == (round(math.sqrt(2) / 1000, 9), False) and want[(52, 1)] == (0.01, True)


NESTED = [  # a shell with a hole, an island in the hole with a hole of its own, and a second polygon
    [(0, 0), (10, 0), (10, 10), (0, 10)], [(1, 1), (1, 9), (9, 9), (9, 1)], [(2, 2), (8, 2), (8, 8), (2, 8)], [(4, 4), (4, 6), (6, 6), (6, 4)], [(20, 0), (24, 0), (24, 4), (20, 4)],
]


def rings_turned(n):
    """NESTED in another order, each ring in a direction of its own."""
    order = [(i * 2 + n) % 5 for i in range(5)]
    return [NESTED[i][:: -1 if (n >> k) & 1 else 1] for k, i in enumerate(order)]


def test_rings_of_any_direction(spark):
    layer = ring_layer(spark, [(n, rings_turned(n)) for n in range(16)])
    want = 100 - 64 + 36 - 4 + 16
    assert {r.feature_id: r.area for r in G.measure(layer).collect()} == {n: pytest.approx(want) for n in range(16)}
    signed = layer.groupBy("feature_id", "part", "ring").agg(F.sum(F.expr("x1 * y2 - x2 * y1")).alias("s"), F.min("x1").alias("x")).collect()
    assert {(r.feature_id, r.part, r.ring > 0) for r in signed if r.s > 0} == {(n, p, False) for n in range(16) for p in range(3)}
    assert all((r.ring == 0) == (r.s > 0) for r in signed) and len(signed) == 16 * 5
    whole = box_layer(spark, [(99, 0.0, 0.0, 5.0, 5.0)])
    cut = {r.zone_id: round(r.intersection_area_km2 * 1e6, 6) for r in G.overlay_area(layer, whole, cell=3.0).collect()}
    assert cut == {n: 25 - 16 + 9 - 1 for n in range(16)}
    seqs = layer.filter("feature_id = 5").orderBy("part", "ring", "seq").collect()
    for a, b in zip(seqs, seqs[1:], strict=False):
        assert (a.part, a.ring) != (b.part, b.ring) or (a.x2, a.y2) == (b.x1, b.y1)


def test_clockwise_squares(spark):
    square = lambda x, turn: [(x, 0), (x + 100, 0), (x + 100, 100), (x, 100)][::turn]
    a, b = ring_layer(spark, [(1, [square(0, -1)])]), ring_layer(spark, [(2, [square(0, 1)]), (3, [square(50, 1)]), (4, [square(75, -1)])])
    assert {r.unit_id: round(r.intersection_area_km2 * 1e6) for r in G.overlay_area(a, b).collect()} == {2: 10_000, 3: 5_000, 4: 2_500}
    both = ring_layer(spark, [(1, [square(0, -1)]), (2, [square(50, 1)])])
    assert G.measure(G.dissolve(both)).first().area == pytest.approx(15_000)
    hole = ring_layer(spark, [(1, [square(0, 1), [(10, 10), (30, 10), (30, 30), (10, 30)]])])
    assert G.measure(hole).first().area == pytest.approx(9_600)


def test_lines_stay_open(spark):
    df = spark.createDataFrame([(1, [[{"x": 0.0, "y": 0.0}, {"x": 60.0, "y": 80.0}], [{"x": 0.0, "y": 5.0}, {"x": 0.0, "y": 5.0}, {"x": 7.0, "y": 5.0}]])], "id long, parts array<array<struct<x: double, y: double>>>")
    segments = G.edges_from_lines(df, "id", "parts")
    assert {(r.part, r.seq, r.x2) for r in segments.collect()} == {(0, 0, 60.0), (1, 0, 7.0)}
    assert G.overlay_length(box_layer(spark, [(1, -1.0, -1.0, 100.0, 100.0)]), segments).first().intersection_length_km == pytest.approx(0.107)


SHAPES = [
    ("fine", HOLED, [0, 0], None), ("touching hole", [[(0, 0), (10, 0), (10, 10), (0, 10)], [(0, 5), (4, 7), (4, 3)]], [0, 0], None),
    ("bow-tie", [[(0, 0), (2, 2), (2, 0), (0, 2)]], [0], "self_crossing"), ("ring touches itself", [[(0, 0), (4, 0), (2, 2), (4, 4), (0, 4), (2, 2)]], [0], "self_crossing"),
    ("vertex on an edge", [[(0, 0), (4, 0), (4, 4), (2, 0), (0, 4)]], [0], "self_crossing"), ("spike", [[(0, 0), (4, 0), (8, 0), (4, 0), (4, 4), (0, 4)]], [0], "self_crossing"),
    ("rings along each other", [[(0, 0), (10, 0), (10, 10), (0, 10)], [(0, 2), (0, 6), (4, 6), (4, 2)]], [0, 0], "self_crossing"), ("rings cross", [[(0, 0), (10, 0), (10, 10), (0, 10)], [(5, 5), (15, 5), (15, 8), (5, 8)]], [0, 0], "self_crossing"),
    ("hole outside", [[(0, 0), (10, 0), (10, 10), (0, 10)], [(20, 0), (24, 0), (24, 4), (20, 4)]], [0, 0], "nested"), ("shell in a shell", [[(0, 0), (10, 0), (10, 10), (0, 10)], [(2, 2), (4, 2), (4, 4), (2, 4)]], [0, 1], "nested"),
    ("open", [[(0, 0), (10, 0), (10, 10), (0, 10)]], [0], "closed"), ("two points", [[(0, 0), (10, 0), (0, 0)]], [0], "enough_points"),
]


def test_validity(spark):
    """One red case of each kind; invalid features have no area and leave the layer."""
    rows = []
    for k, (name, rings, shells, _) in enumerate(SHAPES):
        closed = [r if name == "open" or r[0] == r[-1] else [*r, r[0]] for r in rings]
        rows.append((k, [[{"x": float(x), "y": float(y)} for x, y in r] for r in closed], shells))
    df = spark.createDataFrame(rows, "id long, rings array<array<struct<x: double, y: double>>>, shells array<int>")
    edges = G.edges_from_rings(df, "id", "rings", "shells", evidence=True)
    flags = G.flag_invalid_geometry(edges, cell=3.0).cache()
    got = {r.feature_id: r for r in flags.collect()}
    areas = {r.feature_id: r.area for r in G.measure(edges, flags).collect()}
    stay = {r.feature_id for r in G.valid_features(edges, flags).select("feature_id").distinct().collect()}
    for k, (name, _, _, flag) in enumerate(SHAPES):
        assert got[k].valid == (flag is None) and (flag is None or got[k][flag] == (flag == "self_crossing")), name
        assert (areas[k] is None) == (flag is not None) and (k in stay) == (flag is None), name


@pytest.mark.parametrize(("distance", "cell"), [(10_000.0, 100.0), (10_000.0, 3.0), (90.0, 100.0), (3000.0, 1e5)])
def test_distance_join_by_levels(spark, distance, cell):
    rng = random.Random(3)
    area = ring_layer(spark, [(1, [[(0, 0), (40_000, 3_000), (25_000, 9_000), (30_000, 30_000), (2_000, 12_000)]])])
    ring = [(0, 0), (40_000, 3_000), (25_000, 9_000), (30_000, 30_000), (2_000, 12_000)]
    pts = [(i, rng.uniform(-30_000, 70_000), rng.uniform(-30_000, 60_000)) for i in range(400)]

    def far(x, y):
        def one(a, b):
            t = max(0, min(1, ((x - a[0]) * (b[0] - a[0]) + (y - a[1]) * (b[1] - a[1])) / ((b[0] - a[0]) ** 2 + (b[1] - a[1]) ** 2)))
            return math.hypot(x - a[0] - t * (b[0] - a[0]), y - a[1] - t * (b[1] - a[1]))
        return 0 if _in(ring, x, y) else min(one(a, b) for a, b in zip(ring, ring[1:] + ring[:1], strict=True))

    got = {r.point_id for r in G.within_distance(spark.createDataFrame(pts, "point_id long, x double, y double"), area, distance, max(cell, 100.0)).collect()}
    assert got == {i for i, x, y in pts if far(x, y) <= distance}
    if cell >= 100:
        short = spark.createDataFrame([(1.0, 1.0, 5.0, 5.0)], "x1 double, y1 double, x2 double, y2 double")
        wide = cell * 2.0 ** max(0, math.ceil(math.log2(distance / cell)))
        assert G.walked(short, wide, pad=distance).count() <= 9
