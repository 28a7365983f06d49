"""Queries over geometry: points, lines, polygons and distances, each with SQL for another engine."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import admin, geometry, osm
from . import fixtures as X
from .fixtures import sql

INSIDE = "px >= x0 AND px < x1 AND py >= y0 AND py < y1"
COVER = "x >= x0 AND x <= x1 AND y >= y0 AND y <= y1"
EDGE = f"(({COVER}) AND (x = x0 OR x = x1 OR y = y0 OR y = y1))"


def rounded(df, *cols: str, digits: int = 6):
    return df.withColumns({c: F.round(c, digits) for c in cols})


def points_zones(s, d):
    """Events as points in nation boxes, with ties on shared edges."""
    return geometry.join_points_zones(X.points(s, d), X.zones(s, d))


def points_zones_tilted(s, d):
    hit = geometry.join_points_zones(X.points(s, d), X.zones_tilted(s, d))
    return hit.groupBy("zone_id").agg(F.count(F.lit(1)).alias("covered"), F.count_if("touches").alias("touching"))


def points_mapped(s, d):
    """Events with their tags, of which every third value is null."""
    p = X.points(s, d).select("point_id", "x", "y", "event_type", F.when(F.col("point_id") % 3 != 0, F.col("point_id") % 10).alias("level"))
    return geometry.map_points(p, X.zones(s, d))


def point_stats(s, d):
    """Minimum slice: count and sum of values per zone."""
    p = X.points(s, d)
    return rounded(p.join(geometry.join_points_zones(p, X.zones(s, d)), "point_id").groupBy("zone_id").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"), F.count_if("nearest_boundary_tie").alias("ties")), "total", digits=2)


def measures(s, d):
    return rounded(geometry.measure(X.zones_tilted(s, d)), "area", "length")


def layer_bounds(s, d):
    return geometry.layer_bounds(geometry.segments(X.lines(s, d)))


def interior_points(s, d):
    return rounded(geometry.interior_point(X.zones_tilted(s, d)), "x", "y")


# Clipping of a segment to a box by its entry and exit parameters (Liang-Barsky), with the closed box.
BOX_CLIP = """clip AS (SELECT line_id, zone_id, x1, y1, x2, y2, zx0, zy0, zx1, zy1, sqrt((x2-x1)*(x2-x1)+(y2-y1)*(y2-y1)) AS len,
    greatest(0, CASE WHEN x2 > x1 THEN (zx0-x1)/(x2-x1) WHEN x2 < x1 THEN (zx1-x1)/(x2-x1) WHEN x1 BETWEEN zx0 AND zx1 THEN 0 ELSE 2 END, CASE WHEN y2 > y1 THEN (zy0-y1)/(y2-y1) WHEN y2 < y1 THEN (zy1-y1)/(y2-y1) WHEN y1 BETWEEN zy0 AND zy1 THEN 0 ELSE 2 END) AS t0,
    least(1, CASE WHEN x2 > x1 THEN (zx1-x1)/(x2-x1) WHEN x2 < x1 THEN (zx0-x1)/(x2-x1) WHEN x1 BETWEEN zx0 AND zx1 THEN 1 ELSE -1 END, CASE WHEN y2 > y1 THEN (zy1-y1)/(y2-y1) WHEN y2 < y1 THEN (zy0-y1)/(y2-y1) WHEN y1 BETWEEN zy0 AND zy1 THEN 1 ELSE -1 END) AS t1
    FROM lines, boxes)"""
ZONE_BOXES = "boxes AS (SELECT zone_id, x0::DOUBLE AS zx0, y0::DOUBLE AS zy0, x1::DOUBLE AS zx1, y1::DOUBLE AS zy1 FROM zones)"
CORE_BOX = "boxes AS (SELECT 0 AS zone_id, 100.0::DOUBLE AS zx0, 100.0::DOUBLE AS zy0, 900.0::DOUBLE AS zx1, 900.0::DOUBLE AS zy1)"


def lines_zones(s, d):
    """Length of each order line within each zone; lines along a shared edge belong to both neighbours."""
    return rounded(geometry.overlay_length(X.zones(s, d), X.lines(s, d)), "intersection_length_km", digits=5).filter("intersection_length_km > 0")


def lines_zones_wkt(s, d):
    """Lines within zones with their pieces as text, where a line lies in one piece."""
    out = geometry.overlay_length(X.zones(s, d), X.lines(s, d), keep_geometry=True)
    return out.groupBy("zone_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("intersection_wkt").startswith("LINESTRING (")).alias("single"))


def clipped_points(s, d):
    return geometry.clip_points(X.points(s, d), X.core(s, d))


def clipped_lines(s, d):
    out = geometry.clip_lines(X.lines(s, d), X.core(s, d))
    return rounded(out.groupBy("feature_id").agg(F.sum(F.expr(geometry.LENGTH)).alias("length")), "length", digits=3).filter("length > 0")


def clipped_zones(s, d):
    return rounded(geometry.measure(geometry.clip_polygons(X.zones(s, d), X.core(s, d))).select("feature_id", "area", "xmin", "ymin", "xmax", "ymax"), "area", "xmin", "ymin", "xmax", "ymax")


def zones_units(s, d):
    return rounded(geometry.overlay_area(X.zones(s, d), X.units(s, d)), "intersection_area_km2", "zone_fraction", "unit_fraction", digits=9)


def tilted_overlap_total(s, d):
    """Areas of tilted zones by unit; a partition of the plane by units keeps each zone's inner area."""
    out = geometry.overlay_area(X.zones_tilted(s, d), X.units(s, d)).groupBy("zone_id").agg(F.sum("intersection_area_km2").alias("km2"))
    return rounded(out, "km2", digits=9)


def fraction_totals(s, d):
    from ..operators.gates import fraction_totals as totals

    return rounded(totals(geometry.overlay_area(X.zones(s, d), X.units(s, d)), X.units(s, d).select(F.col("feature_id").alias("unit_id")), "unit_id"), "total", digits=9)


def zones_meeting_core(s, d):
    return geometry.semi_intersects(X.zones(s, d), X.core(s, d))


def points_near_core(s, d):
    return geometry.within_distance(X.points(s, d), X.core(s, d), 25.0)


def dissolved_regions(s, d):
    regions = X.table(s, d, "nation").select(F.col("n_nationkey").cast("long").alias("feature_id"), F.floor(F.col("n_nationkey") / 5).cast("long").alias("group"))
    return rounded(geometry.measure(geometry.dissolve(X.zones(s, d), regions)), "area", "length", "xmin", "ymin", "xmax", "ymax")


def _plots(s, d):
    return geometry.edges_from_rings(X.plots(s, d), "feature_id", "rings")


def _lots(s, d):
    return geometry.edges_from_rings(X.lots(s, d), "feature_id", "rings")


def plot_measures(s, d):
    """Plots with holes and islands, whose rings come in any order and direction."""
    return rounded(geometry.measure(_plots(s, d)), "area", "length")


def plots_lots(s, d):
    return rounded(geometry.overlay_area(_plots(s, d), _lots(s, d)), "intersection_area_km2", "zone_fraction", "unit_fraction", digits=9)


def dissolved_lots(s, d):
    """Rows of overlapping squares of both directions as one feature each."""
    rows = X.lots(s, d).select("feature_id", F.floor(F.col("feature_id") / 32).cast("long").alias("group"))
    return rounded(geometry.measure(geometry.dissolve(_lots(s, d), rows)), "area", "xmin", "ymin", "xmax", "ymax").select("feature_id", "area", "xmin", "ymin", "xmax", "ymax")


def valid_areas(s, d):
    """Areas of boxes and bow-ties, and their overlap with a frame: bow-ties have none."""
    edges = _odd(s, d)
    flags = geometry.flag_invalid_geometry(edges)
    return rounded(geometry.measure(edges, flags).select("feature_id", "area"), "area")


def points_far_and_near(s, d):
    """Points within 100 m and within 10 km of an area, at bins of 100 m."""
    p = X.points(s, d).withColumns({"x": F.col("x") * 100, "y": F.col("y") * 100})
    one = X.table(s, d, "nation").filter("n_nationkey = 0").select(F.lit(0).cast("long").alias("feature_id"))
    area = X.boxes(one, "feature_id", *[F.lit(v) for v in (40_000, 40_000, 60_000, 60_000)])
    near = [geometry.within_distance(p, area, m, 100.0).select(F.lit(m).alias("distance"), "point_id") for m in (100.0, 10_000.0)]
    return near[0].unionByName(near[1])


def gaps_overlaps(s, d):
    return rounded(geometry.gap_overlap(X.zones(s, d).filter("feature_id != 12"), X.core(s, d)), "overlap_percent", "gap_percent")


def area_differences(s, d):
    legal = X.table(s, d, "nation").select(F.col("n_nationkey").cast("long").alias("feature_id"), (F.lit(40000.0) + F.col("n_nationkey") * 100).alias("legal_area"))
    return rounded(geometry.area_difference(X.zones(s, d), legal), "area", "legal_area", "difference_percent")


def _odd(s, d):
    """Boxes and, for every fifth key, bow-ties."""
    k = F.col("feature_id")
    return X.quads(X.table(s, d, "customer").select(F.col("c_custkey").alias("feature_id")), *[(k % 100 * 10 + a, F.floor(k / 100) * 10 + F.when(k % 5 == 0, b).otherwise(c)) for a, b, c in ((0, 0, 0), (5, 5, 0), (5, 0, 5), (0, 5, 5))])


def invalid_geometry(s, d):
    return geometry.flag_invalid_geometry(_odd(s, d)).select("feature_id", "closed", "enough_points", "self_crossing", "valid")


def upstream(s, d):
    core = X.topology(s, d).filter("basin_id % 50 = 7").select("basin_id")
    return admin.select_with_upstream(X.topology(s, d), core, 2)


def parents(s, d):
    """Zones under four parents of 500 m; those whose interior point lies on a shared edge have two."""
    k = F.col("feature_id")
    p = X.table(s, d, "nation").filter("n_nationkey < 4").select(F.col("n_nationkey").cast("long").alias("feature_id"))
    edges = X.boxes(p, "feature_id", 500 * (k % 2), 500 * F.floor(k / 2), 500 * (k % 2) + 500, 500 * F.floor(k / 2) + 500)
    n = F.col("n_nationkey").cast("long")
    child = X.table(s, d, "nation").select(n.alias("basin_id"), F.concat(F.lit("4"), F.floor(n % 5 / 3).cast("string"), n.cast("string")).alias("code"))
    parent = p.select(k.alias("basin_id"), F.concat(F.lit("4"), (k % 2).cast("string")).alias("code"))
    return admin.assign_parents(child, X.zones(s, d), parent, edges)


def exits(s, d):
    return admin.scope_exits(X.topology(s, d).filter("basin_id % 3 != 0"))


def degree_cells(s, d):
    p = X.table(s, d, "part")
    k = F.col("p_partkey")
    box = p.select((k % 7 - 3.5).alias("xmin"), (k % 5 - 2.25).alias("ymin"), (k % 7 - 3.5 + F.col("p_size") % 3).alias("xmax"), (k % 5 - 2.25 + F.col("p_size") % 2 + 0.5).alias("ymax"))
    return osm.cell_ids(box)


def study_areas(s, d):
    basins = X.table(s, d, "nation").select(F.col("n_nationkey").cast("long").alias("basin_id"), F.when(F.col("n_nationkey") < 5, 0).otherwise(F.col("n_nationkey") - 5).cast("long").alias("next_down"))
    one = lambda *c: X.boxes(X.table(s, d, "nation").filter("n_nationkey = 0").select(F.lit(0).cast("long").alias("feature_id")), "feature_id", *map(F.lit, c))
    return admin.study_areas(basins, X.zones(s, d), one(450, 450, 550, 550), one(-10, -10, 390, 1010), 1, 60.0)


def footprints(s, d):
    return rounded(geometry.footprint_ratio((100.0, 100.0, 650.0, 900.0), X.zones(s, d)), "ratio")


def layer_checks(s, d):
    names = X.table(s, d, "nation").select(F.col("n_nationkey").cast("long").alias("feature_id"), "n_name")
    return geometry.validate_layer(names, X.zones_tilted(s, d).filter("feature_id != 7"), ["feature_id", "n_name"], "EPSG:32648", "EPSG:32648")


QUERIES = {
    "map_points": points_mapped, "measure_rings": plot_measures, "overlay_area_rings": plots_lots, "dissolve_rings": dissolved_lots, "measure_valid": valid_areas, "within_distance_levels": points_far_and_near,
    "study_areas": study_areas, "footprint_ratio": footprints, "validate_layer": layer_checks,
    "join_points_zones": points_zones, "join_points_zones_tilted": points_zones_tilted, "point_stats": point_stats, "measure": measures, "layer_bounds": layer_bounds,
    "interior_point": interior_points, "overlay_length": lines_zones, "overlay_length_wkt": lines_zones_wkt, "clip_points": clipped_points, "clip_lines": clipped_lines, "clip_polygons": clipped_zones,
    "overlay_area": zones_units, "overlay_area_tilted": tilted_overlap_total, "fraction_totals": fraction_totals, "semi_intersects": zones_meeting_core, "within_distance": points_near_core, "dissolve": dissolved_regions,
    "gap_overlap": gaps_overlaps, "area_difference": area_differences, "flag_invalid_geometry": invalid_geometry, "select_with_upstream": upstream, "assign_parents": parents, "scope_exits": exits, "cell_ids": degree_cells,
}

TILTED_EDGES = "SELECT zone_id, sum(((ey1 > y) != (ey2 > y) AND x < ex1 + (y - ey1) * (ex2 - ex1) / nullif(ey2 - ey1, 0))::INT) % 2 = 1 AS inside, min(CASE WHEN abs((ex2-ex1)*(y-ey1)-(ey2-ey1)*(x-ex1)) < 1e-9 AND x BETWEEN least(ex1,ex2) AND greatest(ex1,ex2) AND y BETWEEN least(ey1,ey2) AND greatest(ey1,ey2) THEN 0 ELSE 1 END) = 0 AS touches"
CLIPPED = sql("zones lines", "")
RINGS = "(SELECT unnest([0, 2, 5]) AS low, unnest([18, 16, 13]) AS high, unnest([1, -1, 1]) AS sign)"
ORACLE_SQL = {
    "map_points": sql("zones points", f"""SELECT zone_id, point_id, CASE WHEN touches AND k > 1 THEN 'nearest_boundary_tie' WHEN touches THEN 'touches' ELSE 'within' END AS relationship_type,
        '{{"event_type":"' || event_type || '"' || CASE WHEN point_id%3 != 0 THEN ',"level":' || (point_id%10) ELSE '' END || '}}' AS tags_json, touches AS boundary_case, CASE WHEN touches AND k > 1 THEN '{{"boundary_tie":true}}' ELSE '{{}}' END AS quality_flags_json
        FROM (SELECT *, {EDGE} AS touches, count(*) OVER (PARTITION BY point_id) AS k FROM points, zones WHERE {COVER})"""),
    "measure_rings": sql("plots", "SELECT plot_id AS feature_id, 192.0::DOUBLE AS area, 160.0::DOUBLE AS length, x::DOUBLE AS xmin, y::DOUBLE AS ymin, (x+18)::DOUBLE AS xmax, (y+18)::DOUBLE AS ymax FROM plots"),
    "overlay_area_rings": sql("plots lots", f"""SELECT plot_id AS zone_id, lot_id AS unit_id, round(a/1e6, 9) AS intersection_area_km2, round(a/192.0, 9) AS zone_fraction, round(a/1225.0, 9) AS unit_fraction FROM (
        SELECT plot_id, lot_id, sum(sign * greatest(0, least(p.x+high, l.x+35)-greatest(p.x+low, l.x)) * greatest(0, least(p.y+high, l.y+35)-greatest(p.y+low, l.y)))::DOUBLE AS a FROM plots p JOIN lots l ON p.x < l.x+35 AND p.x+18 > l.x AND p.y < l.y+35 AND p.y+18 > l.y, {RINGS} GROUP BY plot_id, lot_id) WHERE a > 0"""),
    "dissolve_rings": sql("lots", "SELECT (lot_id//32)::BIGINT AS feature_id, ((max(x)+35-min(x))*35)::DOUBLE AS area, min(x)::DOUBLE AS xmin, min(y)::DOUBLE AS ymin, (max(x)+35)::DOUBLE AS xmax, (max(y)+35)::DOUBLE AS ymax FROM lots GROUP BY lot_id//32"),
    "measure_valid": "SELECT c_custkey AS feature_id, CASE WHEN c_custkey%5 != 0 THEN 25.0::DOUBLE END AS area FROM customer",
    "within_distance_levels": sql("points", "SELECT m AS distance, point_id FROM points, (SELECT unnest([100.0, 10000.0])::DOUBLE AS m) WHERE power(greatest(40000-100*x, 0, 100*x-60000), 2) + power(greatest(40000-100*y, 0, 100*y-60000), 2) <= m*m"),
    "overlay_length_wkt": sql("zones lines", f", {ZONE_BOXES}, {BOX_CLIP} SELECT zone_id, count(*) AS n, count(*) AS single FROM clip WHERE (t1-t0)*len > 1e-9 GROUP BY zone_id"),
    "join_points_zones": sql("zones points", f"""SELECT point_id, zone_id, NOT {EDGE} AS "within", {EDGE} AS touches, {EDGE} AND count(*) OVER (PARTITION BY point_id) > 1 AS nearest_boundary_tie, {EDGE} AS boundary_case
        FROM points, zones WHERE {COVER}"""),
    "join_points_zones_tilted": sql("tilted points", f"SELECT zone_id, count(*) AS covered, count(*) FILTER (touches) AS touching FROM ({TILTED_EDGES}, point_id FROM points, tilted GROUP BY point_id, zone_id) WHERE inside OR touches GROUP BY zone_id"),
    "point_stats": sql("zones points", f"SELECT zone_id, count(*) AS n, round(sum(value), 2) AS total, count(*) FILTER ({EDGE} AND k > 1) AS ties FROM (SELECT *, count(*) OVER (PARTITION BY point_id) AS k FROM points, zones WHERE {COVER}) GROUP BY zone_id"),
    "measure": sql("tilted", "SELECT zone_id AS feature_id, round(abs(sum(ex1*ey2 - ex2*ey1))/2, 6) AS area, round(sum(sqrt((ex2-ex1)*(ex2-ex1)+(ey2-ey1)*(ey2-ey1))), 6) AS length, min(ex1) AS xmin, min(ey1) AS ymin, max(ex1) AS xmax, max(ey1) AS ymax FROM tilted GROUP BY zone_id"),
    "layer_bounds": sql("lines", "SELECT min(least(x1,x2)) AS xmin, min(least(y1,y2)) AS ymin, max(greatest(x1,x2)) AS xmax, max(greatest(y1,y2)) AS ymax FROM lines"),
    "interior_point": sql("tilted", """, mid AS (SELECT zone_id, (min(ey1)+max(ey1))/2 AS y FROM tilted GROUP BY zone_id),
        cuts AS (SELECT zone_id, y, ex1 + (y-ey1)*(ex2-ex1)/(ey2-ey1) AS x FROM tilted JOIN mid USING (zone_id) WHERE (ey1 > y) != (ey2 > y))
        SELECT zone_id AS feature_id, round((min(x)+max(x))/2, 6) AS x, round(max(y), 6) AS y FROM cuts GROUP BY zone_id"""),
    "overlay_length": sql("zones lines", f""", {ZONE_BOXES}, {BOX_CLIP} SELECT line_id, zone_id, round((t1-t0)*len/1000, 5) AS intersection_length_km,
        (x1 = x2 AND (x1 = zx0 OR x1 = zx1)) OR (y1 = y2 AND (y1 = zy0 OR y1 = zy1)) AS boundary_case FROM clip WHERE t1 > t0 AND round((t1-t0)*len/1000, 5) > 0"""),
    "clip_points": sql("points", "SELECT point_id, x, y, event_type, value FROM points WHERE x BETWEEN 100 AND 900 AND y BETWEEN 100 AND 900"),
    "clip_lines": sql("lines", f", {CORE_BOX}, {BOX_CLIP} SELECT line_id AS feature_id, round((t1-t0)*len, 3) AS length FROM clip WHERE t1 > t0 AND round((t1-t0)*len, 3) > 0"),
    "clip_polygons": sql("zones", "SELECT zone_id AS feature_id, round((cx1-cx0)*(cy1-cy0)::DOUBLE, 6) AS area, cx0 AS xmin, cy0 AS ymin, cx1 AS xmax, cy1 AS ymax FROM (SELECT zone_id, greatest(x0,100)::DOUBLE AS cx0, greatest(y0,100)::DOUBLE AS cy0, least(x1,900)::DOUBLE AS cx1, least(y1,900)::DOUBLE AS cy1 FROM zones)"),
    "overlay_area": sql("zones units", "SELECT zone_id, unit_id, round(a/1e6, 9) AS intersection_area_km2, round(a/40000.0::DOUBLE, 9) AS zone_fraction, round(a/62500.0::DOUBLE, 9) AS unit_fraction FROM (SELECT zone_id, unit_id, (greatest(0, least(z.x1,u.x1)-greatest(z.x0,u.x0))*greatest(0, least(z.y1,u.y1)-greatest(z.y0,u.y0)))::DOUBLE AS a FROM zones z, units u) WHERE a > 0"),
    "overlay_area_tilted": sql("tilted", "SELECT zone_id, round((abs(sum(ex1*ey2 - ex2*ey1))/2 - (CASE WHEN zone_id >= 20 THEN 100*(7+zone_id//5) ELSE 0 END))/1e6, 9) AS km2 FROM tilted GROUP BY zone_id"),
    "fraction_totals": sql("units", "SELECT unit_id, 1.0::DOUBLE AS total FROM units"),
    "semi_intersects": sql("zones", "SELECT zone_id AS feature_id FROM zones WHERE x0 <= 900 AND x1 >= 100 AND y0 <= 900 AND y1 >= 100"),
    "within_distance": sql("points", "SELECT point_id FROM points WHERE power(greatest(100-x, 0, x-900), 2) + power(greatest(100-y, 0, y-900), 2) <= 625"),
    "dissolve": "SELECT (n_nationkey//5)::BIGINT AS feature_id, 200000.0::DOUBLE AS area, 2400.0::DOUBLE AS length, 0.0::DOUBLE AS xmin, (200*(n_nationkey//5))::DOUBLE AS ymin, 1000.0::DOUBLE AS xmax, (200*(n_nationkey//5)+200)::DOUBLE AS ymax FROM nation GROUP BY n_nationkey//5",
    "gap_overlap": "SELECT 0.0::DOUBLE AS overlap_percent, round(100*40000/640000.0::DOUBLE, 6) AS gap_percent FROM region WHERE r_regionkey = 0",
    "area_difference": "SELECT n_nationkey::BIGINT AS feature_id, 40000.0::DOUBLE AS area, (40000 + n_nationkey*100)::DOUBLE AS legal_area, round(100*n_nationkey*100/(40000 + n_nationkey*100)::DOUBLE, 6) AS difference_percent, 100*n_nationkey*100/(40000 + n_nationkey*100)::DOUBLE > 2 AS exceeds FROM nation",
    "flag_invalid_geometry": "SELECT c_custkey AS feature_id, true AS closed, true AS enough_points, c_custkey%5 = 0 AS self_crossing, c_custkey%5 != 0 AS valid FROM customer",
    "select_with_upstream": sql("topology", ", c0 AS (SELECT basin_id FROM topology WHERE basin_id%50 = 7), c1 AS (SELECT t.basin_id FROM topology t JOIN c0 ON t.next_down = c0.basin_id), c2 AS (SELECT t.basin_id FROM topology t JOIN c1 ON t.next_down = c1.basin_id) SELECT basin_id, min(hop)::INT AS hop FROM (SELECT basin_id, 0 AS hop FROM c0 UNION ALL SELECT basin_id, 1 FROM c1 UNION ALL SELECT basin_id, 2 FROM c2) GROUP BY basin_id"),
    "assign_parents": """SELECT n_nationkey::BIGINT AS basin_id, CASE WHEN n = 1 THEN (px//500 + 2*(py//500))::BIGINT END AS parent_id, n AS covering, ('4' || (n_nationkey%5//3) || n_nationkey) LIKE '4' || CASE WHEN px = 500 THEN 0 ELSE (px//500) END || '%' AS code_ok
        FROM (SELECT *, ((CASE WHEN px = 500 THEN 2 ELSE 1 END)*(CASE WHEN py = 500 THEN 2 ELSE 1 END))::BIGINT AS n FROM (SELECT *, 200*(n_nationkey%5)+100 AS px, 200*(n_nationkey//5)+100 AS py FROM nation))""",
    "scope_exits": sql("topology", "SELECT t.basin_id, t.next_down, t.next_down != 0 AND d.basin_id IS NULL AS scope_exit FROM topology t LEFT JOIN topology d ON d.basin_id = t.next_down AND d.basin_id%3 != 0 WHERE t.basin_id%3 != 0"),
    "cell_ids": """SELECT DISTINCT (CASE WHEN lat >= 0 THEN 'N' ELSE 'S' END) || lpad(abs(lat)::VARCHAR, 2, '0') || '_' || (CASE WHEN lon >= 0 THEN 'E' ELSE 'W' END) || lpad(abs(lon)::VARCHAR, 3, '0') AS cell_id
        FROM (SELECT lat, unnest(range(floor(x0)::BIGINT, ceil(x1)::BIGINT)) AS lon FROM (SELECT x0, x1, unnest(range(floor(y0)::BIGINT, ceil(y1)::BIGINT)) AS lat FROM (SELECT p_partkey%7-3.5 AS x0, p_partkey%5-2.25 AS y0, p_partkey%7-3.5+p_size%3 AS x1, p_partkey%5-2.25+p_size%2+0.5 AS y1 FROM part)))""",
    "study_areas": sql("zones", """, z AS (SELECT *, x0 <= 550 AND x1 >= 450 AND y0 <= 550 AND y1 >= 450 AS meets, power(greatest(450-x1, 0, x0-550), 2) + power(greatest(450-y1, 0, y0-550), 2) <= 3600 AS near, x0 <= 390 AS inside FROM zones)
        SELECT 'core' AS area, zone_id AS basin_id FROM z WHERE meets UNION ALL SELECT 'environmental', zone_id FROM z WHERE near UNION ALL SELECT 'exposure', zone_id FROM z WHERE near AND inside
        UNION ALL SELECT DISTINCT 'hydrological', b.zone_id FROM z a JOIN z b ON b.zone_id = a.zone_id OR b.zone_id - 5 = a.zone_id WHERE a.meets"""),
    "footprint_ratio": sql("zones", "SELECT zone_id AS feature_id, round(greatest(0, least(x1, 650)-greatest(x0, 100))*greatest(0, least(y1, 900)-greatest(y0, 100))/40000.0::DOUBLE, 6) AS ratio FROM zones"),
    "validate_layer": "SELECT count(*) > 0 AS non_empty, true AS columns_ok, true AS crs_ok, false AS geometry_present, true AS geometry_valid, false AS passed FROM nation",
}
