"""Queries over pixels: zonal statistics, terrain, soil, population, rivers and raster operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import crs
from ..operators import gates, raster, zonal
from . import fixtures as X
from .fixtures import sql
from .spatial import BOX_CLIP, INSIDE, ZONE_BOXES, rounded

GRID = X.grid()
TIED = X.grid(tied=True)
PROPERTIES = ["clay", "sand", "silt", "bdod", "cfvo", "wv0010", "wv0033", "wv1500"]
DEPTHS = ["0-5cm", "5-15cm", "15-30cm", "30-60cm", "60-100cm", "100-200cm"]
STATISTICS = ["mean", "uncertainty"]
LIMITS = [(0, 5), (5, 15), (15, 30), (30, 60), (60, 100), (100, 200)]
CUBE_SIDE = 20


def pixels_zones(s, d):
    return raster.join_pixels_zones(X.pixels(s, d), X.zones(s, d), TIED).groupBy("raster_id", "zone_id").agg(F.count(F.lit(1)).alias("n"), F.sum("row").alias("rows"), F.sum("col").alias("cols"))


def zonal_statistics(s, d):
    return rounded(zonal.zonal_stats(X.pixels(s, d), X.zones(s, d), GRID, ("mean", "min", "max", "p90", "sum"), by=("raster_id",)), "mean", "p90")


def landcover(s, d):
    out = zonal.landcover_fractions(X.pixels(s, d), X.zones(s, d), GRID, X.CLASSES, by=("raster_id",))
    return rounded(out, *[f"{n}_fraction" for n in X.CLASSES.values()])


def class_names(s, d):
    named = zonal.class_names(X.pixels(s, d).select("raster_id", "row", "col", F.col("class")), X.CLASSES)
    return named.groupBy("class", "class_name").agg(F.count(F.lit(1)).alias("n"))


def centers(s, d):
    return raster.pixel_centers(X.pixels(s, d).select("raster_id", "row", "col"), GRID)


def assigned(s, d):
    out = raster.assign_pixels(X.pixels(s, d), X.zones(s, d), X.core(s, d), TIED)
    return out.groupBy("raster_id", "zone_id").agg(F.count(F.lit(1)).alias("n"), F.count_if("tie").alias("ties"), F.sum("population").alias("people"))


def population(s, d):
    return rounded(zonal.population_by_zone(X.pixels(s, d), X.zones(s, d), X.core(s, d), TIED, by=("raster_id",)), "population_mean", "coverage")


def slopes(s, d):
    out = zonal.slope(X.pixels(s, d), X.zones(s, d), GRID)
    return rounded(out.filter("inside AND slope IS NOT NULL").groupBy("raster_id", "zone_id").agg(F.count(F.lit(1)).alias("n"), F.avg("slope").alias("mean_slope"), F.max("slope").alias("max_slope")), "mean_slope", "max_slope", digits=5)


def terrain(s, d):
    out = zonal.terrain_features(X.pixels(s, d), X.zones(s, d), GRID)
    return rounded(out, "elevation_mean_m", "slope_mean_deg", "slope_p90_deg", "slope_max_deg", "valid_fraction", digits=5)


def soil_pixels(s, d):
    """Orders as pixels of the cube: every order is one cell of one of 96 layers."""
    o = F.col("o_orderkey")
    layer = o % 96
    depth = layer % 6
    cell = F.floor(o / 96) % (CUBE_SIDE * CUBE_SIDE)
    pick = lambda values, at: F.element_at(F.array(*[F.lit(v) for v in values]), (at + 1).cast("int"))
    return X.table(s, d, "orders").select(
        F.floor(o / (96 * CUBE_SIDE * CUBE_SIDE)).alias("raster_id"), F.floor(cell / CUBE_SIDE).cast("int").alias("row"), (cell % CUBE_SIDE).cast("int").alias("col"),
        pick(PROPERTIES, F.floor(layer / 12)).alias("property"), pick(DEPTHS, depth).alias("depth"), pick(STATISTICS, F.floor(layer / 6) % 2).alias("statistic"),
        pick([a for a, _ in LIMITS], depth).alias("top"), pick([b for _, b in LIMITS], depth).alias("bottom"),
        ((o * 13 + F.col("o_custkey") * 5) % 400).cast("double").alias("value"), (o % 97 != 0).alias("valid"))


SOIL_GRID = {"a": 50.0, "b": 0.0, "c": 0.0, "d": 0.0, "e": -50.0, "f": 1000.0}


def soil(s, d):
    out = zonal.soil_depth_weighted(soil_pixels(s, d), X.zones(s, d), SOIL_GRID)
    return rounded(out.withColumn("value", F.col("value") + 1e-7), "value", "valid_fraction", digits=3)  # off the halves, which engines round by their last bits


def soil_checks(s, d):
    """The 96 layers judged one by one: one layer is missing, one is known for a third of its pixels only."""
    p = soil_pixels(s, d).filter("NOT (property = 'clay' AND depth = '0-5cm' AND statistic = 'mean')")
    gap = F.expr("property = 'sand' AND depth = '5-15cm' AND statistic = 'mean' AND col % 3 > 0")
    return gates.soil_layers(p.withColumn("valid", ~gap), X.core(s, d), SOIL_GRID, (PROPERTIES, DEPTHS, STATISTICS)).select("check_id", "passed", "severity", "expected", "actual")


def soil_wide(s, d):
    out = zonal.soil_wide(zonal.soil_depth_weighted(soil_pixels(s, d), X.zones(s, d), SOIL_GRID), PROPERTIES, STATISTICS)
    return out.select("zone_id", F.lit(len(out.columns)).alias("columns"), *[F.round(F.col(f"{p}_mean_0_30cm_value") + 1e-7, 3).alias(p) for p in PROPERTIES])


def cube_gaps(s, d):
    return zonal.check_cube(soil_pixels(s, d).filter("depth != '5-15cm'"), PROPERTIES, DEPTHS, STATISTICS)


def drained(s, d):
    return rounded(zonal.drainage(X.zones(s, d), X.lines(s, d)), "river_length_km", "drainage_density", digits=4)


OFF = {"a": 10.0, "b": 0.0, "c": -3.137, "d": 0.0, "e": -10.0, "f": 1003.137}  # no zone edge lies on a pixel's edge


def gradients(s, d):
    return rounded(zonal.stream_gradient(X.zones(s, d), X.lines(s, d), raster.mosaic(X.pixels(s, d)), OFF), "stream_gradient", digits=4)


def sampled(s, d):
    return zonal.sample_at(X.points(s, d).select("point_id", "x", "y"), raster.mosaic(X.pixels(s, d)), GRID).select("point_id", "sampled")


def coverage(s, d):
    return rounded(zonal.coverage_ratio(X.pixels(s, d), X.core(s, d), GRID), "coverage")


def class_counts(s, d):
    return zonal.class_pixel_counts(X.pixels(s, d), X.core(s, d), GRID)


def vocabulary(s, d):
    return zonal.check_vocabulary(X.pixels(s, d), [c for c in X.CLASSES if c < 90])


def stretched(s, d):
    out = zonal.percentile_stretch(X.pixels(s, d), side=50)
    return out.groupBy("raster_id").agg(F.count(F.lit(1)).alias("n"), F.sum("shade").alias("shades"), F.max("shade").alias("top"))


def clipped(s, d):
    out, g = raster.clip_pixels(X.pixels(s, d).select("raster_id", "row", "col", "value", "valid"), X.core(s, d), GRID)
    return out.groupBy("raster_id").agg(F.count(F.lit(1)).alias("n"), F.count_if("valid").alias("valid"), F.max("row").alias("last_row"), F.sum("value").alias("total"), F.lit(g["c"]).alias("c"), F.lit(g["f"]).alias("f"))


def mosaicked(s, d):
    return raster.mosaic(X.pixels(s, d))


def mosaic_clipped(s, d):
    out, _ = raster.mosaic_clip(X.pixels(s, d), X.core(s, d), GRID)
    return out.agg(F.count(F.lit(1)).alias("n"), F.count_if("valid").alias("valid"), F.sum(F.when(F.col("valid"), F.col("value"))).alias("total"))


COARSE = {"a": 25.0, "b": 0.0, "c": 3.0, "d": 0.0, "e": -25.0, "f": 998.0}


def _shape(s, d):
    o = X.pixels(s, d).filter("row < 40 AND col < 40")
    return o.select("raster_id", "row", "col")


def nearest(s, d):
    return raster.resample_nearest(X.pixels(s, d).select("raster_id", "row", "col", F.col("class"), "valid"), GRID, _shape(s, d), COARSE)


def bilinear(s, d):
    return rounded(raster.resample_bilinear(X.pixels(s, d), GRID, _shape(s, d), COARSE), "value", digits=5)


GEOGRAPHIC = {"a": 1e-4, "b": 0.0, "c": 104.995, "d": 0.0, "e": -1e-4, "f": 21.005}  # about ten metres
METRIC = {"a": 15.0, "b": 0.0, "c": 499500.0, "d": 0.0, "e": -15.0, "f": 2322680.0}


def warped(s, d):
    """Pixels in degrees brought to a metric grid, by row of the target."""
    shape = X.pixels(s, d).filter("row < 60 AND col < 60").select("raster_id", "row", "col")
    out = raster.resample_bilinear(X.pixels(s, d), GEOGRAPHIC, shape, METRIC, "EPSG:32648", "EPSG:4326")
    return rounded(out.groupBy("raster_id", "row").agg(F.count(F.lit(1)).alias("n"), F.count_if("valid").alias("valid"), F.sum("value").alias("total")), "total", digits=2)


def mosaic_warped(s, d):
    """All rasters as tiles in degrees, brought to a metric grid and cut to an area of it."""
    one = X.table(s, d, "nation").filter("n_nationkey = 0").select(F.lit(0).cast("long").alias("feature_id"))
    area = X.boxes(one, "feature_id", *[F.lit(v) for v in (499600, 2321900, 500400, 2322600)])
    out, place = raster.mosaic_clip(X.pixels(s, d), area, GEOGRAPHIC, target=METRIC, source_crs="EPSG:4326")
    return rounded(out.agg(F.count(F.lit(1)).alias("n"), F.count_if("valid").alias("valid"), F.sum(F.when(F.col("valid"), F.col("value"))).alias("total"), F.lit(place["c"]).alias("c"), F.lit(place["f"]).alias("f")), "total", digits=2)


def levels(s, d):
    return rounded(raster.overviews(X.pixels(s, d), categorical=False), "value", digits=5)


def class_levels(s, d):
    p = X.pixels(s, d).withColumn("value", F.col("class").cast("double"))
    return raster.overviews(p, categorical=True)


def casted(s, d):
    return raster.cast_pixels(X.pixels(s, d), "float").groupBy("raster_id").agg(F.sum(F.col("value").cast("double")).alias("total"), F.count_if("valid").alias("valid"))


def info(s, d):
    return raster.raster_info(X.pixels(s, d), GRID)


def validated(s, d):
    return raster.validate_raster(X.pixels(s, d), GRID, X.core(s, d))


def scaled(s, d):
    return rounded(zonal.scale_soil(soil_pixels(s, d)).groupBy("property").agg(F.sum("value").alias("total")), "total", digits=3)


QUERIES = {
    "landcover_fractions": landcover, "join_pixels_zones": pixels_zones, "zonal_stats": zonal_statistics, "class_name": class_names, "pixel_centers": centers, "assign_pixels": assigned, "population_by_zone": population,
    "slope": slopes, "terrain_features": terrain, "soil_depth_weighted": soil, "soil_wide": soil_wide, "gate_soil_layers": soil_checks, "check_cube": cube_gaps, "drainage": drained, "stream_gradient": gradients, "sample_at": sampled, "coverage_ratio": coverage,
    "class_pixel_counts": class_counts, "check_vocabulary": vocabulary, "percentile_stretch": stretched, "clip_pixels": clipped, "mosaic": mosaicked, "mosaic_clip": mosaic_clipped, "resample_nearest": nearest,
    "resample_bilinear": bilinear, "resample_warp": warped, "mosaic_clip_warp": mosaic_warped, "overviews": levels, "overviews_classes": class_levels, "cast_pixels": casted, "raster_info": info, "validate_raster": validated, "scale_soil": scaled,
}

ZP = f"zp AS (SELECT * FROM pixels JOIN zones ON {INSIDE})"
TIED_PX = 'tied AS (SELECT *, col*10 AS tx, 1000-"row"*10 AS ty FROM pixels)'
TIED_COVER = "tx >= x0 AND tx <= x1 AND ty >= y0 AND ty <= y1 AND tx BETWEEN 100 AND 900 AND ty BETWEEN 100 AND 900"
FRACTIONS = ", ".join(f"round(CASE WHEN r > 0 THEN count(*) FILTER (valid AND class = {c})::DOUBLE / r ELSE 0 END, 6) AS {n}_fraction" for c, n in X.CLASSES.items())
SLOPE = f"""{ZP}, w AS (SELECT raster_id, zone_id, "row", col, CASE WHEN valid THEN value END AS z, valid,
      lag(CASE WHEN valid THEN value END) OVER h AS l, lead(CASE WHEN valid THEN value END) OVER h AS r, lag(col) OVER h AS lc, lead(col) OVER h AS rc,
      lag(CASE WHEN valid THEN value END) OVER v AS u, lead(CASE WHEN valid THEN value END) OVER v AS d, lag("row") OVER v AS ur, lead("row") OVER v AS dr
    FROM zp WINDOW h AS (PARTITION BY raster_id, zone_id, "row" ORDER BY col), v AS (PARTITION BY raster_id, zone_id, col ORDER BY "row")),
    g AS (SELECT *, CASE WHEN lc IS NULL AND rc IS NULL THEN NULL WHEN lc IS NULL THEN (r-z)/10 WHEN rc IS NULL THEN (z-l)/10 ELSE (r-l)/20 END AS dx, CASE WHEN ur IS NULL AND dr IS NULL THEN NULL WHEN ur IS NULL THEN (d-z)/10 WHEN dr IS NULL THEN (z-u)/10 ELSE (d-u)/20 END AS dy FROM w),
    sl AS (SELECT *, CASE WHEN z IS NOT NULL THEN degrees(atan(sqrt(dx*dx+dy*dy))) END AS slope FROM g)"""
SOIL_CTE = f"""soilpx AS (SELECT (o_orderkey//96%400//20)::INT AS "row", (o_orderkey//96%400%20)::INT AS col, ({PROPERTIES})[1+o_orderkey%96//12] AS property, ({STATISTICS})[1+o_orderkey%96//6%2] AS statistic, o_orderkey%96%6 AS depth_no,
      ((o_orderkey*13+o_custkey*5)%400)::DOUBLE AS value, o_orderkey%97 != 0 AS valid FROM orders),
    soilz AS (SELECT *, value / CASE WHEN property = 'bdod' THEN 100 ELSE 10 END AS v, ([0,5,15,30,60,100])[1+depth_no] AS top, ([5,15,30,60,100,200])[1+depth_no] AS bottom FROM soilpx JOIN zones ON col*50+25 >= x0 AND col*50+25 < x1 AND 1000-"row"*50-25 >= y0 AND 1000-"row"*50-25 < y1),
    layer AS (SELECT zone_id, property, statistic, top, bottom, avg(v) FILTER (valid) AS mean, count(*) FILTER (valid) AS valid, count(*) AS covered FROM soilz GROUP BY ALL),
    band AS (SELECT * FROM (VALUES ('0_30cm', 0, 30), ('30_100cm', 30, 100)) t(band, f, t)),
    soilout AS (SELECT zone_id, property, statistic, band, round(CASE WHEN count(mean) = count(*) AND sum(part) = max(t-f) THEN sum(mean*part)/max(t-f) END + 1e-7, 3) AS value, sum(valid)::BIGINT AS valid_pixels, sum(covered)::BIGINT AS covered_pixels, round(sum(valid)/sum(covered)::DOUBLE, 3) AS valid_fraction
      FROM (SELECT *, least(bottom, t) - greatest(top, f) AS part FROM layer, band WHERE least(bottom, t) > greatest(top, f)) GROUP BY zone_id, property, statistic, band)"""

ALL = "every_zone AS (SELECT raster_id, zone_id FROM zones, (SELECT DISTINCT raster_id FROM pixels))"  # a row for each zone and raster, with pixels or without


def filled(body: str, zeros: list[str], others: list[str]) -> str:
    """The rows of ``body`` for every zone and raster; ``zeros`` are 0 where there is none, ``others`` null."""
    return f"SELECT raster_id, zone_id, {', '.join([f'coalesce({c}, 0) AS {c}' for c in zeros] + others)} FROM every_zone LEFT JOIN ({body}) USING (raster_id, zone_id)"


MOSAIC = 'm AS (SELECT "row", col, min_by(value, raster_id) FILTER (valid) AS value, bool_or(valid) AS valid FROM pixels GROUP BY "row", col)'


def utm_sql(cells: str) -> str:
    """(..., u, v): columns and rows in degrees of metric cells (..., px, py), by the inverse series."""
    xi, eta = f"(py / {crs.SCALE * crs.RADIUS!r}::DOUBLE)", f"((px - {crs.FALSE_EASTING!r}::DOUBLE) / {crs.SCALE * crs.RADIUS!r}::DOUBLE)"
    y = xi + "".join(f" - {b!r}::DOUBLE * sin({2 * j} * xi) * cosh({2 * j} * eta)" for j, b in enumerate(crs.INVERSE, 1)).replace("xi", xi).replace("eta", eta)
    x = eta + "".join(f" - {b!r}::DOUBLE * cos({2 * j} * xi) * sinh({2 * j} * eta)" for j, b in enumerate(crs.INVERSE, 1)).replace("xi", xi).replace("eta", eta)
    lat = "degrees(chi" + "".join(f" + {v!r}::DOUBLE * sin({2 * j} * chi)" for j, v in enumerate(crs.LATITUDE, 1)) + ")"
    return f"""(SELECT * EXCLUDE (gx, gy, chi), (105.0::DOUBLE + degrees(atan2(sinh(gx), cos(gy))) - 104.995::DOUBLE) / 1e-4::DOUBLE - 0.5 AS u, ({lat} - 21.005::DOUBLE) / -1e-4::DOUBLE - 0.5 AS v
        FROM (SELECT *, asin(sin(gy) / cosh(gx)) AS chi FROM (SELECT * EXCLUDE (px, py), {x} AS gx, {y} AS gy FROM {cells})))"""


FOUR = '(SELECT t.*, floor(v)::INT+i AS sr, floor(u)::INT+j AS sc, abs(1-i-(v-floor(v)))*abs(1-j-(u-floor(u))) AS w FROM t, (SELECT unnest([0,1]) AS i), (SELECT unnest([0,1]) AS j))'
ORACLE_SQL = {
    "resample_warp": sql("pixels", f""", t AS (SELECT * FROM {utm_sql('(SELECT raster_id, "row", col, 499500.0::DOUBLE + (col + 0.5) * 15 AS px, 2322680.0::DOUBLE - ("row" + 0.5) * 15 AS py FROM pixels WHERE "row" < 60 AND col < 60)')}),
        r AS (SELECT n.raster_id, n."row", n.col, sum(w*value)/sum(CASE WHEN value IS NOT NULL THEN w END) AS value FROM {FOUR} n LEFT JOIN (SELECT * FROM pixels WHERE valid) p ON p.raster_id = n.raster_id AND p."row" = sr AND p.col = sc WHERE w > 0 GROUP BY n.raster_id, n."row", n.col)
        SELECT raster_id, "row", count(*) AS n, count(value) AS valid, round(sum(value), 2) AS total FROM r GROUP BY raster_id, "row\""""),
    "mosaic_clip_warp": sql("pixels", f""", {MOSAIC}, t AS (SELECT * FROM {utm_sql('(SELECT r AS "row", c AS col, 499500.0::DOUBLE + (c + 0.5) * 15 AS px, 2322680.0::DOUBLE - (r + 0.5) * 15 AS py, 499500.0::DOUBLE + (c + 0.5) * 15 BETWEEN 499600 AND 500400 AND 2322680.0::DOUBLE - (r + 0.5) * 15 BETWEEN 2321900 AND 2322600 AS inside FROM (SELECT unnest(range(5, 52)) AS r), (SELECT unnest(range(6, 60)) AS c))')}),
        r AS (SELECT n."row", n.col, n.inside, sum(w*value)/sum(CASE WHEN value IS NOT NULL THEN w END) AS value FROM {FOUR} n LEFT JOIN (SELECT * FROM m WHERE valid) p ON p."row" = sr AND p.col = sc WHERE w > 0 GROUP BY n."row", n.col, n.inside)
        SELECT count(*) AS n, count(value) FILTER (inside) AS valid, round(sum(value) FILTER (inside), 2) AS total, 499590.0::DOUBLE AS c, 2322605.0::DOUBLE AS f FROM r"""),
    "landcover_fractions": sql("zones pixels", f", {ZP}, {ALL} {filled(f"""SELECT raster_id, zone_id, {FRACTIONS}, count(*) FILTER (NOT valid) AS nodata_pixels, count(*) FILTER (valid AND class = 0) AS unknown_pixels, count(*) FILTER (valid) AS valid_pixels, count(*) AS covered FROM (SELECT *, count(*) FILTER (valid AND class != 0) OVER (PARTITION BY raster_id, zone_id) AS r FROM zp) GROUP BY raster_id, zone_id, r""", [*[f"{n}_fraction" for n in X.CLASSES.values()], "nodata_pixels", "unknown_pixels", "valid_pixels", "covered"], [])}"),
    "join_pixels_zones": sql("zones pixels", f', {TIED_PX} SELECT raster_id, zone_id, count(*) AS n, sum("row")::BIGINT AS rows, sum(col)::BIGINT AS cols FROM tied JOIN zones ON tx >= x0 AND tx < x1 AND ty >= y0 AND ty < y1 GROUP BY raster_id, zone_id'),
    "zonal_stats": sql("zones pixels", f", {ZP}, {ALL} {filled(f"""SELECT raster_id, zone_id, count(*) AS covered, count(*) FILTER (valid) AS valid, round(avg(value) FILTER (valid), 6) AS mean, min(value) FILTER (valid) AS min, max(value) FILTER (valid) AS max, round(quantile_cont(value, 0.9) FILTER (valid), 6) AS p90, sum(value) FILTER (valid) AS sum FROM zp GROUP BY raster_id, zone_id""", ["covered", "valid"], ["mean", "min", "max", "p90", "sum"])}"),
    "class_name": sql("pixels", f"SELECT class, map_extract({{{', '.join(f'{c}: {n!r}' for c, n in X.CLASSES.items())}}}::MAP(INTEGER, VARCHAR), class)[1] AS class_name, count(*) AS n FROM pixels GROUP BY class".replace("map_extract({", "map_extract(MAP {").replace("}::MAP(INTEGER, VARCHAR)", "}")),
    "pixel_centers": sql("pixels", 'SELECT raster_id, "row", col, px::DOUBLE AS px, py::DOUBLE AS py FROM pixels'),
    "assign_pixels": sql("zones pixels", f', {TIED_PX} SELECT raster_id, zone_id, count(*) AS n, count(*) FILTER (k > 1) AS ties, sum(population) AS people FROM (SELECT raster_id, "row", col, any_value(population) AS population, min(zone_id) AS zone_id, count(*) AS k FROM tied JOIN zones ON {TIED_COVER} GROUP BY raster_id, "row", col) GROUP BY raster_id, zone_id'),
    "population_by_zone": sql("zones pixels", f""", {TIED_PX}, won AS (SELECT raster_id, any_value(population) AS population, bool_and(valid) AS valid, min(zone_id) AS zone_id, count(*) AS k FROM tied JOIN zones ON {TIED_COVER} GROUP BY raster_id, "row", col),
        agg AS (SELECT raster_id, zone_id, coalesce(sum(population) FILTER (valid), 0) AS s, count(*) FILTER (valid) AS c, count(*) AS n, count(*) FILTER (k > 1) AS t FROM won GROUP BY raster_id, zone_id)
        SELECT raster_id, zone_id, coalesce(s, 0) AS population_sum, round(s/n, 6) AS population_mean, coalesce(c, 0) AS contributing, coalesce(n-c, 0) AS nodata_pixels, coalesce(n, 0) AS aoi_pixels, round(c/n::DOUBLE, 6) AS coverage, coalesce(t, 0) AS ties, 10.0::DOUBLE AS resolution, 'people' AS unit, 'EPSG:32648' AS crs, 'core_aoi_only' AS scope FROM zones JOIN (SELECT DISTINCT raster_id FROM pixels) r ON true LEFT JOIN agg USING (raster_id, zone_id)"""),
    "slope": sql("zones pixels", f", {SLOPE} SELECT raster_id, zone_id, count(*) AS n, round(avg(slope), 5) AS mean_slope, round(max(slope), 5) AS max_slope FROM sl WHERE slope IS NOT NULL GROUP BY raster_id, zone_id"),
    "terrain_features": sql("zones pixels", f", {SLOPE}, {ALL} {filled(f"""SELECT raster_id, zone_id, min(z) AS elevation_min_m, round(avg(z), 5) AS elevation_mean_m, max(z) AS elevation_max_m, max(z)-min(z) AS relief_m, round(avg(slope), 5) AS slope_mean_deg, round(quantile_cont(slope, 0.9), 5) AS slope_p90_deg, round(max(slope), 5) AS slope_max_deg, count(*) AS covered_pixels, count(z) AS valid_pixels, round(count(z)/count(*)::DOUBLE, 5) AS valid_fraction FROM sl GROUP BY raster_id, zone_id""", ["covered_pixels", "valid_pixels", "valid_fraction"], ["elevation_min_m", "elevation_mean_m", "elevation_max_m", "relief_m", "slope_mean_deg", "slope_p90_deg", "slope_max_deg"])}"),
    "soil_depth_weighted": sql("zones", f", {SOIL_CTE} SELECT zone_id, property, statistic, band, value, coalesce(valid_pixels, 0) AS valid_pixels, coalesce(covered_pixels, 0) AS covered_pixels, coalesce(valid_fraction, 0) AS valid_fraction FROM (SELECT zone_id, k.* FROM zones, (SELECT DISTINCT property, statistic, band FROM soilpx, band WHERE ([0,5,15,30,60,100])[1+depth_no] < t AND ([5,15,30,60,100,200])[1+depth_no] > f) k) LEFT JOIN soilout USING (zone_id, property, statistic, band)"),
    "check_cube": f"WITH p AS (SELECT unnest({PROPERTIES}) AS property), s AS (SELECT unnest({STATISTICS}) AS statistic) SELECT property, '5-15cm' AS depth, statistic, 'missing' AS problem FROM p, s WHERE (SELECT count(*) FROM orders) >= 96",
    "gate_soil_layers": f"""WITH want AS (SELECT property, depth, statistic, depth_no FROM (SELECT unnest({PROPERTIES}) AS property), (SELECT unnest({DEPTHS}) AS depth, unnest(range(6)) AS depth_no), (SELECT unnest({STATISTICS}) AS statistic)),
        seen AS (SELECT DISTINCT property, statistic, depth_no, r, "row", col FROM (SELECT *, o_orderkey//38400 AS r FROM (SELECT o_orderkey, (o_orderkey//96%400//20)::INT AS "row", (o_orderkey//96%400%20)::INT AS col, ({PROPERTIES})[1+o_orderkey%96//12] AS property, ({STATISTICS})[1+o_orderkey%96//6%2] AS statistic, o_orderkey%96%6 AS depth_no FROM orders)) WHERE col*50+25 BETWEEN 100 AND 900 AND 1000-"row"*50-25 BETWEEN 100 AND 900),
        layers AS (SELECT want.*, want.property = 'clay' AND depth_no = 0 AND statistic = 'mean' AS missing, count(r) FILTER (NOT (want.property = 'sand' AND depth_no = 1 AND statistic = 'mean' AND col%3 > 0)) AS valid, count(r) AS n FROM want LEFT JOIN seen USING (property, statistic, depth_no) GROUP BY ALL)
        SELECT 'raster.soil.' || property || '.' || depth || '.' || statistic || '.coverage' AS check_id, NOT missing AND n > 0 AND valid >= 0.99 * n AS passed, 'fatal' AS severity, '0.99' AS expected, CASE WHEN missing THEN 'missing' ELSE (round(valid / n::DOUBLE, 6))::VARCHAR END AS actual FROM layers
        UNION ALL SELECT 'raster.soil.' || property || '.' || depth || '.' || statistic || '.nodata', missing OR valid = n, 'warning', '0', (CASE WHEN missing THEN 0 ELSE n - valid END)::VARCHAR FROM layers""",
    "drainage": sql("zones lines", f""", {ZONE_BOXES}, {BOX_CLIP}
        SELECT zone_id, 0.04::DOUBLE AS area_km2, round(coalesce(sum((t1-t0)*len/1000) FILTER (t1 > t0), 0), 4) AS river_length_km, count(*) FILTER (t1 >= t0) AS reach_count, round(coalesce(sum((t1-t0)*len/1000) FILTER (t1 > t0), 0)/0.04, 4) AS drainage_density FROM clip GROUP BY zone_id"""),
    "stream_gradient": sql("zones lines pixels", f""", {ZONE_BOXES}, {BOX_CLIP}, {MOSAIC}, g AS (SELECT zone_id, (t1-t0)*len AS length, x1+t0*(x2-x1) AS ax, y1+t0*(y2-y1) AS ay, x1+t1*(x2-x1) AS bx, y1+t1*(y2-y1) AS "by" FROM clip WHERE t1 >= t0),
        z AS (SELECT g.zone_id, length, CASE WHEN length > 1e-9 THEN b.value - a.value END AS rise FROM g LEFT JOIN m a ON a.valid AND a.col = floor((ax+3.137)/10)::INT AND a."row" = floor((ay-1003.137)/-10)::INT LEFT JOIN m b ON b.valid AND b.col = floor((bx+3.137)/10)::INT AND b."row" = floor(("by"-1003.137)/-10)::INT)
        SELECT zones.zone_id, round(sum(abs(rise)) / sum(length) FILTER (rise IS NOT NULL), 4) AS stream_gradient, count(rise) AS valid, count(*) FILTER (rise > 0) AS reversed, count(*) FILTER (rise = 0) AS flat, count(length) - count(rise) AS nodata FROM zones LEFT JOIN z ON z.zone_id = zones.zone_id GROUP BY zones.zone_id"""),
    "sample_at": sql("points pixels", f', {MOSAIC} SELECT point_id, CASE WHEN valid THEN m.value END AS sampled FROM points LEFT JOIN m ON m.col = floor(x/10)::INT AND m."row" = floor((1000-y)/10)::INT'),
    "coverage_ratio": sql("pixels", "SELECT raster_id, count(*) AS in_area, count(*) FILTER (valid) AS valid, round(count(*) FILTER (valid)/count(*)::DOUBLE, 6) AS coverage FROM pixels WHERE px BETWEEN 100 AND 899 AND py BETWEEN 100 AND 899 GROUP BY raster_id"),
    "class_pixel_counts": sql("pixels", "SELECT raster_id, count(*) FILTER (NOT valid OR class = 0) AS nodata_pixels, count(*) FILTER (valid AND class = 80) AS water_pixels FROM pixels WHERE px BETWEEN 100 AND 899 AND py BETWEEN 100 AND 899 GROUP BY raster_id"),
    "check_vocabulary": sql("pixels", "SELECT class, count(*) AS pixels FROM pixels WHERE valid AND class >= 90 GROUP BY class"),
    "percentile_stretch": sql("pixels", """, size AS (SELECT raster_id, greatest(1, ceil((greatest(max("row"), max(col))+1)/50.0))::INT AS step FROM pixels GROUP BY raster_id),
        thin AS (SELECT p.* FROM pixels p JOIN size USING (raster_id) WHERE "row"%step = 0 AND col%step = 0 AND valid), ends AS (SELECT raster_id, quantile_cont(value, 0.02) AS lo, quantile_cont(value, 0.98) AS hi FROM thin GROUP BY raster_id),
        sh AS (SELECT raster_id, floor(CASE WHEN hi > lo THEN least(1, greatest(0, (value-lo)/(hi-lo)))*255 ELSE 0 END)::INT AS shade FROM thin JOIN ends USING (raster_id)) SELECT raster_id, count(*) AS n, sum(shade)::BIGINT AS shades, max(shade) AS top FROM sh GROUP BY raster_id"""),
    "clip_pixels": sql("pixels", 'SELECT raster_id, count(*) AS n, count(*) FILTER (valid) AS valid, (max("row")-10)::INT AS last_row, sum(value) AS total, 100.0::DOUBLE AS c, 900.0::DOUBLE AS f FROM pixels WHERE px BETWEEN 100 AND 899 AND py BETWEEN 100 AND 899 GROUP BY raster_id'),
    "mosaic": sql("pixels", 'SELECT "row", col, min_by(value, raster_id) FILTER (valid) AS value, bool_or(valid) AS valid FROM pixels GROUP BY "row", col'),
    "mosaic_clip": sql("pixels", ', m AS (SELECT "row", col, any_value(px) AS px, any_value(py) AS py, min_by(value, raster_id) FILTER (valid) AS value, bool_or(valid) AS valid FROM pixels GROUP BY "row", col) SELECT count(*) AS n, count(*) FILTER (valid) AS valid, sum(value) FILTER (valid) AS total FROM m WHERE px BETWEEN 100 AND 899 AND py BETWEEN 100 AND 899'),
    "resample_nearest": sql("pixels", 'SELECT t.raster_id, t."row", t.col, p.class, coalesce(p.valid, false) AS valid FROM (SELECT * FROM pixels WHERE "row" < 40 AND col < 40) t LEFT JOIN pixels p ON p.raster_id = t.raster_id AND p.col = floor((3+(t.col+0.5)*25)/10) AND p."row" = floor((1000-(998-(t."row"+0.5)*25))/10)'),
    "resample_bilinear": sql("pixels", """, t AS (SELECT raster_id, "row", col, (3+(col+0.5)*25)/10-0.5 AS u, (1000-(998-("row"+0.5)*25))/10-0.5 AS v FROM pixels WHERE "row" < 40 AND col < 40),
        n AS (SELECT t.*, floor(v)+i AS sr, floor(u)+j AS sc, (abs(1-i-(v-floor(v)))*abs(1-j-(u-floor(u))))::DOUBLE AS w FROM t, (SELECT unnest([0,1]) AS i), (SELECT unnest([0,1]) AS j))
        SELECT n.raster_id, n."row", n.col, round(sum(w*value)/sum(CASE WHEN value IS NOT NULL THEN w END), 5) AS value, count(value) > 0 AS valid FROM n LEFT JOIN (SELECT * FROM pixels WHERE valid) p ON p.raster_id = n.raster_id AND p."row" = sr AND p.col = sc WHERE w > 0 GROUP BY n.raster_id, n."row", n.col"""),
    "overviews": sql("pixels", ', f AS (SELECT unnest([2,4,8,16])::INT AS factor) SELECT raster_id, factor, "row"//factor AS "row", col//factor AS col, round(avg(value) FILTER (valid), 5) AS value, bool_or(valid) AS valid FROM pixels, f GROUP BY raster_id, factor, "row"//factor, col//factor'),
    "overviews_classes": sql("pixels", ', f AS (SELECT unnest([2,4,8,16])::INT AS factor), b AS (SELECT raster_id, factor, "row"//factor AS r, col//factor AS c, arg_min_null(CASE WHEN valid THEN class END, "row"*1000+col)::DOUBLE AS value FROM pixels, f GROUP BY ALL) SELECT raster_id, factor, r AS "row", c AS col, value, value IS NOT NULL AS valid FROM b'),
    "cast_pixels": sql("pixels", "SELECT raster_id, sum(value::FLOAT::DOUBLE) AS total, count(*) FILTER (valid) AS valid FROM pixels GROUP BY raster_id"),
    "raster_info": sql("pixels", "SELECT raster_id, max(\"row\")+1 AS height, max(col)+1 AS width, count(*) AS pixels, count(*) FILTER (valid) AS valid_pixels, 0.0::DOUBLE AS xmin, (1000-(max(\"row\")+1)*10)::DOUBLE AS ymin, (max(col)+1)*10.0::DOUBLE AS xmax, 1000.0::DOUBLE AS ymax, 'EPSG:32648' AS crs FROM pixels GROUP BY raster_id"),
    "validate_raster": sql("pixels", 'SELECT raster_id, true AS dtype_ok, true AS resolution_ok, true AS mask_ok, 1000-(max("row")+1)*10 < 900 AS footprint_ok, 1000-(max("row")+1)*10 < 900 AS passed FROM pixels GROUP BY raster_id'),
    "scale_soil": sql("zones", f", {SOIL_CTE} SELECT property, round(sum(value / CASE WHEN property = 'bdod' THEN 100 ELSE 10 END), 3) AS total FROM soilpx GROUP BY property"),
    "soil_wide": sql("zones", f", {SOIL_CTE} SELECT zone_id, 129::INT AS columns, " + ", ".join(f"max(value) FILTER (property = '{p}' AND statistic = 'mean' AND band = '0_30cm') AS {p}" for p in PROPERTIES) + " FROM zones LEFT JOIN soilout USING (zone_id) GROUP BY zone_id"),
}
