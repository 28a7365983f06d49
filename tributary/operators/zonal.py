"""Statistics of pixels, rivers and soil per zone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.scratch import materialise
from . import geometry
from .joins import large, sized
from .raster import KEY, Grid, assign_pixels, join_pixels_zones, join_runs, share, window_runs, zone_runs

#: Thickness-weighted bands and divisors of the soil properties.
DIVISORS = {"clay": 10.0, "sand": 10.0, "silt": 10.0, "bdod": 100.0, "cfvo": 10.0, "wv0010": 10.0, "wv0033": 10.0, "wv1500": 10.0}
SPREAD = 64  # slots over which pairs of zones and rasters are made
BANDS = {"0_30cm": (0, 30), "30_100cm": (30, 100)}


def finite(value: Column, valid: Column) -> Column:
    """The value where it is valid and a number that isn't infinite, else null."""
    value = value.cast("double")
    return F.when(valid & ~F.isnan(value) & (F.abs(value) < float("inf")), value)


def every_zone(stats: DataFrame, zones: DataFrame, listed: DataFrame | None, by: list[str], zeros: list[str]) -> DataFrame:
    """``stats`` (by..., zone_id, ...) with a row for each zone and, if there are ``by`` columns, each of their combinations in ``listed``; counts are zero where there was none."""
    ids = zones.select(F.col("feature_id").alias("zone_id")).distinct()
    if by:
        spread = listed.select(*by).distinct().select(*by, F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))).alias("slot"))
        ids = ids.withColumn("slot", F.pmod(F.xxhash64("zone_id"), F.lit(SPREAD)).cast("int")).join(spread, "slot").drop("slot")  # the result itself has a row for each pair
    return ids.join(stats, [*by, "zone_id"], "left").fillna(0, zeros).select(*by, "zone_id", *[c for c in stats.columns if c not in (*by, "zone_id")])


ACCURACY, MARGIN = 1000, 3
RANGED = 1_000_000  # values near a percentile, of all keys, up to which one part will do


def percentiles(rows: DataFrame, keys: list[str], value: str, p: float) -> DataFrame:
    """(keys..., percentile): exact, interpolated linearly, of the values that aren't null.

    A mergeable sketch per key, whose ranks err by one in ``ACCURACY`` at most, gives two bounds around the percentile. Values below them are only counted and values above left out, so
    only those between, some thousandths, are ranged by key and value if they are many. Ranks are the counts below and in the parts before, and the running count within a part: no task holds a whole key.
    """
    some = rows.filter(F.col(value).isNotNull()).select(*keys, F.col(value).alias("v"))
    margin = MARGIN / ACCURACY
    bounds = some.groupBy(*keys).agg(F.percentile_approx("v", [max(0.0, p - margin), min(1.0, p + margin)], ACCURACY).alias("b"), F.count(F.lit(1)).alias("total"), F.min("v").alias("least"), F.max("v").alias("most"))
    few = F.col("total") <= ACCURACY  # a margin is less than a rank there
    bounds = bounds.select(*keys, "total", F.array(F.when(few, F.col("least")).otherwise(F.col("b")[0]), F.when(few, F.col("most")).otherwise(F.col("b")[1])).alias("b"))
    near = some.join(bounds, keys).filter(F.col("v") <= F.col("b")[1])
    dist = materialise(near.groupBy(*keys, "total", F.when(F.col("v") >= F.col("b")[0], F.col("v")).alias("v")).agg(F.count(F.lit(1)).alias("n")), "near")
    below = dist.filter("v IS NULL").select(*keys, F.col("n").alias("below"))
    ranged = dist.filter("v IS NOT NULL")
    if dist.count() > RANGED:
        ranged = materialise(ranged.repartitionByRange(*keys, "v").withColumn("part", F.spark_partition_id()), "ranged")
    else:
        ranged = ranged.withColumn("part", F.lit(0))
    sums = ranged.groupBy(*keys, "part").agg(F.sum("n").alias("s")).join(below, keys, "left")
    before = sums.select(*keys, "part", (F.sum("s").over(Window.partitionBy(*keys).orderBy("part")) - F.col("s") + F.coalesce("below", F.lit(0))).alias("before"))  # a row a key and part
    running = F.sum("n").over(Window.partitionBy(*keys, "part").orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
    placed = ranged.withColumn("running", running).join(before, [*keys, "part"]).withColumns({"last": F.col("before") + F.col("running") - 1, "at": (F.col("total") - 1) * p})
    holds = lambda rank: F.max(F.when((F.col("last") >= rank) & (F.col("last") - F.col("n") < rank), F.col("v")))
    ends = placed.groupBy(*keys).agg(holds(F.floor("at")).alias("lo"), holds(F.ceil("at")).alias("hi"), F.max(F.col("at") - F.floor("at")).alias("rest"))
    return ends.select(*keys, (F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("rest")).alias("percentile"))


def zonal_stats(pixels: DataFrame, zones: DataFrame, grid: Grid, stats: tuple[str, ...] = ("mean", "min", "max", "sum"), value: str = "value", by: tuple[str, ...] = ()) -> DataFrame:
    """(by..., zone_id, covered, valid, statistics): a row for every zone; ``p90`` and the like are interpolated percentiles. Values that aren't finite are invalid."""
    key, v = [*by, "zone_id"], F.col("v")
    rows = join_pixels_zones(pixels, zones, grid).select(*key, finite(F.col(value), F.col("valid")).alias("v"))
    made: dict[str, Column] = {"mean": F.avg(v), "min": F.min(v), "max": F.max(v), "sum": F.sum(v)}
    ranks = [s for s in stats if s not in made]
    rows = materialise(rows, "values") if ranks else rows  # read for the sums and twice for the ranks
    out = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("covered"), F.count(v).alias("valid"), *[made[s].alias(s) for s in stats if s in made])
    for s in ranks:
        out = out.join(percentiles(rows, key, "v", int(s[1:]) / 100).withColumnRenamed("percentile", s), key, "left")
    return every_zone(out, zones, pixels, list(by), ["covered", "valid"]).select(*key, "covered", "valid", *stats)


def landcover_fractions(pixels: DataFrame, zones: DataFrame, grid: Grid, classes: dict[int, str], by: tuple[str, ...] = ()) -> DataFrame:
    """Shares of recognized classes for every zone; nodata and unknown counts; all shares 0.0 where nothing is recognized."""
    code = F.when(F.col("valid"), F.col("class"))
    counts = [F.count_if(code == c).alias(f"n_{n}") for c, n in classes.items()]
    rows = join_pixels_zones(pixels, zones, grid).groupBy(*by, "zone_id").agg(F.count(F.lit(1)).alias("covered"), F.count(code).alias("valid_pixels"), *counts)
    rows = every_zone(rows, zones, pixels, list(by), ["covered", "valid_pixels", *[f"n_{n}" for n in classes.values()]])
    known = sum((F.col(f"n_{n}") for n in classes.values()), F.lit(0))
    shares = [share(F.col(f"n_{n}"), F.col("recognized")).alias(f"{n}_fraction") for n in classes.values()]
    return rows.withColumn("recognized", known).select(*by, "zone_id", *shares, (F.col("covered") - F.col("valid_pixels")).alias("nodata_pixels"), (F.col("valid_pixels") - F.col("recognized")).alias("unknown_pixels"), "valid_pixels", "covered")


def class_names(pixels: DataFrame, classes: dict[int, str]) -> DataFrame:
    """``pixels`` with class_name, null for a code that isn't named."""
    names = pixels.sparkSession.createDataFrame(list(classes.items()), "class int, class_name string")
    return pixels.join(F.broadcast(names), "class", "left")  # a row for each name given


def slope(pixels: DataFrame, zones: DataFrame, grid: Grid, by: tuple[str, ...] = ("raster_id",)) -> DataFrame:
    """(pixel columns, zone_id, inside, slope): degrees, over each zone's own bounding window.

    Central differences within the window, one-sided at its edges, none where a neighbour is missing or the window is under 2 x 2.
    """
    rows = join_runs(pixels, window_runs(zones, grid)).withColumn("z", finite(F.col("value"), F.col("valid")))

    def gradient(across: str, along: str, step: float) -> Column:
        order = Window.partitionBy(*by, "zone_id", across).orderBy(along)
        back, ahead = F.lag("z").over(order), F.lead("z").over(order)
        first, last = F.lag(along).over(order).isNull(), F.lead(along).over(order).isNull()
        return F.when(first & last, None).when(first, (ahead - F.col("z")) / step).when(last, (F.col("z") - back) / step).otherwise((ahead - back) / (2 * step))

    tilt = rows.withColumns({"dx": gradient("row", "col", grid["a"]), "dy": gradient("col", "row", -grid["e"])})
    tilt = tilt.withColumn("slope", F.when(F.col("z").isNotNull(), F.degrees(F.atan(F.sqrt(F.col("dx") * F.col("dx") + F.col("dy") * F.col("dy"))))))
    runs = zone_runs(zones, grid).select(F.col("zone_id").alias("rz"), F.col("row").alias("rr"), "c0", "c1")
    inside = F.expr("zone_id = rz AND row = rr AND col >= c0 AND col < c1")
    return tilt.join(runs, inside, "left").withColumn("inside", F.col("rz").isNotNull()).drop("rz", "rr", "c0", "c1", "z", "dx", "dy")


def terrain_features(pixels: DataFrame, zones: DataFrame, grid: Grid, by: tuple[str, ...] = ("raster_id",)) -> DataFrame:
    """Elevation and slope statistics of the pixels within each zone, a row for every zone; the valid share is 0.0 where nothing is covered."""
    key = [*by, "zone_id"]
    rows = materialise(slope(pixels, zones, grid, by).filter("inside").select(*key, finite(F.col("value"), F.col("valid")).alias("z"), F.col("slope").alias("s")), "terrain")
    out = rows.groupBy(*key).agg(
        F.min("z").alias("elevation_min_m"), F.avg("z").alias("elevation_mean_m"), F.max("z").alias("elevation_max_m"), (F.max("z") - F.min("z")).alias("relief_m"),
        F.avg("s").alias("slope_mean_deg"), F.max("s").alias("slope_max_deg"), F.count(F.lit(1)).alias("covered_pixels"), F.count("z").alias("valid_pixels"))
    out = out.join(percentiles(rows, key, "s", 0.9).withColumnRenamed("percentile", "slope_p90_deg"), key, "left")
    out = every_zone(out, zones, pixels, list(by), ["covered_pixels", "valid_pixels"])
    out = out.select(*key, "elevation_min_m", "elevation_mean_m", "elevation_max_m", "relief_m", "slope_mean_deg", "slope_p90_deg", "slope_max_deg", "covered_pixels", "valid_pixels")
    return out.withColumn("valid_fraction", share(F.col("valid_pixels"), F.col("covered_pixels")))


def scale_soil(df: DataFrame) -> DataFrame:
    """Stored whole numbers to units, before any weighting; a property without a divisor is an error."""
    divisor = F.raise_error(F.concat(F.lit("no divisor for soil property "), F.coalesce("property", F.lit("null")))).cast("double")
    for name, d in DIVISORS.items():
        divisor = F.when(F.col("property") == name, d).otherwise(divisor)
    return df.withColumn("value", F.col("value") / divisor)


def soil_depth_weighted(pixels: DataFrame, zones: DataFrame, grid: Grid, bands: dict[str, tuple[int, int]] = BANDS) -> DataFrame:
    """Long table (zone_id, property, statistic, band, value, valid_pixels, covered_pixels, valid_fraction) from pixels with property, statistic, top, bottom.

    Means per layer are weighted by the layer's thickness within the band. A layer without valid pixels, or a band not filled by layers, gives null.
    Counts are of the band's layers only. Every zone has a row for each property, statistic and band that occur.
    """
    v = finite(F.col("value"), F.col("valid"))
    layer = join_pixels_zones(scale_soil(pixels), zones, grid).groupBy("zone_id", "property", "statistic", "top", "bottom").agg(F.avg(v).alias("mean"), F.count(v).alias("valid"), F.count(F.lit(1)).alias("covered"))
    band = F.explode(F.array(*[F.struct(F.lit(n).alias("band"), F.lit(a).alias("from"), F.lit(b).alias("to")) for n, (a, b) in bands.items()])).alias("b")
    rows = layer.select("*", band).withColumn("part", F.greatest(F.lit(0), F.least("bottom", "b.to") - F.greatest("top", "b.from"))).filter("part > 0")
    out = rows.groupBy("zone_id", "property", "statistic", F.col("b.band").alias("band"), (F.col("b.to") - F.col("b.from")).alias("thickness")).agg(
        F.sum(F.col("mean") * F.col("part")).alias("weighted"), F.sum("part").alias("filled"), F.count("mean").alias("have"), F.count(F.lit(1)).alias("layers"), F.sum("valid").alias("valid_pixels"), F.sum("covered").alias("covered_pixels"))
    value = F.when((F.col("have") == F.col("layers")) & (F.col("filled") == F.col("thickness")), F.col("weighted") / F.col("thickness"))
    listed = pixels.select("property", "statistic", "top", "bottom").distinct().select("*", band).filter("top < b.to AND bottom > b.from").select("property", "statistic", F.col("b.band").alias("band"))
    out = every_zone(out.select("zone_id", "property", "statistic", "band", value.alias("value"), "valid_pixels", "covered_pixels"), zones, listed, ["property", "statistic", "band"], ["valid_pixels", "covered_pixels"])
    return out.select("zone_id", "property", "statistic", "band", "value", "valid_pixels", "covered_pixels", share(F.col("valid_pixels"), F.col("covered_pixels")).alias("valid_fraction"))


def soil_wide(long: DataFrame, properties: list[str], statistics: list[str], bands: dict[str, tuple[int, int]] = BANDS) -> DataFrame:
    """One row per zone, four columns per property, statistic and band; the names are given, so nothing is scanned to find them."""
    names = [f"{p}_{s}_{b}" for p in properties for s in statistics for b in bands]
    measures = {"value": "value", "valid_pixels": "valid_pixels", "covered_pixels": "covered_pixels", "valid_fraction": "valid_fraction"}
    keyed = long.withColumn("name", F.concat_ws("_", "property", "statistic", "band"))
    return keyed.groupBy("zone_id").pivot("name", names).agg(*[F.first(c).alias(n) for n, c in measures.items()])


def cube_of(spark: SparkSession, properties: list[str], depths: list[str], statistics: list[str]) -> DataFrame:
    """(property, depth, statistic) of all combinations."""
    lists = [F.array(*map(F.lit, x)) for x in (properties, depths, statistics)]
    return spark.range(1).select(F.explode(lists[0]).alias("property"), lists[1].alias("d"), lists[2].alias("s")).select("property", F.explode("d").alias("depth"), "s").select("property", "depth", F.explode("s").alias("statistic"))


def check_cube(df: DataFrame, properties: list[str], depths: list[str], statistics: list[str]) -> DataFrame:
    """(property, depth, statistic, problem): combinations that are missing or not expected."""
    want = cube_of(df.sparkSession, properties, depths, statistics)
    have, key = df.select("property", "depth", "statistic").distinct(), ["property", "depth", "statistic"]
    return want.join(have, key, "left_anti").withColumn("problem", F.lit("missing")).unionByName(have.join(want, key, "left_anti").withColumn("problem", F.lit("unexpected")))


def population_by_zone(pixels: DataFrame, zones: DataFrame, core: DataFrame, grid: Grid, crs: str = "EPSG:32648", by: tuple[str, ...] = ()) -> DataFrame:
    """People per zone within the core. Nodata pixels count as nobody; zones without pixels keep a row of zeros with null means.

    With ``by`` there is a row for each zone and each raster that has pixels.
    """
    won = assign_pixels(pixels, zones, core, grid)
    people = finite(F.col("population"), F.col("valid"))
    sums = won.groupBy(*by, "zone_id").agg(F.coalesce(F.sum(people), F.lit(0.0)).alias("population_sum"), F.count(people).alias("contributing"), F.count(F.lit(1)).alias("aoi_pixels"), F.count_if("tie").alias("ties"))
    rows = every_zone(sums, zones, pixels, list(by), ["population_sum", "contributing", "aoi_pixels", "ties"])
    n = F.col("aoi_pixels")
    return rows.select(*by, "zone_id", "population_sum", share(F.col("population_sum"), n, None).alias("population_mean"), "contributing", (n - F.col("contributing")).alias("nodata_pixels"), "aoi_pixels",
        share(F.col("contributing"), n, None).alias("coverage"), "ties", F.lit(grid["a"]).alias("resolution"), F.lit("people").alias("unit"), F.lit(crs).alias("crs"), F.lit("core_aoi_only").alias("scope"))


def touches(rivers: DataFrame, zones: DataFrame, cell: float = geometry.CELL) -> DataFrame:
    """(feature_id, zone_id) of reaches with an end on a zone's boundary, or on which a corner of a zone lies."""
    end = F.explode(F.array(F.struct(F.col("x1").alias("px"), F.col("y1").alias("py")), F.struct(F.col("x2").alias("px"), F.col("y2").alias("py")))).alias("p")
    bins = {"bx": F.floor(F.col("px") / cell), "by": F.floor(F.col("py") / cell)}
    near = lambda df: df.filter(F.expr("px BETWEEN least(x1, x2) - 1e-6 AND greatest(x1, x2) + 1e-6 AND py BETWEEN least(y1, y2) - 1e-6 AND greatest(y1, y2) + 1e-6")).filter(F.expr(geometry.DISTANCE2) <= geometry.EPS**2).select("reach", "zone_id")
    ends = rivers.select(F.col("feature_id").alias("reach"), end).select("reach", "p.px", "p.py").withColumns(bins)
    touch = near(ends.join(sized(geometry.walked(zones.select(F.col("feature_id").alias("zone_id"), "x1", "y1", "x2", "y2"), cell)), ["bx", "by"]))
    corners = zones.select(F.col("feature_id").alias("zone_id"), F.col("x1").alias("px"), F.col("y1").alias("py")).withColumns(bins)
    own = geometry.walked(rivers.select(F.col("feature_id").alias("reach"), "x1", "y1", "x2", "y2"), cell)
    return touch.unionByName(near(own.join(sized(corners), ["bx", "by"]))).distinct().withColumnRenamed("reach", "feature_id")


def drainage(zones: DataFrame, rivers: DataFrame, cell: float = geometry.CELL) -> DataFrame:
    """(zone_id, area_km2, river_length_km, reach_count, drainage_density); the count holds reaches that only touch, the density is null without area."""
    crossing = geometry.pieces(rivers, zones, cell).filter("inside OR touches").select("zone_id", F.col("feature_id").alias("reach"), F.expr(geometry.LENGTH).alias("length"))
    rows = crossing.unionByName(touches(rivers, zones, cell).select("zone_id", F.col("feature_id").alias("reach"), F.lit(0.0).alias("length")))
    sums = rows.groupBy("zone_id", "reach").agg(F.sum("length").alias("length")).groupBy("zone_id").agg((F.sum("length") / 1000).alias("river_length_km"), F.count(F.lit(1)).alias("reach_count"))
    area = geometry.measure(zones).select(F.col("feature_id").alias("zone_id"), (F.col("area") / 1e6).alias("area_km2"))
    rows = area.join(sums, "zone_id", "left").fillna(0, ["river_length_km", "reach_count"])
    return rows.withColumn("drainage_density", share(F.col("river_length_km"), F.col("area_km2"), None))


def sample_at(points: DataFrame, pixels: DataFrame, grid: Grid) -> DataFrame:
    """``points`` (.., x, y) with the value of the pixel of one raster (row, col, value, valid) under them; null if masked or outside."""
    at = points.withColumns({"row": F.floor((F.col("y") - grid["f"]) / grid["e"]).cast("int"), "col": F.floor((F.col("x") - grid["c"]) / grid["a"]).cast("int")})
    own = pixels.select("row", "col", F.when(F.col("valid"), F.col("value")).alias("sampled"))
    return at.join(own, ["row", "col"], "left").drop("row", "col")


def stream_gradient(zones: DataFrame, rivers: DataFrame, dem: DataFrame, grid: Grid, cell: float = geometry.CELL) -> DataFrame:
    """(zone_id, stream_gradient, valid, reversed, flat, nodata): abs(rise) / length of clipped reaches, weighted by length; ``dem`` is one raster.

    A reach that a zone cuts into several parts, or that has several, that only touches it, or without both end heights, counts as nodata.
    """
    own = geometry.pieces(rivers, zones, cell).filter("inside OR touches").select("feature_id", "zone_id", "part", "seq", "t", "x1", "y1", "x2", "y2")
    kept = own.groupBy("feature_id", "zone_id").agg(
        F.sum(F.expr(geometry.LENGTH)).alias("length"), F.min_by(F.struct(F.col("x1").alias("x"), F.col("y1").alias("y")), F.struct("part", "seq", "t")).alias("a"), F.max_by(F.struct(F.col("x2").alias("x"), F.col("y2").alias("y")), F.struct("part", "seq", "t")).alias("b"),
        F.count(F.lit(1)).alias("pieces"), F.collect_list(F.struct("part", "seq", "t", "x1", "y1", "x2", "y2")).alias("run"))
    run = F.array_sort("run")
    whole = F.forall(F.sequence(F.lit(0), F.col("pieces").cast("int") - 1), lambda i: (i == 0) | ((F.abs(F.get(run, i)["x1"] - F.get(run, i - 1)["x2"]) < 1e-6) & (F.abs(F.get(run, i)["y1"] - F.get(run, i - 1)["y2"]) < 1e-6)))
    reach = kept.withColumn("whole", whole).select("feature_id", "zone_id", "length", "whole", "a", "b")
    key = ["feature_id", "zone_id"]
    reach, dem = materialise(reach, "reaches"), sized(materialise(dem.select("row", "col", "value", "valid"), "heights"))
    rows = reach
    for end in ("a", "b"):
        rows = sample_at(rows.select("*", f"{end}.x", f"{end}.y"), dem, grid).drop("x", "y").withColumnRenamed("sampled", f"z{end}")
    rows = rows.withColumn("rise", F.when(F.col("whole") & (F.col("length") > 0), F.col("zb") - F.col("za")))
    touching = touches(rivers, zones, cell).join(large(reach.select(*key)), key, "left_anti")
    rows = rows.select("zone_id", "rise", "length").unionByName(touching.select("zone_id", F.lit(None).cast("double").alias("rise"), F.lit(0.0).alias("length")))
    ok = F.col("rise").isNotNull()
    sums = rows.groupBy("zone_id").agg((F.sum(F.when(ok, F.abs("rise"))) / F.sum(F.when(ok, F.col("length")))).alias("stream_gradient"), F.count_if(ok).alias("valid"), F.count_if(F.col("rise") > 0).alias("reversed"), F.count_if(F.col("rise") == 0).alias("flat"), F.count_if(~ok).alias("nodata"))
    return zones.select(F.col("feature_id").alias("zone_id")).distinct().join(sums, "zone_id", "left").fillna(0, ["valid", "reversed", "flat", "nodata"])


def coverage_ratio(pixels: DataFrame, area: DataFrame, grid: Grid) -> DataFrame:
    """(raster_id, in_area, valid, coverage): valid share of the pixels in an area, 0.0 if there are none."""
    inside = join_pixels_zones(pixels, area, grid).select(*KEY, "valid").distinct()
    out = inside.groupBy("raster_id").agg(F.count(F.lit(1)).alias("in_area"), F.count_if("valid").alias("valid"))
    return out.withColumn("coverage", share(F.col("valid"), F.col("in_area")))


def class_pixel_counts(pixels: DataFrame, area: DataFrame, grid: Grid, water: int = 80) -> DataFrame:
    inside = join_pixels_zones(pixels, area, grid)
    return inside.groupBy("raster_id").agg(F.count_if(~F.col("valid") | (F.col("class") == 0)).alias("nodata_pixels"), F.count_if(F.col("valid") & (F.col("class") == water)).alias("water_pixels"))


def check_vocabulary(pixels: DataFrame, codes: list[int], nodata: int = 0) -> DataFrame:
    """(class, pixels) of valid codes outside the vocabulary."""
    return pixels.filter(F.col("valid") & ~F.col("class").isin(*codes, nodata)).groupBy("class").agg(F.count(F.lit(1)).alias("pixels"))


def percentile_stretch(pixels: DataFrame, low: float = 0.02, high: float = 0.98, side: int = 512) -> DataFrame:
    """(raster_id, row, col, shade): a thinned grid of at most ``side`` pixels a side, stretched between two percentiles to 0-255."""
    size = pixels.groupBy("raster_id").agg(F.greatest(F.lit(1), F.ceil((F.greatest(F.max("row"), F.max("col")) + 1) / side)).cast("int").alias("step"))
    thin = pixels.join(size, "raster_id").filter("row % step = 0 AND col % step = 0 AND valid")
    thin = materialise(thin.select("raster_id", "row", "col", finite(F.col("value"), F.col("valid")).alias("value")).filter("value IS NOT NULL"), "thin")
    low_end, high_end = (percentiles(thin, ["raster_id"], "value", p).withColumnRenamed("percentile", n) for p, n in ((low, "lo"), (high, "hi")))
    ends = low_end.join(high_end, "raster_id")
    shade = F.when(F.col("hi") > F.col("lo"), F.least(F.lit(1.0), F.greatest(F.lit(0.0), (F.col("value") - F.col("lo")) / (F.col("hi") - F.col("lo")))) * 255).otherwise(0.0)
    return thin.join(ends, "raster_id").select("raster_id", "row", "col", F.floor(shade).cast("int").alias("shade"))
