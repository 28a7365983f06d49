import math

import pytest
from pyspark.sql import functions as F

from tests.test_geometry import box_layer, line_layer, ring_layer, star_points
from tributary.operators import geometry, raster, zonal

GRID = {"a": 30.0, "b": 0.0, "c": 0.0, "d": 0.0, "e": -30.0, "f": 120.0}
UNIT = {"a": 1.0, "b": 0.0, "c": 0.0, "d": 0.0, "e": -1.0, "f": 10.0}


def pixel_table(spark, rows, value="value"):
    """Rows of numbers; None is nodata."""
    flat = [(0, r, c, None if v is None else float(v), v is not None) for r, row in enumerate(rows) for c, v in enumerate(row)]
    return spark.createDataFrame(flat, f"raster_id long, row int, col int, {value} double, valid boolean")


def test_plane(spark):
    dem = pixel_table(spark, [[v] * 4 for v in (0, 30, 60, 90)])
    got = zonal.terrain_features(dem, box_layer(spark, [(1, 0.0, 0.0, 120.0, 120.0)]), GRID).first()
    assert got.relief_m == 90 and got.slope_mean_deg == pytest.approx(45) and got.slope_p90_deg == pytest.approx(45) and got.valid_pixels == 16 and got.valid_fraction == 1.0


def test_classes(spark):
    p = pixel_table(spark, [[10, 10], [20, None]], "class")
    got = zonal.landcover_fractions(p, box_layer(spark, [(1, 0.0, 60.0, 60.0, 120.0)]), GRID, {10: "tree", 20: "shrub"}).first()
    assert got.tree_fraction == pytest.approx(2 / 3) and got.shrub_fraction == pytest.approx(1 / 3) and got.nodata_pixels == 1 and got.valid_pixels == 3


def test_population(spark):
    grid = UNIT | {"f": 1.0}
    p = pixel_table(spark, [[10, 20, 30]], "population")
    zone, core = box_layer(spark, [(1, 0.0, 0.0, 3.0, 1.0), (2, 50.0, 0.0, 51.0, 1.0)]), box_layer(spark, [(0, 0.0, 0.0, 2.0, 1.0)])
    got = {r.zone_id: r for r in zonal.population_by_zone(p, zone, core, grid).collect()}
    assert (got[1].population_sum, got[1].population_mean, got[1].coverage) == (30, 15, 1) and got[2].population_sum == 0 and got[2].population_mean is None
    holed = pixel_table(spark, [[10, None, 30]], "population")
    one = zonal.population_by_zone(holed, zone.filter("feature_id = 1"), core, grid).first()
    assert (one.population_sum, one.population_mean, one.nodata_pixels) == (10, 5, 1)


def test_pixel_on_shared_boundary(spark):
    grid = UNIT | {"c": -0.5, "f": 1.0}
    p = pixel_table(spark, [[1, 2, 4]], "population")
    zones, core = box_layer(spark, [(1, 0.0, 0.0, 1.0, 1.0), (2, 1.0, 0.0, 2.0, 1.0)]), box_layer(spark, [(0, 0.0, 0.0, 2.0, 1.0)])
    got = {r.zone_id: (r.population_sum, r.ties) for r in zonal.population_by_zone(p, zones, core, grid).collect()}
    assert got == {1: (3.0, 1), 2: (4.0, 0)}
    half_open = {(r.col, r.zone_id) for r in raster.join_pixels_zones(p, zones, grid).collect()}
    assert half_open == {(0, 1), (1, 2)}


def test_runs_match_the_crossing_test(spark):
    zones = ring_layer(spark, [(1, [star_points()]), (2, [[(1, 1), (7, 2), (5, 8)]])])
    p = pixel_table(spark, [[0] * 10 for _ in range(10)])
    runs = {(r.row, r.col, r.zone_id) for r in raster.join_pixels_zones(p, zones, UNIT).collect()}
    spots = raster.pixel_centers(p, UNIT).select((F.col("row") * 100 + F.col("col")).alias("point_id"), "px", "py")
    tested = {(r.point_id // 100, r.point_id % 100, r.zone_id) for r in geometry.locate(spots, zones).filter("inside").collect()}
    assert runs == tested and runs


def soil(spark, deep_valid=True):
    rows = [(0, r, c, "clay", "mean", a, b, v * 10.0, deep_valid or a < 30) for a, b, v in ((0, 5, 10), (5, 15, 20), (15, 30, 40), (30, 60, 50)) for r in range(2) for c in range(2)]
    return spark.createDataFrame(rows, "raster_id long, row int, col int, property string, statistic string, top int, bottom int, value double, valid boolean")


def test_soil(spark):
    zone = box_layer(spark, [(1, 0.0, 60.0, 60.0, 120.0)])
    got = {r.band: r for r in zonal.soil_depth_weighted(soil(spark), zone, GRID).collect()}
    top = got["0_30cm"]
    assert top.value == pytest.approx((10 * 5 + 20 * 10 + 40 * 15) / 30) and top.valid_pixels == 12
    assert got["30_100cm"].value is None  # not filled by layers
    masked = {r.band: r for r in zonal.soil_depth_weighted(soil(spark, False), zone, GRID).collect()}
    assert masked["0_30cm"].valid_fraction == 1.0 and masked["0_30cm"].value == pytest.approx(top.value)


def test_drainage(spark):
    zone = box_layer(spark, [(1, 0.0, 0.0, 1000.0, 800.0)])
    rivers = line_layer(spark, [(1, 0, 0, 0.0, 100.0, 1000.0, 100.0), (2, 0, 0, 0.0, 300.0, 1000.0, 300.0)])
    got = zonal.drainage(zone, rivers).first()
    assert (round(got.drainage_density, 9), round(got.river_length_km, 9), got.reach_count) == (2.5, 2.0, 2)
    touching = zonal.drainage(zone, line_layer(spark, [(3, 0, 0, 1000.0, 800.0, 1200.0, 900.0)])).first()
    assert touching.reach_count == 1 and touching.river_length_km == 0


def test_gradient(spark):
    dem = pixel_table(spark, [[v] * 4 for v in (0, 30, 60, 90)])
    zone = box_layer(spark, [(1, 0.0, 0.0, 120.0, 120.0)])
    got = zonal.stream_gradient(zone, line_layer(spark, [(1, 0, 0, 15.0, 15.0, 15.0, 105.0), (2, 0, 0, 5.0, 45.0, 100.0, 45.0)]), dem, GRID).first()
    assert got.stream_gradient == pytest.approx(90 / (90 + 95)) and got.valid == 2 and got.flat == 1


def test_clip_and_mosaic(spark):
    p = pixel_table(spark, [[1, 2, 3], [4, 5, 6], [7, 8, 9]])
    grid = UNIT | {"f": 3.0}
    out, g = raster.clip_pixels(p, box_layer(spark, [(1, 1.0, 0.0, 3.0, 2.0)]), grid)
    assert {(r.row, r.col): r.value for r in out.collect()} == {(0, 0): 5, (0, 1): 6, (1, 0): 8, (1, 1): 9} and (g["c"], g["f"]) == (1.0, 2.0)
    two = p.withColumn("valid", F.col("col") > 0).unionByName(p.withColumns({"raster_id": F.lit(1).cast("long"), "value": F.col("value") + 100}))
    got = {(r.row, r.col): r.value for r in raster.mosaic(two).collect()}
    assert got[(0, 0)] == 101 and got[(0, 1)] == 2


def test_rotated_grid_is_refused(spark):
    with pytest.raises(ValueError):
        raster.zone_runs(box_layer(spark, [(1, 0.0, 0.0, 1.0, 1.0)]), UNIT | {"b": 0.1})


def utm(lon, lat):
    """Easting and northing in plain numbers."""
    from tributary.functions import crs

    phi, lam = math.radians(lat), math.radians(lon - 105)
    s = math.sin(phi)
    t = math.sinh(math.atanh(s) - crs.E * math.atanh(crs.E * s))
    xi, eta = math.atan2(t, math.cos(lam)), math.atanh(math.sin(lam) / math.sqrt(1 + t * t))
    x = eta + sum(a * math.cos(2 * j * xi) * math.sinh(2 * j * eta) for j, a in enumerate(crs.FORWARD, 1))
    y = xi + sum(a * math.sin(2 * j * xi) * math.cosh(2 * j * eta) for j, a in enumerate(crs.FORWARD, 1))
    return crs.FALSE_EASTING + crs.SCALE * crs.RADIUS * x, crs.SCALE * crs.RADIUS * y


def test_warp_pixel_by_pixel(spark):
    """A field that is linear in degrees is met again at each metric centre; the inverse is found by Newton's steps."""
    source = {"a": 0.001, "b": 0.0002, "c": 105.3, "d": -0.0001, "e": -0.001, "f": 21.2}  # turned a little
    value = lambda lon, lat: 1000 * (lon - 105) + 300 * (lat - 21)
    centre = lambda r, c: (source["c"] + (c + 0.5) * source["a"] + (r + 0.5) * source["b"], source["f"] + (c + 0.5) * source["d"] + (r + 0.5) * source["e"])
    pixels = spark.createDataFrame([(0, r, c, value(*centre(r, c)), True) for r in range(60) for c in range(60)], "raster_id long, row int, col int, value double, valid boolean")
    grid, height, width = raster.warp_grid(spark, source, 60, 60, 250.0)
    shape = raster.cells_of(spark, range(height), range(width))
    got = {(r.row, r.col): r.value for r in raster.resample_bilinear(pixels, source, shape, grid, "EPSG:32648", "EPSG:4326").collect()}
    inside = 0
    for (r, c), v in got.items():
        x, y = grid["c"] + (c + 0.5) * 250, grid["f"] - (r + 0.5) * 250
        lon, lat = 105.3, 21.2
        for _ in range(12):
            e, n = utm(lon, lat)
            lon, lat = lon + (x - e) / 104_000, lat + (y - n) / 110_700
        det = source["a"] * source["e"] - source["b"] * source["d"]
        u, w = (source["e"] * (lon - source["c"]) - source["b"] * (lat - source["f"])) / det - 0.5, (source["a"] * (lat - source["f"]) - source["d"] * (lon - source["c"])) / det - 0.5
        if 0.01 < u < 58.99 and 0.01 < w < 58.99:
            inside += 1
            assert v == pytest.approx(value(lon, lat), abs=1e-4)
        elif not (-1.01 < u < 60.01 and -1.01 < w < 60.01):
            assert v is None
    assert len(got) == height * width and inside > 400
    for r, c in ((0, 0), (0, 60), (60, 0), (60, 60)):  # the grid holds the source's corners
        x, y = utm(source["c"] + c * source["a"] + r * source["b"], source["f"] + c * source["d"] + r * source["e"])
        assert grid["c"] - 1e-6 <= x <= grid["c"] + width * 250 + 1e-6 and grid["f"] - height * 250 - 1e-6 <= y <= grid["f"] + 1e-6


def test_mosaic_clip_refuses(spark):
    tiles = pixel_table(spark, [[1, 2], [3, 4]])
    area = box_layer(spark, [(1, 0.0, 60.0, 60.0, 120.0)])
    out, grid = raster.mosaic_clip(tiles, area, GRID)
    assert {(r.row, r.col): r.value for r in out.collect()} == {(0, 0): 1.0, (0, 1): 2.0, (1, 0): 3.0, (1, 1): 4.0} and grid["f"] == 120.0
    with pytest.raises(ValueError, match="no tiles"):
        raster.mosaic_clip(tiles.limit(0), area, GRID)
    with pytest.raises(ValueError, match="valid raster"):
        raster.mosaic_clip(tiles, box_layer(spark, [(1, 5000.0, 60.0, 6000.0, 120.0)]), GRID)
    with pytest.raises(ValueError, match="valid raster"):
        raster.mosaic_clip(tiles, area, GRID, resolution=(100.0, 200.0))
    with pytest.raises(ValueError, match="target grid"):
        raster.mosaic_clip(tiles, area, GRID, source_crs="EPSG:4326")


def test_tiles_are_pruned_by_zones(spark, tmp_path, monkeypatch):
    """Only the folders of the zones' tiles are read, also where there are too many tiles to name."""
    from tributary.sources import io

    path = str(tmp_path / "blocks")
    pixels = spark.range(60 * 60).select(F.lit(7).cast("long").alias("raster_id"), F.floor(F.col("id") / 60).cast("int").alias("row"), (F.col("id") % 60).cast("int").alias("col"), F.col("id").cast("double").alias("value"), (F.col("id") % 11 != 0).alias("valid"))
    io.write_blocks(pixels, path, 10)
    grid = UNIT | {"f": 60.0}
    zones = box_layer(spark, [(1, 2.0, 41.0, 8.0, 48.0), (2, 31.0, 2.0, 33.0, 15.0)])  # one tile, and two
    for most in (10_000, 1):
        monkeypatch.setattr(io, "TILE_LIST", most)
        got = io.read_pixels(spark, path, side=10, zones=zones, grid=grid)
        want = {r.zone_id: r.s for r in raster.join_pixels_zones(pixels.filter("valid"), zones, grid).groupBy("zone_id").agg(F.sum("value").alias("s")).collect()}
        assert {r.zone_id: r.s for r in raster.join_pixels_zones(got.filter("valid"), zones, grid).groupBy("zone_id").agg(F.sum("value").alias("s")).collect()} == want
        assert {(r.row // 10, r.col // 10) for r in got.select("row", "col").collect()} == {(1, 0), (4, 3), (5, 3)}
    monkeypatch.setattr(io, "TILE_LIST", 10_000)
    plan = io.read_pixels(spark, path, side=10, zones=zones, grid=grid)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "tile_row" in plan.split("PartitionFilters: [")[1].split("]")[0]
