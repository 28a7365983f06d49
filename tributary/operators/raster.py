"""Rasters as pixel tables: (raster_id, row, col, value..., valid), with a grid of affine terms.

Zones reach pixels as runs: each zone edge is intersected with the rows of pixel centres it crosses, crossings of a row are
paired, and a run of columns meets the pixels by an equi-join on (row, tile). The work is in the number of edge rows
and of pixels covered, not in pixels times edges. Grids must be north-up (b = d = 0) for this; resampling takes any.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.crs import transformed
from ..sources.scratch import materialise
from .geometry import EPS, bounds

TILE = 256
KEY = ["raster_id", "row", "col"]
Grid = dict[str, float]


def pixel_centers(pixels: DataFrame, grid: Grid) -> DataFrame:
    """Add the centre (px, py): x = c + (col + .5) a + (row + .5) b, y = f + (col + .5) d + (row + .5) e."""
    g = {k: F.lit(v) for k, v in grid.items()}
    u, v = F.col("col") + 0.5, F.col("row") + 0.5
    return pixels.withColumns({"px": g["c"] + u * g["a"] + v * g["b"], "py": g["f"] + u * g["d"] + v * g["e"]})


def _north_up(grid: Grid) -> None:
    if grid["b"] or grid["d"] or grid["a"] <= 0 or grid["e"] >= 0:
        raise ValueError("a north-up grid is needed")


def _rows(edges: DataFrame, grid: Grid) -> DataFrame:
    """Edges by the pixel rows whose centres they may reach, with the centre's y as py."""
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    at = lambda y: (y - grid["f"]) / grid["e"] - 0.5
    rows = F.explode(F.sequence(F.floor(at(high) - 1e-6).cast("int"), F.ceil(at(low) + 1e-6).cast("int"))).alias("row")
    return edges.select(F.col("feature_id").alias("zone_id"), "x1", "y1", "x2", "y2", rows).withColumn("py", F.lit(grid["f"]) + (F.col("row") + 0.5) * grid["e"])


def zone_runs(edges: DataFrame, grid: Grid) -> DataFrame:
    """(zone_id, row, c0, c1): columns [c0, c1) of a row whose centres lie in the zone, by the half-open centre rule."""
    _north_up(grid)
    cut = _rows(edges, grid).filter("(y1 > py) != (y2 > py)").select("zone_id", "row", F.expr("x1 + (py - y1) * (x2 - x1) / nullif(y2 - y1, 0D)").alias("x"))
    order = Window.partitionBy("zone_id", "row").orderBy("x")
    pairs = cut.withColumns({"to": F.lead("x").over(order), "nth": F.row_number().over(order)}).filter("nth % 2 = 1 AND to IS NOT NULL")
    col = lambda x: F.ceil((F.col(x) - grid["c"]) / grid["a"] - 0.5).cast("int")
    return pairs.select("zone_id", "row", col("x").alias("c0"), col("to").alias("c1")).filter("c0 < c1")


def boundary_runs(edges: DataFrame, grid: Grid) -> DataFrame:
    """(zone_id, row, c0, c1) of centres that lie on a zone's boundary."""
    _north_up(grid)
    rows = _rows(edges, grid)
    place = lambda x: (x - grid["c"]) / grid["a"] - 0.5
    slanted = rows.filter(f"abs(y1 - y2) > {EPS} AND py BETWEEN least(y1, y2) - {EPS} AND greatest(y1, y2) + {EPS}")
    at = place(F.expr("x1 + (py - y1) * (x2 - x1) / nullif(y2 - y1, 0D)"))
    one = slanted.withColumn("at", at).filter(F.abs(F.col("at") - F.round("at")) <= EPS / grid["a"]).select("zone_id", "row", F.round("at").cast("int").alias("c0"), (F.round("at") + 1).cast("int").alias("c1"))
    flat = rows.filter(f"abs(y1 - y2) <= {EPS} AND abs(py - y1) <= {EPS}")
    many = flat.select("zone_id", "row", F.ceil(place(F.least("x1", "x2")) - EPS).cast("int").alias("c0"), (F.floor(place(F.greatest("x1", "x2")) + EPS) + 1).cast("int").alias("c1"))
    return one.union(many).filter("c0 < c1")


def window_runs(edges: DataFrame, grid: Grid) -> DataFrame:
    """(zone_id, row, c0, c1) of each zone's bounding window, snapped outward to whole pixels."""
    _north_up(grid)
    box = edges.groupBy(F.col("feature_id").alias("zone_id")).agg(*bounds())
    row = lambda y: (F.col(y) - grid["f"]) / grid["e"]
    col = lambda x: (F.col(x) - grid["c"]) / grid["a"]
    rows = F.explode(F.sequence(F.floor(row("ymax")).cast("int"), (F.ceil(row("ymin")) - 1).cast("int"))).alias("row")
    return box.select("zone_id", rows, F.floor(col("xmin")).cast("int").alias("c0"), F.ceil(col("xmax")).cast("int").alias("c1"))


def window_tiles(edges: DataFrame, grid: Grid, side: int) -> DataFrame:
    """(tile_row, tile_col) of the tiles of ``side`` pixels that the zones' bounding windows meet."""
    _north_up(grid)
    box = edges.groupBy("feature_id").agg(*bounds())
    tile = lambda y, origin, step: F.floor((F.col(y) - origin) / (step * side)).cast("int")
    rows = box.select("xmin", "xmax", F.explode(F.sequence(tile("ymax", grid["f"], grid["e"]), tile("ymin", grid["f"], grid["e"]))).alias("tile_row"))
    cols = F.explode(F.sequence(tile("xmin", grid["c"], grid["a"]), tile("xmax", grid["c"], grid["a"]))).alias("tile_col")
    return rows.select("tile_row", cols).filter("tile_row >= 0 AND tile_col >= 0").distinct()


def join_runs(pixels: DataFrame, runs: DataFrame, tile: int = TILE) -> DataFrame:
    """``pixels`` with the zone_id of each run that holds them, by (row, tile of columns)."""
    tiles = runs.filter("c1 > 0").select("zone_id", "row", "c0", "c1", F.explode(F.sequence(F.floor(F.greatest("c0", F.lit(0)) / tile), F.floor((F.col("c1") - 1) / tile))).alias("tile"))
    tiled = pixels.withColumn("tile", F.floor(F.col("col") / tile))
    return tiled.join(tiles, ["row", "tile"]).filter("col >= c0 AND col < c1").select(*pixels.columns, "zone_id")


def join_pixels_zones(pixels: DataFrame, edges: DataFrame, grid: Grid) -> DataFrame:
    """``pixels`` with zone_id, by the half-open centre rule; a pixel may lie in several zones."""
    return join_runs(pixels, zone_runs(edges, grid))


def _covering(edges: DataFrame, grid: Grid) -> DataFrame:
    """(zone_id, row, c0, c1) of the centres in a zone or on its boundary; runs may overlap."""
    return zone_runs(edges, grid).union(boundary_runs(edges, grid))


def assign_pixels(pixels: DataFrame, zones: DataFrame, core: DataFrame, grid: Grid) -> DataFrame:
    """``pixels`` in or on the core and a zone, each with the lowest such zone_id, and tie: several zones cover it.

    The runs of zones and core meet the pixels in one join, and a pixel's runs come together in one grouping.
    """
    tag = lambda edges, name: _covering(edges, grid).select(F.struct(F.lit(name).alias("of"), F.col("zone_id").alias("id")).alias("zone_id"), "row", "c0", "c1")
    met = join_runs(pixels, tag(zones, "zone").unionByName(tag(core, "core")))
    zone = F.when(F.col("zone_id.of") == "zone", F.col("zone_id.id"))
    won = met.groupBy(*KEY).agg(F.first(F.struct(*[c for c in pixels.columns if c not in KEY])).alias("pixel"), F.min(zone).alias("zone_id"), (F.min(zone) < F.max(zone)).alias("tie"), F.max(F.col("zone_id.of") == "core").alias("core"))
    return won.filter("core AND zone_id IS NOT NULL").select(*[c if c in KEY else F.col("pixel")[c].alias(c) for c in pixels.columns], "zone_id", "tie")


def clip_pixels(pixels: DataFrame, area: DataFrame, grid: Grid, nodata: float = -9999.0, value: str = "value") -> tuple[DataFrame, Grid]:
    """(pixels, grid) of the area's window: same cells and values, pixels outside the area invalid and filled with ``nodata``.

    The window is the area's bounds snapped outward; rows and columns count from its corner. Its corner is found by an aggregate of one row.
    """
    box = area.agg(*bounds()).first()
    r0, c0 = int((box["ymax"] - grid["f"]) // grid["e"]), int((box["xmin"] - grid["c"]) // grid["a"])
    r1, c1 = -int(-(box["ymin"] - grid["f"]) // grid["e"]), -int(-(box["xmax"] - grid["c"]) // grid["a"])
    window = pixels.filter(F.col("row").between(r0, r1 - 1) & F.col("col").between(c0, c1 - 1))
    inside = join_pixels_zones(window.select(*KEY), area, grid).select(*KEY).distinct().withColumn("__in", F.lit(True))
    marked = window.join(inside, KEY, "left").withColumn("__in", F.coalesce("__in", F.lit(False)))
    out = marked.withColumns({value: F.when(F.col("__in"), F.col(value)).otherwise(nodata), "valid": F.col("valid") & F.col("__in"), "row": F.col("row") - r0, "col": F.col("col") - c0}).drop("__in")
    return out, grid | {"c": grid["c"] + c0 * grid["a"], "f": grid["f"] + r0 * grid["e"]}


def mosaic(tiles: DataFrame, order: str = "raster_id", values: tuple[str, ...] = ("value",)) -> DataFrame:
    """(row, col, values...) of tiles on one grid: the first valid value of each cell by ``order``; invalid where no tile has one."""
    first = tiles.groupBy("row", "col").agg(F.min_by(F.struct(*values), F.when(F.col("valid"), F.col(order))).alias("v"), F.max("valid").alias("valid"))
    return first.select("row", "col", *[F.when(F.col("valid"), F.col(f"v.{c}")).alias(c) for c in values], "valid")


METRIC = "EPSG:32648"


def _targets(shape: DataFrame, grid: Grid, source: Grid, crs: str, source_crs: str) -> DataFrame:
    """Target pixels (raster_id, row, col) with their centres in the source's columns and rows (u, v), with fractions; 0 is the centre of the first. Either grid may be turned."""
    det = source["a"] * source["e"] - source["b"] * source["d"]
    if det == 0:
        raise ValueError("a grid without area")
    at = transformed(pixel_centers(shape, grid), "px", "py", crs, source_crs).withColumns({"px": F.col("px") - source["c"], "py": F.col("py") - source["f"]})
    u = (source["e"] * F.col("px") - source["b"] * F.col("py")) / det - 0.5
    v = (source["a"] * F.col("py") - source["d"] * F.col("px")) / det - 0.5
    placed = at.withColumns({"u": u, "v": v}).drop("px", "py")
    return placed if crs == source_crs else materialise(placed, "targets")  # the series are worked out once, in a stage of their own


def resample_nearest(pixels: DataFrame, source: Grid, shape: DataFrame, grid: Grid, crs: str = METRIC, source_crs: str = METRIC) -> DataFrame:
    """``shape`` (raster_id, row, col) with the value and validity of the source pixel its centre lies in; codes stay as they are. ``crs`` is that of ``grid``."""
    want = _targets(shape, grid, source, crs, source_crs).withColumns({"srow": F.floor(F.col("v") + 0.5), "scol": F.floor(F.col("u") + 0.5)}).drop("u", "v")
    own = pixels.withColumnsRenamed({"row": "srow", "col": "scol"})
    return want.join(own, ["raster_id", "srow", "scol"], "left").drop("srow", "scol").withColumn("valid", F.coalesce("valid", F.lit(False)))


def resample_bilinear(pixels: DataFrame, source: Grid, shape: DataFrame, grid: Grid, crs: str = METRIC, source_crs: str = METRIC) -> DataFrame:
    """``shape`` with the value interpolated between four neighbours, weights renormalised over the valid ones; invalid where none is. ``crs`` is that of ``grid``.

    The centre of each target pixel goes through the inverse change of coordinates to rows and columns of the source; its four neighbours come by one equi-join.
    """
    want = _targets(shape, grid, source, crs, source_crs)
    corner = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (0, 1) for j in (0, 1)])).alias("n")
    near = want.select(*KEY, "u", "v", corner).select(*KEY, (F.floor("v") + F.col("n.i")).alias("srow"), (F.floor("u") + F.col("n.j")).alias("scol"),
        (F.abs(1 - F.col("n.i") - (F.col("v") - F.floor("v"))) * F.abs(1 - F.col("n.j") - (F.col("u") - F.floor("u")))).alias("w"))
    own = pixels.filter("valid").select("raster_id", F.col("row").alias("srow"), F.col("col").alias("scol"), "value")
    got = near.filter("w > 0").join(own, ["raster_id", "srow", "scol"], "left").groupBy(*KEY).agg((F.sum(F.col("w") * F.col("value")) / F.sum(F.when(F.col("value").isNotNull(), F.col("w")))).alias("value"))
    return got.withColumn("valid", F.col("value").isNotNull())


OUTLINE = 21  # points along each side of a raster by which its bounds in other coordinates are found


def warp_grid(spark: SparkSession, source: Grid, height: int, width: int, resolution: float, crs: str = METRIC, source_crs: str = "EPSG:4326") -> tuple[Grid, int, int]:
    """(grid, height, width) north-up in ``crs`` with square pixels that holds a source raster: from the bounds of points along its outline."""
    side = [F.lit(k / (OUTLINE - 1)) for k in range(OUTLINE)]
    points = [(s, e) for s in side for e in (F.lit(0.0), F.lit(1.0))] + [(e, s) for s in side for e in (F.lit(0.0), F.lit(1.0))]
    at = spark.range(1).select(F.explode(F.array(*[F.struct((u * width).alias("u"), (v * height).alias("v")) for u, v in points])).alias("p")).select("p.u", "p.v")
    x, y = (source[c] + F.col("u") * source[a] + F.col("v") * source[b] for c, a, b in (("c", "a", "b"), ("f", "d", "e")))
    box = transformed(at.select(x.alias("x"), y.alias("y")), "x", "y", source_crs, crs).agg(F.min("x").alias("x0"), F.min("y").alias("y0"), F.max("x").alias("x1"), F.max("y").alias("y1")).first()  # one row
    grid = {"a": resolution, "b": 0.0, "c": box["x0"], "d": 0.0, "e": -resolution, "f": box["y1"]}
    return grid, math.ceil((box["y1"] - box["y0"]) / resolution - 1e-9), math.ceil((box["x1"] - box["x0"]) / resolution - 1e-9)


def cells_of(spark: SparkSession, rows: range, cols: range, raster_id: int = 0) -> DataFrame:
    """(raster_id, row, col) of all cells of a window, a row of cells a row of the range."""
    each = F.explode(F.sequence(F.lit(cols.start), F.lit(cols.stop - 1))).alias("col")
    return spark.range(rows.start, rows.stop).select(F.lit(raster_id).cast("long").alias("raster_id"), F.col("id").cast("int").alias("row"), each)


def overviews(pixels: DataFrame, categorical: bool, factors: tuple[int, ...] = (2, 4, 8, 16), height: int = 100, width: int = 100) -> DataFrame:
    """(raster_id, factor, row, col, value, valid): levels whose factor fits both sides; the top-left pixel for classes, else the mean."""
    fit = [f for f in factors if f <= min(height, width)]
    each = pixels.select("raster_id", "row", "col", "value", "valid", F.explode(F.array(*map(F.lit, fit))).alias("factor"))
    place = ["raster_id", "factor", F.floor(F.col("row") / F.col("factor")).alias("orow"), F.floor(F.col("col") / F.col("factor")).alias("ocol")]
    good = F.when(F.col("valid"), F.col("value"))
    value = F.min_by(good, F.struct("row", "col")) if categorical else F.avg(good)
    out = each.groupBy(*place).agg(value.alias("value"))
    return out.select("raster_id", "factor", F.col("orow").alias("row"), F.col("ocol").alias("col"), "value", F.col("value").isNotNull().alias("valid"))


def cast_pixels(pixels: DataFrame, dtype: str) -> DataFrame:
    return pixels.withColumn("value", F.col("value").cast(dtype))


def raster_info(pixels: DataFrame, grid: Grid, crs: str = "EPSG:32648") -> DataFrame:
    """(raster_id, height, width, pixels, valid_pixels, xmin, ymin, xmax, ymax, crs)."""
    g = grid
    info = pixels.groupBy("raster_id").agg((F.max("row") + 1).alias("height"), (F.max("col") + 1).alias("width"), F.count(F.lit(1)).alias("pixels"), F.count_if("valid").alias("valid_pixels"))
    return info.withColumns({"xmin": F.lit(g["c"]), "ymin": g["f"] + F.col("height") * g["e"], "xmax": g["c"] + F.col("width") * g["a"], "ymax": F.lit(g["f"]), "crs": F.lit(crs)})


def validate_raster(pixels: DataFrame, grid: Grid, area: DataFrame, dtype: str = "double", nodata: float = -9999.0, resolution: tuple[float, float] = (1.0, 1000.0)) -> DataFrame:
    """Per raster: dtype, resolution in range, no nodata value marked valid, footprint meets the area, all of them."""
    box = area.agg(*[c.alias(n) for c, n in zip(bounds(), ("ax0", "ay0", "ax1", "ay1"), strict=True)])
    bad = pixels.groupBy("raster_id").agg(F.count_if(F.col("valid") & ((F.col("value") == nodata) | F.col("value").isNull())).alias("marked"))
    rows = raster_info(pixels, grid).join(bad, "raster_id").join(F.broadcast(box), F.lit(True))  # one row
    checks = {
        "dtype_ok": F.lit(dict(pixels.dtypes)["value"] == dtype), "resolution_ok": F.lit(resolution[0] <= grid["a"] <= resolution[1] and resolution[0] <= -grid["e"] <= resolution[1]),
        "mask_ok": F.col("marked") == 0, "footprint_ok": F.expr("xmin < ax1 AND xmax > ax0 AND ymin < ay1 AND ymax > ay0"),
    }
    out = rows.withColumns(checks)
    return out.select("raster_id", *checks, F.expr(" AND ".join(checks)).alias("passed"))


def window_of(area: DataFrame, grid: Grid) -> tuple[range, range]:
    """Rows and columns of the area's bounds, snapped outward."""
    _north_up(grid)
    box = area.agg(*bounds()).first()  # one row
    if box["xmin"] is None:
        raise ValueError("an area without edges")
    return (range(math.floor((box["ymax"] - grid["f"]) / grid["e"]), math.ceil((box["ymin"] - grid["f"]) / grid["e"])),
            range(math.floor((box["xmin"] - grid["c"]) / grid["a"]), math.ceil((box["xmax"] - grid["c"]) / grid["a"])))


def mosaic_clip(tiles: DataFrame, area: DataFrame, grid: Grid, nodata: float = -9999.0, target: Grid | None = None, crs: str = METRIC, source_crs: str = METRIC, resolution: tuple[float, float] = (1.0, 1000.0)) -> tuple[DataFrame, Grid]:
    """Mosaic of all tiles, brought to the ``target`` grid if one is given, cut to the area and validated. The area is in ``crs``, that of the target; no tiles, or a result that isn't valid, is an error.

    Only the cells of the area's window are made, and only the source pixels next to them are read.
    """
    if tiles.isEmpty():
        raise ValueError("no tiles to mosaic")
    whole = mosaic(tiles).withColumn("raster_id", F.lit(0).cast("long")).select(*KEY, "value", "valid")
    if target is None and crs != source_crs:
        raise ValueError("another coordinate system needs a target grid")
    if target is not None:
        whole, grid = resample_bilinear(whole, grid, cells_of(tiles.sparkSession, *window_of(area, target)), target, crs, source_crs), target
    out, place = clip_pixels(whole, area, grid, nodata)
    out = materialise(out, "mosaic")
    passed = validate_raster(out, place, area, nodata=nodata, resolution=resolution).select("passed").collect()  # one raster
    if not passed or not all(r["passed"] for r in passed):
        raise ValueError("the mosaic isn't a valid raster of the area")
    return out, place


def read_blocks(blocks: DataFrame, side: int = 512, nodata: float | None = None) -> DataFrame:
    """Pixels of block storage (raster_id, tile_row, tile_col, values array): values are row by row; null and nodata are invalid."""
    each = blocks.select("raster_id", "tile_row", "tile_col", F.posexplode("values").alias("at", "value"))
    valid = F.col("value").isNotNull() & ((F.col("value") != nodata) if nodata is not None else F.lit(True))
    return each.select("raster_id", (F.col("tile_row") * side + F.floor(F.col("at") / side)).cast("int").alias("row"), (F.col("tile_col") * side + F.col("at") % side).cast("int").alias("col"), "value", valid.alias("valid"))


def share(part: Column, whole: Column, empty: float | None = 0.0) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(empty))
