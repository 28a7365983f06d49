"""Reading and writing layers, pixels, indexes, events, files and reports with Spark's own readers and writers."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import catalog, geometry, raster
from . import digests

#: Columns of event rows by their meaning, and file signatures.
EVENT_COLUMNS = {
    "STT": "source_row_number",
    "Năm": "event_year",
    "Huyện/Khu vực huyện": "original_district_text",
    "Xã/Địa điểm cụ thể": "original_place_text",
    "Ngày xảy ra": "original_date_text",
    "Thời gian/Giờ xảy ra": "original_time_text",
    "Loại sự kiện": "event_type",
    "Mô tả ngắn": "description",
    "Nguồn tin": "source_name",
    "Link minh chứng": "evidence_url",
    "Ghi chú": "notes",
}
SIGNATURES = {"shapefile": ["0000270A"], "tiff": ["49492A00", "49492B00", "4D4D002A", "4D4D002B"], "zip": ["504B0304", "504B0506"], "gzip": ["1F8B"], "pdf": ["25504446"]}
EXCLUDED = r"^(raw|harmonized|derived|catalog|qa)/|^Data/venv/|\.partial(/|$)"
WHOLE_FILE_LIMIT = 2_000_000_000
POINT = "array<double>"


def read_geojson_layer(spark: SparkSession, path: str, id_col: str, single: bool = False) -> DataFrame:
    """Edge-ready rows (id, properties, geom_type, rings, shells) of FeatureCollections; with ``single`` each file must hold exactly one feature.

    ``rings`` are the rings of polygons, the parts of lines, or a point; ``shells`` numbers the polygon that each ring belongs to. ``polygon_edges`` and ``line_segments`` make tables of them. Files are read
    whole, so a file bounds a task; layers come as many files.
    """
    text = spark.read.text(path, wholetext=True).withColumn("file", F.input_file_name())
    root = "features array<struct<properties: map<string,string>, geometry: struct<type: string, coordinates: string>>>"
    each = text.select("file", F.from_json("value", root).alias("r")).select("file", "r.features")
    if single and not (bad := each.filter((F.size("features") != 1) | F.col("features").isNull())).isEmpty():
        raise ValueError(f"not exactly one feature: {bad.first()['file']}")
    rows = each.select(F.explode("features").alias("f")).select(F.col("f.properties").getItem(id_col).alias(id_col), F.col("f.properties").alias("properties"), F.col("f.geometry.type").alias("geom_type"), F.col("f.geometry.coordinates").alias("c"))
    ring = lambda depth: F.from_json("c", "array<" * (depth - 1) + POINT + ">" * (depth - 1))
    as_points = lambda pts: F.transform(pts, lambda p: F.struct(p[0].alias("x"), p[1].alias("y")))
    rings = F.when(F.col("geom_type") == "Polygon", F.transform(ring(3), as_points)).when(F.col("geom_type") == "MultiPolygon", F.transform(F.flatten(ring(4)), as_points))
    rings = rings.when(F.col("geom_type") == "LineString", F.array(as_points(ring(2)))).when(F.col("geom_type") == "MultiLineString", F.transform(ring(3), as_points)).when(F.col("geom_type") == "Point", F.array(F.array(F.struct(F.from_json("c", POINT)[0].alias("x"), F.from_json("c", POINT)[1].alias("y")))))
    shells = F.when(F.col("geom_type") == "Polygon", F.transform(ring(3), lambda _: F.lit(0)))
    shells = shells.when(F.col("geom_type") == "MultiPolygon", F.flatten(F.transform(ring(4), lambda polygon, i: F.transform(polygon, lambda _: i))))
    return rows.select(id_col, "properties", "geom_type", rings.alias("rings"), shells.alias("shells"))


def polygon_edges(rows: DataFrame, key: str, evidence: bool = False) -> DataFrame:
    """The edge table of the polygons among ``rows`` of ``read_geojson_layer``."""
    return geometry.edges_from_rings(rows.filter(F.col("geom_type").isin("Polygon", "MultiPolygon")), key, "rings", "shells", evidence)


def line_segments(rows: DataFrame, key: str) -> DataFrame:
    """The segments of the lines among ``rows`` of ``read_geojson_layer``."""
    return geometry.edges_from_lines(rows.filter(F.col("geom_type").isin("LineString", "MultiLineString")), key, "rings")


def read_layer(spark: SparkSession, path: str, required: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    if missing := sorted(set(required or []) - set(df.columns)):
        raise ValueError(f"layer lacks columns: {', '.join(missing)}")
    return df


TILE_LIST = 10_000  # tiles that are named one by one in a filter of partitions; beyond that their bounds are


def write_blocks(pixels: DataFrame, path: str, side: int = 512) -> None:
    """Store pixels (raster_id, row, col, value, valid) as blocks of ``side`` x ``side`` values, a partition of folders for each row and column of tiles."""
    at = (F.col("row") % side * side + F.col("col") % side).cast("int")
    cells = pixels.filter("valid").select("raster_id", F.floor(F.col("row") / side).cast("int").alias("tile_row"), F.floor(F.col("col") / side).cast("int").alias("tile_col"), at.alias("at"), "value")
    tiles = cells.groupBy("raster_id", "tile_row", "tile_col").agg(F.map_from_entries(F.collect_list(F.struct("at", "value"))).alias("cells"))
    values = F.transform(F.sequence(F.lit(0), F.lit(side * side - 1)), lambda i: F.col("cells")[i])
    blocks = tiles.select("raster_id", values.alias("values"), "tile_row", "tile_col")
    published(pixels.sparkSession, path, blocks.repartition("tile_row", "tile_col").write.partitionBy("tile_row", "tile_col").parquet)


def read_pixels(spark: SparkSession, path: str, raster_id: int | None = None, side: int = 512, nodata: float | None = None, zones: DataFrame | None = None, grid: dict[str, float] | None = None) -> DataFrame:
    """Pixels of stored blocks; the raster and the tiles are pruned before blocks are exploded.

    With ``zones`` and the ``grid`` only pixels in the tiles that the zones' windows meet are read: where blocks are stored by ``write_blocks`` these tiles are a filter of partitions, so the files of others aren't opened.
    """
    blocks = spark.read.parquet(path)
    if raster_id is not None:
        blocks = blocks.filter(F.col("raster_id") == raster_id)
    if zones is not None:
        tiles = raster.window_tiles(zones, grid, side)
        named = tiles.limit(TILE_LIST + 1).collect()
        if len(named) <= TILE_LIST:
            columns: dict[int, list[int]] = {}
            for r in named:
                columns.setdefault(r["tile_row"], []).append(r["tile_col"])
            wanted = F.lit(False)
            for cols in {tuple(sorted(c)) for c in columns.values()}:
                rows = [r for r, c in columns.items() if tuple(sorted(c)) == cols]
                wanted = wanted | (F.col("tile_row").isin(*rows) & F.col("tile_col").isin(*cols))
            blocks = blocks.filter(wanted)
        else:
            box = tiles.agg(*[f(c).alias(f"{n}_{c}") for c in ("tile_row", "tile_col") for n, f in (("min", F.min), ("max", F.max))]).first()
            near = [F.col(c).between(box[f"min_{c}"], box[f"max_{c}"]) for c in ("tile_row", "tile_col")]
            blocks = blocks.filter(near[0] & near[1]).join(tiles, ["tile_row", "tile_col"], "left_semi")
    return raster.read_blocks(blocks, side, nodata)


def read_unit_index(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(aliases, conflicts) of JSON files: a list, or an object with the list under data, items, rows or result."""
    item = "array<struct<magoc: string, ma: string, malk: string>>"
    text = spark.read.text(path, wholetext=True)
    lists = F.when(F.col("value").rlike(r"^\s*\["), F.from_json("value", item)).otherwise(F.coalesce(*[F.from_json("value", f"{k} {item}")[k] for k in ("data", "items", "rows", "result")]))
    from ..operators.admin import unit_aliases

    return unit_aliases(text.select(F.explode(lists).alias("u")).select("u.*"))


def read_event_rows(rows: DataFrame, columns: dict[str, str] | None = None) -> DataFrame:
    """Numbered rows only, columns renamed, with event_id ``historical-flood:<n>``, event_date_start and event_date_end."""
    names = EVENT_COLUMNS if columns is None else columns
    out = rows.select(*[F.col(f"`{a}`").alias(b) for a, b in names.items() if a in rows.columns])
    out = out.withColumn("source_row_number", T.integral_or_null(F.col("source_row_number").try_cast("double"))).filter("source_row_number IS NOT NULL")
    start, end = T.parse_event_dates(F.col("original_date_text"))
    return out.withColumns({"event_id": F.concat(F.lit("historical-flood:"), F.col("source_row_number").cast("string")), "event_date_start": start, "event_date_end": end})


def scan_assets(spark: SparkSession, root: str, glob: str = "*", content: bool = True) -> DataFrame:
    """(path, size_bytes, modified, checksum, head) of files below a folder, outputs and partial files left out.

    Files above ``digests.ONE_TASK`` are digested in pieces when this is called. Where that can't be (compressed or hidden by name), contents above the size a binary row may hold are not read; their checksum is null.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(root)
    inner = F.substring_index("path", root.split(":", 1)[-1].rstrip("/") + "/", -1)
    files = files.filter(~inner.rlike(EXCLUDED))
    base = [F.col("path"), F.col("length").alias("size_bytes"), F.col("modificationTime").alias("modified")]
    unread = [F.lit(None).cast("string").alias("checksum"), F.lit(None).cast("string").alias("head")]
    if not content:
        return files.select(*base, *unread)
    read = [F.sha2("content", 256).alias("checksum"), F.hex(F.substring("content", 1, 4)).alias("head")]
    small, large = files.filter(F.col("length") <= digests.ONE_TASK).select(*base, *read), files.filter(F.col("length") > digests.ONE_TASK).select(*base)
    sizes = {r["path"]: r["size_bytes"] for r in large.collect()}  # few: each stands for ONE_TASK bytes
    pieced = digests.file_digests(spark, [f for f in sizes.items() if digests.resumable() and digests.in_pieces(spark, f[0])])
    rest = sizes.keys() - {p for p, *_ in pieced}
    found = large.join(F.broadcast(spark.createDataFrame(pieced, "path string, checksum string, head string")), "path").select("path", "size_bytes", "modified", "checksum", "head")
    if whole := sorted(p for p in rest if sizes[p] <= WHOLE_FILE_LIMIT):
        found = found.unionByName(spark.read.format("binaryFile").load([digests.literal(p) for p in whole]).select(*base, *read))
    if over := sorted(rest - set(whole)):
        found = found.unionByName(large.filter(F.col("path").isin(over)).select("*", *unread))
    return small.unionByName(found)


def check_signatures(assets: DataFrame) -> DataFrame:
    """Add ``format`` by the first bytes, or null."""
    kind = F.lit(None).cast("string")
    for name, heads in SIGNATURES.items():
        for h in heads:
            kind = F.when(F.col("head").startswith(h), name).otherwise(kind)
    return assets.withColumn("format", kind)


def write_table(df: DataFrame, path: str, keys: list[str]) -> None:
    """Publish only a complete table, ranged and sorted by key."""
    published(df.sparkSession, path, lambda staging: df.repartitionByRange(*keys).sortWithinPartitions(*keys).write.parquet(staging))


def published(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """What ``write`` writes into a folder it is given: beside the target first, then moved to its place.

    What was there before is moved aside until the new one stands, and back if that fails; ``recovered`` does so after a crash in between.
    """
    staging, previous = f"{path.rstrip('/')}.staging-{uuid.uuid4().hex}", f"{path.rstrip('/')}.previous"
    write(staging)
    recovered(spark, path)
    fs, target, made, old = _paths(spark, path, staging, previous)
    replaced = fs.exists(target)
    if replaced and not fs.rename(target, old):
        raise OSError(f"{path} could not be moved aside")
    if not fs.rename(made, target):
        if replaced:
            fs.rename(old, target)
        raise OSError(f"{staging} could not be moved to {path}")
    fs.delete(old, True)


def recovered(spark: SparkSession, path: str) -> str:
    """``path``, after putting the last complete table back there if a publication was cut short."""
    fs, target, old = _paths(spark, path, f"{path.rstrip('/')}.previous")
    if fs.exists(old):
        if fs.exists(target):
            fs.delete(old, True)
        elif not fs.rename(old, target):
            raise OSError(f"{path} could not be put back")
    return path


def _paths(spark: SparkSession, *paths: str) -> tuple:
    """The file system of ``paths`` and each of them as its kind of path."""
    made = [spark._jvm.org.apache.hadoop.fs.Path(p) for p in paths]
    return made[0].getFileSystem(spark._jsc.hadoopConfiguration()), *made


def write_layer(edges: DataFrame, path: str, to_geographic: bool = True) -> None:
    """Publish a layer in geographic coordinates; the given one stays as it is."""
    from ..functions.crs import utm_to_geographic

    df = edges
    if to_geographic:
        a, b = utm_to_geographic(F.col("x1"), F.col("y1")), utm_to_geographic(F.col("x2"), F.col("y2"))
        df = edges.withColumns({"x1": a[0], "y1": a[1], "x2": b[0], "y2": b[1]})
    write_table(df, path, ["feature_id"])


def geojson_lines(edges: DataFrame, properties: DataFrame) -> DataFrame:
    """(value) one GeoJSON feature a line, sorted by id: rings from edges in order."""
    ring = F.transform(F.array_sort(F.collect_list(F.struct("seq", "x1", "y1"))), lambda p: F.array(p["x1"], p["y1"]))
    rings = edges.groupBy("feature_id", "part", "ring").agg(ring.alias("pts")).withColumn("pts", F.concat("pts", F.slice("pts", 1, 1)))
    shape = rings.groupBy("feature_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("part", "ring", "pts"))), lambda r: r["pts"]).alias("coordinates"))
    names = sorted(c for c in properties.columns if c != "feature_id")
    feature = F.struct(F.lit("Feature").alias("type"), F.struct("feature_id", *names).alias("properties"), F.struct(F.lit("Polygon").alias("type"), "coordinates").alias("geometry"))
    return shape.join(properties, "feature_id").orderBy("feature_id").select(F.to_json(feature).alias("value"))


def write_geojson(edges: DataFrame, properties: DataFrame, path: str) -> None:
    published(edges.sparkSession, path, geojson_lines(edges, properties).write.text)


def report_rows(checks: DataFrame) -> DataFrame:
    """Check rows with every text column redacted."""
    return checks.select(*[T.redact(F.col(c)).alias(c) if t == "string" else F.transform(c, T.redact).alias(c) if t == "array<string>" else F.col(c) for c, t in checks.dtypes])


def write_report(checks: DataFrame, path: str) -> None:
    """JSON and Parquet, redacted, sorted by check_id; both or neither are published."""
    rows = report_rows(checks).orderBy("check_id")

    def write(staging: str) -> None:
        rows.write.json(f"{staging}/json")
        rows.write.parquet(f"{staging}/parquet")

    published(checks.sparkSession, path, write)


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(recovered(spark, path))


def write_catalog(catalog_rows: DataFrame, path: str, key: str = "asset_id") -> None:
    """Replace the catalog by a complete table; repeated ids are an error."""
    if not catalog.check_ids(catalog_rows, key).isEmpty():
        raise ValueError(f"catalog: repeated or empty {key}")
    write_table(catalog_rows, path, [key])
