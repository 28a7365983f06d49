"""Quality gates: each gives check rows; all run, even after a fatal one.

Check rows: check_id, passed, severity (fatal, warning, info), expected, actual, message, asset_ids.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import materialise
from . import admin, catalog, geometry, zonal

CHECK = "check_id string, passed boolean, severity string, expected string, actual string, message string, asset_ids array<string>"


def checks_of(one_row: DataFrame, checks: dict[str, tuple[Column, str, Column, Column]], message: str = "") -> DataFrame:
    """Check rows from one row of measures: id -> (passed, severity, expected, actual)."""
    each = [F.struct(F.lit(i).alias("check_id"), F.coalesce(p, F.lit(False)).alias("passed"), F.lit(s).alias("severity"), e.cast("string").alias("expected"), a.cast("string").alias("actual"), F.lit(message).alias("message"), F.array().cast("array<string>").alias("asset_ids")) for i, (p, s, e, a) in checks.items()]
    return one_row.select(F.inline(F.array(*each)))


def no_rows(violations: DataFrame, check_id: str, severity: str = "fatal", message: str = "") -> DataFrame:
    """One check row: no violation."""
    return checks_of(violations.agg(F.count(F.lit(1)).alias("n")), {check_id: (F.col("n") == 0, severity, F.lit(0), F.col("n"))}, message)


def breaks(rows: DataFrame, rule: str) -> DataFrame:
    """The rows for which ``rule`` doesn't hold; where a null leaves it open, it doesn't."""
    return rows.filter(~F.coalesce(F.expr(rule), F.lit(False)))


def union(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def gate_units(units: DataFrame, edges: DataFrame, reference: DataFrame, legal: DataFrame, expected: tuple[int, int, int], gap_limit: float = 0.1, area_limit: float = 2.0, exceptions: tuple[str, ...] = (), cell: float = geometry.CELL) -> DataFrame:
    """Counts, validity, repairs (a column ``repaired``, where there is one), gap and overlap, and areas of units (feature_id, code, name). A unit without valid geometry or legal area fails."""
    total, communes, wards = expected
    c = admin.unit_counts(units)
    counts = checks_of(c, {"units.total": (F.col("total") == total, "fatal", F.lit(total), F.col("total")), "units.communes": (F.col("communes") == communes, "fatal", F.lit(communes), F.col("communes")), "units.wards": (F.col("wards") == wards, "fatal", F.lit(wards), F.col("wards")), "units.unique_codes": (F.col("unique_codes") == F.col("total"), "fatal", F.col("total"), F.col("unique_codes"))})
    sound = geometry.flag_invalid_geometry(edges, cell).filter("valid").select("feature_id")
    invalid = no_rows(units.select("feature_id").join(sound, "feature_id", "left_anti"), "units.geometry_valid")
    repaired = no_rows(units.filter("repaired"), "units.geometry_repairs", "warning") if "repaired" in units.columns else no_rows(units.limit(0), "units.geometry_repairs", "warning")
    g = checks_of(geometry.gap_overlap(edges, reference, cell), {"units.gap": (F.col("gap_percent") <= gap_limit, "fatal", F.lit(gap_limit), F.round("gap_percent", 6)), "units.overlap": (F.col("overlap_percent") <= gap_limit, "fatal", F.lit(gap_limit), F.round("overlap_percent", 6))})
    diff = breaks(units.select("feature_id", "code").join(geometry.area_difference(edges, legal, area_limit), "feature_id", "left"), "NOT exceeds")
    listed = F.coalesce(F.col("code").isin(*exceptions), F.lit(False)) if exceptions else F.lit(False)
    return union(counts, invalid, repaired, g, no_rows(diff.filter(~listed), "units.area_difference"), no_rows(diff.filter(listed), "units.area_exceptions", "warning"))


def gate_hierarchy(basins: DataFrame, parents: DataFrame, exits: DataFrame | None = None) -> DataFrame:
    """Unique ids, one parent for each basin, code prefixes; ends outside the selection, and basins that name none downstream, are declared (fatal if not) and warned of."""
    of = basins.select("basin_id").join(parents.select("basin_id", "parent_id", "covering", "code_ok"), "basin_id", "left")
    out = [no_rows(catalog.check_ids(basins, "basin_id"), "hierarchy.unique_ids"), no_rows(breaks(of, "covering = 1 AND parent_id IS NOT NULL"), "hierarchy.one_parent"), no_rows(breaks(of.filter("parent_id IS NOT NULL"), "code_ok"), "hierarchy.code_prefix")]
    leaving = admin.scope_exits(basins).filter("scope_exit").select("basin_id")
    declared = exits.select("basin_id") if exits is not None else leaving.limit(0)
    return union(*out, no_rows(leaving.join(declared, "basin_id", "left_anti"), "hierarchy.topology"), no_rows(leaving, "hierarchy.scope_exits", "warning"))


#: The seven mapping products, their entity keys and the columns each must have.
EVIDENCE = ("quality_flags_json", "source_asset_ids_json")
PRODUCTS: dict[str, tuple[tuple[str, ...], tuple[str, ...]]] = {
    "commune": (("current_commune_code",), ("intersection_area_km2", "basin_fraction", "commune_fraction", "processing_crs", *EVIDENCE)),
    "river": (("HYRIV_ID",), ("intersected_length_km", "boundary_case", "processing_crs", *EVIDENCE)),
    "road": (("segment_id", "osm_id"), ("intersected_length_km", "boundary_case", "processing_crs", *EVIDENCE)),
    "bridge": (("osm_id",), ("intersected_length_km", "relationship_geometry_wkt", "boundary_case", "processing_crs", *EVIDENCE)),
    "facility": (("osm_id",), ("relationship_type", "tags_json", "boundary_case", "processing_crs", *EVIDENCE)),
    "settlement": (("osm_id",), ("relationship_type", "tags_json", "boundary_case", "processing_crs", *EVIDENCE)),
    "population": ((), ("population_scope", "population_sum", "population_mean", "contributing_pixel_count", "nodata_pixel_count", "aoi_pixel_count", "coverage_ratio", "source_resolution_x", "source_resolution_y", "source_resolution_unit", "source_crs", "boundary_center_tie_pixel_count", *EVIDENCE)),
}


def gate_mappings(mappings: dict[str, DataFrame], entities: dict[str, DataFrame], zones: DataFrame, units: DataFrame, zone: str = "HYBAS_ID", products: dict[str, tuple[tuple[str, ...], tuple[str, ...]]] | None = None, unit: tuple[str, str, str] = ("commune", "current_commune_code", "commune_fraction"), limits: tuple[float, float] = (0.995, 1.005)) -> DataFrame:
    """Each of the seven mappings is there with its columns; its keys, zones and entities alike, are neither null nor blank and exist on the other side;
    every unit of ``units`` is covered within ``limits``; boundary cases warned of.
    """
    out, boundary = [], []
    present = lambda name, what, ok: checks_of(zones.agg(F.count(F.lit(1)).alias("n")), {f"mapping.{name}.{what}": (F.lit(ok), "fatal", F.lit("present"), F.lit("present" if ok else "missing"))})
    for name, (keys, columns) in (PRODUCTS if products is None else products).items():
        df, entity = mappings.get(name), entities.get(name)
        missing = sorted({zone, *keys, *columns} - set(df.columns)) if df is not None else ["the table"]
        out.append(checks_of(zones.agg(F.count(F.lit(1)).alias("n")), {f"mapping.{name}.columns": (F.lit(not missing), "fatal", F.lit(",".join((zone, *keys, *columns))), F.lit(",".join(missing)))}))
        if df is None:
            continue
        read = {zone, *keys, "boundary_case", *(unit[1:] if name == unit[0] else ())}
        df = materialise(df.select(*[c for c in df.columns if c in read]), "mapping")  # every check reads it
        for key, other in [(zone, zones), *((k, entity) for k in keys)]:
            if other is None or key not in other.columns or key not in df.columns:
                out.append(present(name, f"keys.{key}", False))
                continue
            blank = df.filter(F.col(key).isNull() | (F.trim(F.col(key).cast("string")) == "")).select(F.lit(None).cast("string").alias("key"))
            lost = catalog.anti_keys(df.filter(F.col(key).isNotNull()), other, key).select(F.col(key).cast("string").alias("key"))
            out.append(no_rows(blank.unionByName(lost), f"mapping.{name}.keys.{key}"))
        if "boundary_case" in df.columns:
            boundary.append(df.filter("boundary_case").select(F.lit(name).alias("name")))
        if name == unit[0] and not {unit[1], unit[2]} - set(df.columns):
            totals = fraction_totals(df, units, unit[1], unit[2])
            out.append(no_rows(totals.filter(F.col("total").isNull() | ~F.col("total").between(*limits)), f"mapping.{name}.coverage"))
    if unit[0] not in mappings:
        out.append(present(unit[0], "coverage", False))
    return union(*out, no_rows(union(*boundary), "mapping.boundary_cases", "warning") if boundary else present("boundary", "cases", True))


def fraction_totals(mapping: DataFrame, units: DataFrame, key: str, fraction: str = "unit_fraction") -> DataFrame:
    """(key, total): sum of fractions of every unit, 0.0 where none is mapped."""
    return units.select(key).distinct().join(mapping.groupBy(key).agg(F.sum(fraction).alias("total")), key, "left").fillna(0.0, ["total"])


def soil_layers(pixels: DataFrame, area: DataFrame, grid: dict[str, float], cube: tuple[list[str], list[str], list[str]], least: float = 0.99) -> DataFrame:
    """Two check rows for every layer of the soil cube (properties, depths, statistics): its coverage of the area, and nodata, warned of; in one pass over ``pixels``.

    A layer that is missing covers nothing; one that isn't expected fails as well.
    """
    key = ["property", "depth", "statistic"]
    seen = zonal.join_pixels_zones(pixels, area, grid).select(*key, "raster_id", "row", "col", "valid").distinct()
    have = pixels.select(*key).distinct().join(seen.groupBy(*key).agg(F.count(F.lit(1)).alias("in_area"), F.count_if("valid").alias("valid")), key, "left").withColumn("have", F.lit(True))
    both = zonal.cube_of(pixels.sparkSession, *cube).withColumn("want", F.lit(True)).join(have, key, "full_outer").fillna(0, ["in_area", "valid"])
    ratio = zonal.share(F.col("valid"), F.col("in_area"))
    name = F.concat_ws(".", F.lit("raster.soil"), *key)
    actual = F.when(F.col("want").isNull(), "unexpected").when(F.col("have").isNull(), "missing").otherwise(F.round(ratio, 6).cast("string"))
    holes = F.col("in_area") - F.col("valid")
    rows = [
        (F.concat(name, F.lit(".coverage")), F.coalesce(F.col("want") & (ratio >= least), F.lit(False)), "fatal", F.lit(str(least)), actual),
        (F.concat(name, F.lit(".nodata")), holes == 0, "warning", F.lit("0"), holes.cast("string")),
    ]
    each = [F.struct(i.alias("check_id"), p.alias("passed"), F.lit(w).alias("severity"), e.alias("expected"), a.alias("actual"), F.lit("").alias("message"), F.array().cast("array<string>").alias("asset_ids")) for i, p, w, e, a in rows]
    return both.select(F.inline(F.array(*each)))


def gate_rasters(rasters: dict[str, tuple[DataFrame | None, DataFrame | None, dict[str, float], bool]], least: float = 0.99, cube: DataFrame | None = None, soil: DataFrame | None = None) -> DataFrame:
    """Per required raster, name -> (pixels, area, grid, by footprint): share of its area covered, nodata warned of; no problem of the soil cube; the rows of ``soil_layers``.

    The area is that of the raster's use. Coverage is the valid share of the pixels in the area or, ``by footprint``, the share of the area within the raster's box. Without
    pixels or area the raster is missing, which is fatal. Of a table of several rasters each one counts.
    """
    out = []
    for name, (pixels, area, grid, footprint) in rasters.items():
        if pixels is None or area is None:
            spark = next(df for r in rasters.values() for df in r[:2] if df is not None).sparkSession
            out.append(spark.createDataFrame([(f"raster.{name}.coverage", False, "fatal", str(least), "missing", "", [])], CHECK))
            continue
        c = zonal.coverage_ratio(pixels, area, grid).select("coverage", "valid", "in_area")
        one = c.agg(F.coalesce(F.min("coverage"), F.lit(0.0)).alias("ratio"), F.coalesce(F.count_if(F.col("valid") < F.col("in_area")), F.lit(0)).alias("holes"))
        if footprint:
            seen = pixels.agg(F.min("row").alias("r0"), F.max("row").alias("r1"), F.min("col").alias("c0"), F.max("col").alias("c1")).first()  # one row
            box = (0.0, 0.0, 0.0, 0.0) if seen["r0"] is None else (grid["c"] + seen["c0"] * grid["a"], grid["f"] + (seen["r1"] + 1) * grid["e"], grid["c"] + (seen["c1"] + 1) * grid["a"], grid["f"] + seen["r0"] * grid["e"])
            own = geometry.measure(area).join(geometry.footprint_ratio(box, area), "feature_id").agg((F.sum(F.col("area") * F.col("ratio")) / F.sum("area")).alias("ratio"))
            one = own.select(F.coalesce("ratio", F.lit(0.0)).alias("ratio")).join(F.broadcast(one.select("holes")), F.lit(True))  # single rows
        out.append(checks_of(one, {f"raster.{name}.coverage": (F.col("ratio") >= least, "fatal", F.lit(least), F.round("ratio", 6)), f"raster.{name}.nodata": (F.col("holes") == 0, "warning", F.lit(0), F.col("holes"))}))
    return union(*out, *([no_rows(cube, "raster.soil_cube")] if cube is not None else []), *([soil] if soil is not None else []))


COUNTS = ("contributing", "nodata_pixels", "aoi_pixels", "ties")


def gate_population(table: DataFrame, pixels: DataFrame, zones: DataFrame, core: DataFrame, grid: dict[str, float], by: tuple[str, ...] = ()) -> DataFrame:
    """Scope, counts that add up, ratio recomputed, zones complete (per raster, if ``by`` names it), an independent recount of pixels, ties warned of."""
    key = [*by, "zone_id"]
    ids = zones.select(F.col("feature_id").alias("zone_id")).distinct()
    won = zonal.assign_pixels(pixels, zones, core, grid).groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.count_if("valid").alias("v"))
    recount = table.select(*key, "aoi_pixels", "contributing").join(won, key, "full_outer").filter("coalesce(aoi_pixels, 0) != coalesce(n, 0) OR coalesce(contributing, 0) != coalesce(v, 0)")
    each = table.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("zone_id").alias("zones"))
    short = each.join(F.broadcast(ids.agg(F.count(F.lit(1)).alias("wanted"))), F.lit(True)).filter("zones != wanted OR rows != wanted").select(F.lit("raster").alias("side"))  # a single row
    zones_ok = catalog.key_difference(table, ids, "zone_id").select("side").unionByName(short)
    return union(
        no_rows(breaks(table, "scope = 'core_aoi_only'"), "population.scope"), no_rows(breaks(table, f"{' AND '.join(f'{c} >= 0 AND {c} = floor({c})' for c in COUNTS)} AND contributing + nodata_pixels = aoi_pixels"), "population.counts"),
        no_rows(breaks(table, "CASE WHEN aoi_pixels = 0 THEN coverage IS NULL ELSE abs(coverage - contributing / aoi_pixels) <= 1e-9 END"), "population.coverage"), no_rows(zones_ok, "population.zones"),
        no_rows(recount, "population.recount"), no_rows(breaks(table, "ties = 0"), "population.ties", "warning"))


def gate_events(events: DataFrame, expected: int) -> DataFrame:
    """Expected rows, legal status, confidence in [0, 1]; unresolved ones warned of."""
    n = events.agg(F.count(F.lit(1)).alias("n"))
    return union(
        checks_of(n, {"events.rows": (F.col("n") == expected, "fatal", F.lit(expected), F.col("n"))}), no_rows(breaks(events, "match_status IN ('matched', 'ambiguous', 'unresolved')"), "events.status"),
        no_rows(breaks(events, "match_confidence BETWEEN 0 AND 1 AND NOT isnan(match_confidence)"), "events.confidence"), no_rows(events.filter("match_status = 'unresolved'"), "events.unresolved", "warning"))


def gate_provenance(assets: DataFrame, closure: DataFrame, cap: int, fields: tuple[str, ...] = ("source", "version", "checksum", "path")) -> DataFrame:
    """Lineage resolved; of the raw assets that it uses: one at least, each of kind raw (if there is that column) with all ``fields``, and their bytes, known and each content once, within the cap.

    ``closure`` is ``lineage_closure`` or, as far less work, ``lineage_evidence``.
    """
    closure = materialise(closure, "closure")
    named = [c for c in assets.columns if c in {"asset_id", "kind", "checksum", "size_bytes", *fields}]
    used = assets.select(*named).join(closure.filter("state = 'raw'").select(F.col("node_id").alias("asset_id")).distinct(), "asset_id", "left_semi")
    used = materialise(used, "used")
    wrong = catalog.provenance_gaps(used, fields).select("asset_id")
    if "kind" in assets.columns:
        wrong = wrong.unionByName(breaks(used, "kind = 'raw'").select("asset_id")).distinct()
    once = used.groupBy(F.coalesce("checksum", F.concat(F.lit("asset "), F.col("asset_id").cast("string")))).agg(F.max("size_bytes").alias("size_bytes"))
    size = once.agg(F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("n"), F.count_if(F.col("size_bytes").isNull()).alias("unknown"), F.count(F.lit(1)).alias("used"))
    checks = {"provenance.used": (F.col("used") > 0, "fatal", F.lit("above 0"), F.col("used")), "provenance.bytes": ((F.col("n") <= cap) & (F.col("unknown") == 0), "fatal", F.lit(cap), F.col("n"))}
    return union(no_rows(wrong, "provenance.fields"), no_rows(breaks(closure, "state IN ('raw', 'inner')"), "provenance.lineage"), checks_of(size, checks))


def run_gates(spark: SparkSession, gates: dict[str, Callable[[], DataFrame]], config: str = "") -> DataFrame:
    """All check rows sorted by id, with ``report_id``, the hash of the configuration and the rows.

    Each gate's rows are written to the shared folder, so one that fails, when planned or when run, is one fatal row and the others stand.
    """
    out = spark.createDataFrame([], CHECK)
    for name, gate in gates.items():
        try:
            part = materialise(gate(), "gate")
        except Exception as e:  # noqa: BLE001  a failing gate is a finding
            part = spark.createDataFrame([(f"gate.{name}", False, "fatal", "runs", type(e).__name__, str(e)[:500], [])], CHECK)
        out = out.unionByName(part)
    return out.withColumn("report_id", F.lit(report_id(out, config))).orderBy("check_id")


def report_id(checks: DataFrame, config: str) -> str:
    """sha256 over the configuration and the sorted check rows, of which there are as many as checks."""
    rows = F.array_join(F.array_sort(F.collect_list(F.to_json(F.struct("check_id", "passed", "severity", "expected", "actual")))), "\n")
    return checks.agg(F.sha2(F.concat_ws("\n", F.lit(config), rows), 256)).first()[0]


def severity_rollup(checks: DataFrame) -> DataFrame:
    return checks.groupBy("severity").agg(F.count(F.lit(1)).alias("checks"), F.count_if(~F.col("passed")).alias("failed"))
