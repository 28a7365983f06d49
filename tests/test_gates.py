"""Gates over missing evidence, zones without pixels, values that are no numbers, upstream selection."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tests.test_geometry import box_layer, line_layer
from tributary.operators import admin, catalog, gates, geometry, raster, zonal

GRID = {"a": 10.0, "b": 0.0, "c": 0.0, "d": 0.0, "e": -10.0, "f": 100.0}


def failed(checks):
    return {r.check_id for r in checks.collect() if not r.passed}


def test_events(spark):
    rows = lambda *r: spark.createDataFrame(list(r), "match_status string, match_confidence double")
    assert failed(gates.gate_events(rows(("matched", 1.0), ("ambiguous", 0.5)), 2)) == set()
    bad = [(None, 0.5), ("odd", 0.5), ("matched", None), ("matched", 1.5), ("matched", float("nan")), ("unresolved", 0.0)]
    got = [failed(gates.gate_events(rows(r), 1)) for r in bad]
    assert got == [{"events.status"}, {"events.status"}, *[{"events.confidence"}] * 3, {"events.unresolved"}]


def test_hierarchy(spark):
    basins = spark.createDataFrame([(1, 0), (2, 1), (3, None), (4, 9)], "basin_id long, next_down long")
    parents = spark.createDataFrame([(1, 10, 1, True), (2, 10, 1, True), (3, 10, 1, True), (4, 10, 1, True)], "basin_id long, parent_id long, covering long, code_ok boolean")
    rows = {r.check_id: r for r in gates.gate_hierarchy(basins, parents).collect()}
    assert rows["hierarchy.topology"].actual == "2" and rows["hierarchy.one_parent"].passed  # a basin that names none downstream, and one that names another's
    assert failed(gates.gate_hierarchy(basins, parents, basins.filter("basin_id IN (3, 4)"))) == {"hierarchy.scope_exits"}
    for change in ("basin_id != 2", "NULL", "2"):
        p = parents.filter(change) if "!" in change else parents.withColumn("covering", F.when(F.col("basin_id") == 2, F.expr(f"CAST({change} AS LONG)")).otherwise(F.col("covering")))
        assert "hierarchy.one_parent" in failed(gates.gate_hierarchy(basins, p))
    assert "hierarchy.code_prefix" in failed(gates.gate_hierarchy(basins, parents.withColumn("code_ok", F.when(F.col("basin_id") != 2, True))))


def test_units(spark):
    edges = box_layer(spark, [(1, 0.0, 0.0, 10.0, 10.0), (2, 10.0, 0.0, 20.0, 10.0)])
    units = spark.createDataFrame([(1, "00001", "Xã A"), (2, "00002", "Phường B")], "feature_id long, code string, name string")
    frame = box_layer(spark, [(0, 0.0, 0.0, 20.0, 10.0)])
    legal = lambda *r: spark.createDataFrame(list(r), "feature_id long, legal_area double")
    gate = lambda u, e, a, **k: failed(gates.gate_units(u, e, frame, a, (2, 1, 1), **k))
    assert gate(units, edges, legal((1, 100.0), (2, 101.0))) == set()
    assert gate(units, edges, legal((1, 100.0))) == {"units.area_difference"}
    many = box_layer(spark, [(k, 10.0 * k, 0.0, 10.0 * k + 10, 10.0) for k in range(1, 6)])
    exceeds = geometry.area_difference(many, legal((1, 100.0), (2, None), (3, 0.0), (4, 200.0))).filter("exceeds").collect()
    assert {r.feature_id for r in exceeds} == {2, 3, 4, 5}  # null, zero, far off, missing
    assert gate(units, edges, legal((1, 100.0)), exceptions=("00002",)) == {"units.area_exceptions"}
    assert {"units.geometry_valid", "units.area_difference", "units.gap"} <= gate(units, edges.filter("feature_id = 1"), legal((1, 100.0), (2, 100.0)))


def test_population(spark):
    pixels = spark.createDataFrame([(0, r, c, 2.0, (r + c) % 7 != 0) for r in range(10) for c in range(10)], "raster_id long, row int, col int, population double, valid boolean")
    zones, core = box_layer(spark, [(1, 0.0, 0.0, 52.0, 100.0), (2, 52.0, 0.0, 100.0, 100.0), (3, 500.0, 0.0, 600.0, 100.0)]), box_layer(spark, [(0, 0.0, 0.0, 100.0, 100.0)])
    from tributary.sources.scratch import materialise

    table = materialise(zonal.population_by_zone(pixels, zones, core, GRID), "population")
    far = table.filter("zone_id = 3").first()
    assert far.aoi_pixels == 0 and far.coverage is None and far.population_sum == 0.0
    judge = lambda t: failed(gates.gate_population(t, pixels, zones, core, GRID))
    assert judge(table) == set()
    of = lambda column, value, zone=1: table.withColumn(column, F.when(F.col("zone_id") != zone, F.col(column)).otherwise(F.expr(value)))
    assert judge(of("scope", "CAST(NULL AS STRING)")) == {"population.scope"} and judge(of("coverage", "CAST(NULL AS DOUBLE)")) == {"population.coverage"}
    assert judge(of("nodata_pixels", "CAST(NULL AS LONG)")) == {"population.counts"} and judge(of("coverage", "0.0D", 3)) == {"population.coverage"}
    assert judge(of("contributing", "CAST(NULL AS LONG)")) >= {"population.counts", "population.coverage", "population.recount"}
    assert judge(table.filter("zone_id != 3")) == {"population.zones"}


def test_provenance(spark):
    assets = spark.createDataFrame([(1, "s", "1", "c1", "p1", "raw", 5), (2, "s", "1", "c2", "p2", "raw", 7), (3, None, None, None, None, "raw", 10**6), (4, "s", "1", "c1", "p4", "raw", 5)], "asset_id long, source string, version string, checksum string, path string, kind string, size_bytes long")
    closure = lambda *r: spark.createDataFrame(list(r), "root_id long, node_id long, state string")
    good = [(9, 1, "raw"), (9, 2, "raw"), (9, 4, "raw"), (9, 9, "inner")]
    assert failed(gates.gate_provenance(assets, closure(*good), 12)) == set()  # the unused asset counts nothing, equal contents count once
    assert failed(gates.gate_provenance(assets, closure(*good), 11)) == {"provenance.bytes"}
    assert failed(gates.gate_provenance(assets, closure((9, 9, "inner")), 12)) == {"provenance.used"}
    assert failed(gates.gate_provenance(assets, closure(*good, (9, 3, "raw")), 12)) == {"provenance.fields", "provenance.bytes"}
    assert failed(gates.gate_provenance(assets.withColumn("kind", F.when(F.col("asset_id") != 2, "raw")), closure(*good), 12)) == {"provenance.fields"}
    assert failed(gates.gate_provenance(assets, closure(*good, (9, 8, None)), 12)) == {"provenance.lineage"}


@pytest.mark.parametrize("seed", range(3))
def test_evidence_judges_as_the_closure(spark, seed):
    """Cycles, nodes that lead into them, missing and childless ones, roots that are few and one without id; seed 2 resolves as a whole."""
    rng = random.Random(seed)
    n = 40
    pairs = {(k, rng.randrange(k)) for k in range(1, n) for _ in range(2)} | ({(5, 9), (9, 5), (20, 20)} if seed < 2 else set())
    edges = spark.createDataFrame(sorted(pairs) + [(7, None)], "asset_id long, depends_on long")
    ids = lambda rows: spark.createDataFrame([(k,) for k in rows], "asset_id long")
    roots = [*range(0, n, 3), 12] if seed else [None, 3, n - 1, 77]
    args = edges, ids(roots), ids([0, 1, 2, 5, 9] if seed < 2 else [0]), ids([k for k in range(n) if k != 4 or seed == 2])
    closure, evidence = catalog.lineage_closure(*args), catalog.lineage_evidence(*args)
    bad = lambda df: sorted((str(r.root_id), str(r.node_id), r.state) for r in df.filter("state NOT IN ('raw', 'inner')").collect())
    raw = lambda df: sorted(r.node_id for r in df.filter("state = 'raw'").select("node_id").distinct().collect())
    assert bad(evidence) == bad(closure) and raw(evidence) == raw(closure) != [] and bool(bad(closure)) == (seed < 2)
    assert seed or ("None", "None", "missing") in bad(closure)
    assert evidence.filter("state = 'raw'").count() == len(raw(closure)) and evidence.filter("state = 'inner'").isEmpty()


def test_evidence_makes_no_pairs_of_what_resolves(spark, monkeypatch):
    """A chain of 30 assets down to a raw one: 465 pairs of root and node, which the gate doesn't need."""
    made, keep = [], catalog.materialise

    def counted(df, label, replaces=None):
        out = keep(df, label, replaces)
        made.append((label, out.count()))
        return out

    monkeypatch.setattr(catalog, "materialise", counted)
    ids = spark.range(30).withColumnRenamed("id", "asset_id")
    edges = spark.range(1, 30).select(F.col("id").alias("asset_id"), (F.col("id") - 1).alias("depends_on"))
    assets = ids.select("asset_id", *[F.lit("x").alias(c) for c in ("source", "version", "path", "checksum")], F.lit(3).cast("long").alias("size_bytes"))
    assert failed(gates.gate_provenance(assets, catalog.lineage_evidence(edges, ids, ids.filter("asset_id = 0"), ids), 3)) == set()
    assert max(rows for _, rows in made) == 30


def test_soil_layers(spark):
    cube = (["clay", "sand"], ["0-5cm", "5-15cm"], ["mean"])
    rows = [(0, r, c, p, d, "mean", not (p == "sand" and d == "5-15cm" and c < 5)) for r in range(10) for c in range(10) for p, d in (("clay", "0-5cm"), ("sand", "0-5cm"), ("sand", "5-15cm"), ("odd", "0-5cm"))]
    pixels = spark.createDataFrame(rows, "raster_id long, row int, col int, property string, depth string, statistic string, valid boolean")
    got = {r.check_id: r for r in gates.soil_layers(pixels, box_layer(spark, [(1, 0.0, 0.0, 100.0, 100.0)]), GRID, cube).collect()}
    bad = {k.removeprefix("raster.soil."): r.actual for k, r in got.items() if not r.passed}
    assert bad == {"clay.5-15cm.mean.coverage": "missing", "sand.5-15cm.mean.coverage": "0.5", "sand.5-15cm.mean.nodata": "50", "odd.0-5cm.mean.coverage": "unexpected"} and len(got) == 10


def test_zones_without_pixels_and_no_numbers(spark):
    nan, inf = float("nan"), float("inf")
    values = {(0, 0): nan, (0, 1): inf, (1, 0): 5.0, (1, 1): 7.0}
    pixels = spark.createDataFrame([(0, r, c, values.get((r, c), 6.0), 10, (r, c) != (2, 2)) for r in range(10) for c in range(10)], "raster_id long, row int, col int, value double, class int, valid boolean")
    zones = box_layer(spark, [(1, 0.0, 0.0, 100.0, 100.0), (2, 400.0, 0.0, 500.0, 100.0)])
    got = {r.zone_id: r for r in zonal.zonal_stats(pixels, zones, GRID, ("mean", "max", "p90", "p50"), by=("raster_id",)).collect()}
    assert (got[1].covered, got[1].valid, got[1]["max"], got[1].p90, got[1].p50) == (100, 97, 7.0, 6.0, 6.0) and got[1]["mean"] == pytest.approx((95 * 6 + 12) / 97)
    assert (got[2].covered, got[2].valid, got[2]["mean"], got[2].p90, got[2].raster_id) == (0, 0, None, None, 0)
    assert {r.zone_id: (r.covered, r.tree_fraction) for r in zonal.landcover_fractions(pixels, zones, GRID, {10: "tree"}).collect()} == {1: (100, 1.0), 2: (0, 0.0)}
    high = {r.zone_id: r for r in zonal.terrain_features(pixels, zones, GRID).collect()}
    assert high[2].covered_pixels == 0 and high[2].valid_fraction == 0.0 and high[2].slope_p90_deg is None and high[1].valid_pixels == 97 and math.isfinite(high[1].slope_mean_deg)
    soil = pixels.select("raster_id", "row", "col", "value", "valid", F.lit("clay").alias("property"), F.lit("mean").alias("statistic"), F.lit(0).alias("top"), F.lit(30).alias("bottom"))
    assert {(r.zone_id, r.band, r.covered_pixels, r.value is None) for r in zonal.soil_depth_weighted(soil, zones, GRID).collect()} == {(1, "0_30cm", 100, False), (2, "0_30cm", 0, True)}
    with pytest.raises(Exception, match="no divisor"):
        zonal.scale_soil(soil.withColumn("property", F.lit("odd"))).collect()


@pytest.mark.parametrize("p", [0.02, 0.5, 0.9])
def test_percentiles_of_many_values(spark, monkeypatch, p):
    """More values than the sketch keeps: continuous, with ties, and nearly all equal."""
    import random

    import numpy as np

    monkeypatch.setattr(zonal, "RANGED", 10_000_000 if p == 0.5 else 0)
    rng = random.Random(4)
    groups = {1: [rng.gauss(0, 1) for _ in range(30_000)], 2: [float(rng.randint(0, 3)) for _ in range(20_000)], 3: [1.0] * 9_000 + [rng.random() * 1e9 for _ in range(1_001)], 4: [3.5], 5: [rng.random() for _ in range(1_001)]}
    rows = spark.createDataFrame([(k, v) for k, vs in groups.items() for v in vs] + [(6, None)], "k long, v double").repartition(8)
    got = {r.k: r.percentile for r in zonal.percentiles(rows, ["k"], "v", p).collect()}
    assert got == {k: pytest.approx(np.quantile(vs, p), rel=1e-12, abs=1e-12) for k, vs in groups.items()}


def test_reaches_in_parts_and_touching(spark):
    zones = box_layer(spark, [(1, 0.0, 0.0, 100.0, 100.0)])
    rivers = line_layer(spark, [(1, 0, 0, 5.0, 5.0, 5.0, 95.0), (2, 0, 0, 15.0, 5.0, 15.0, 35.0), (2, 1, 0, 15.0, 55.0, 15.0, 95.0), (3, 0, 0, 100.0, 50.0, 150.0, 50.0), (4, 0, 0, -20.0, 120.0, 20.0, 80.0)])
    dem = spark.createDataFrame([(r, c, float(10 - r), True) for r in range(10) for c in range(10)], "row int, col int, value double, valid boolean")
    got = zonal.stream_gradient(zones, rivers, dem, GRID).first()
    assert (got.valid, got.nodata) == (2, 2)  # one in two parts, one that only touches


def test_many_hops(spark):
    n = 60
    basins = spark.createDataFrame([(k, k - 1) for k in range(1, n + 1)] + [(100, 3)], "basin_id long, next_down long")
    core = spark.createDataFrame([(1,)], "basin_id long")
    assert {r.basin_id: r.hop for r in admin.select_with_upstream(basins, core, 50).collect()} == {**{k: k - 1 for k in range(1, 52)}, 100: 3}
    with pytest.raises(ValueError, match="repeated"):
        admin.select_with_upstream(basins.unionByName(basins.filter("basin_id = 5")), core, 1)
