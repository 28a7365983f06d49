import random

import pytest
from pyspark.sql import functions as F

from tests.test_geometry import box_layer
from tributary.functions import text as T
from tributary.operators import admin, catalog, gates, profile
from tributary.plans.fixtures import boxes
from tributary.sources import io


def test_names_compose(spark):
    df = spark.createDataFrame([("  Xã   Nạm  Păm ",), ("PHƯỜNG Tô Hiệu",), (None,)], "n string")
    assert [r[0] for r in df.select(T.normalize_unit_name(F.col("n"))).collect()] == ["nạm păm", "tô hiệu", None]


def test_dates(spark):
    df = spark.createDataFrame([("5/6/2020",), ("5-7/6/2020",), ("30/6-2/7/2020",), ("31/2/2020",), ("2020",), (None,)], "d string")
    got = [tuple(None if v is None else v.isoformat() for v in r) for r in df.select(*T.parse_event_dates(F.col("d"))).collect()]
    assert got == [("2020-06-05", "2020-06-05"), ("2020-06-05", "2020-06-07"), ("2020-06-30", "2020-07-02"), (None, None), (None, None), (None, None)]


def test_upstream(spark):
    b = spark.createDataFrame([(100, 0), (101, 100), (102, 101)], "basin_id long, next_down long")
    got = admin.select_with_upstream(b, b.filter("basin_id = 100"), 1)
    assert {r.basin_id for r in got.collect()} == {100, 101}
    with pytest.raises(ValueError):
        admin.select_with_upstream(b, b, -1)


def test_parents(spark):
    child = spark.createDataFrame([(100, "4512")], "basin_id long, code string")
    for pid, code in ((90, "451"), (80, "45")):
        p = spark.createDataFrame([(pid, code)], "basin_id long, code string")
        got = admin.assign_parents(child, box_layer(spark, [(100, 1.0, 1.0, 2.0, 2.0)]), p, box_layer(spark, [(pid, 0.0, 0.0, 10.0, 10.0)])).first()
        assert (got.parent_id, got.covering, got.code_ok) == (pid, 1, True)


def crosswalk(spark, lists, current_boxes, olds, old_boxes):
    cur = spark.createDataFrame([(i, f"{i:05d}", n, p) for i, (n, p) in enumerate(lists, 1)], "feature_id long, code string, name string, predecessors string")
    old = spark.createDataFrame([(i, f"old{i}", n, "2025-06-30") for i, n in enumerate(olds, 1)], "feature_id long, old_id string, old_name string, valid_to string")
    out = admin.build_crosswalk(cur, box_layer(spark, [(i, *b) for i, b in enumerate(current_boxes, 1)]), old, box_layer(spark, [(i, *b) for i, b in enumerate(old_boxes, 1)]))
    return cur, out


def test_crosswalk_and_places(spark):
    cur, out = crosswalk(spark, [("Phường Tô Hiệu", "Xã Tô Hiệu, Xã Chiềng An"), ("Xã Mường Bú", "Xã Nowhere")], [(0.0, 0.0, 10.0, 10.0), (20.0, 0.0, 30.0, 10.0)], ["Xã Tô Hiệu", "Xã Chiềng An"], [(0.0, 0.0, 5.0, 10.0), (5.0, 0.0, 10.0, 10.0)])
    got = {r.old_admin_normalized_name: r for r in out.collect()}
    assert (got["tô hiệu"].match_status, got["tô hiệu"].relationship_type, got["tô hiệu"].current_commune_code) == ("matched", "unchanged", "00001")
    assert (got["chiềng an"].match_status, got["chiềng an"].relationship_type) == ("matched", "merged")
    assert got["nowhere"].match_status == "unresolved" and got["nowhere"].old_admin_id is None
    events = spark.createDataFrame([("a", "Xã Chiềng An; bản X", "2024-01-01"), ("b", "Phường Tô Hiệu", "2026-01-01"), ("c", "Xã Tô Hiệu (cũ)", "2026-01-01"), ("d", "huyện Y", "2024-01-01"), ("e", "Xã Tô Hiệu", None), ("f", "Xã Tô, Hiệu", "2026-01-01"), ("g", None, "2026-01-01")], "event_id string, place string, start string").withColumn("start", F.col("start").cast("date"))
    r = {x.event_id: (x.match_status, list(x.codes), x.match_confidence, x.regime) for x in admin.resolve_places(events, cur, out).collect()}
    assert r["a"] == ("matched", ["00001"], 1.0, "historical") and r["b"] == ("matched", ["00001"], 1.0, "current")
    for k, regime in (("c", "current"), ("d", "historical"), ("e", None), ("f", "current"), ("g", "current")):
        assert r[k] == ("unresolved", [], 0.0, regime), k


def test_old_unit_claimed_twice(spark):
    _, out = crosswalk(spark, [("Xã A", "Xã Z"), ("Xã B", "Xã Z")], [(0.0, 0.0, 10.0, 10.0), (0.0, 0.0, 10.0, 10.0)], ["Xã Z"], [(0.0, 0.0, 5.0, 5.0)])
    assert [(r.match_status, r.current_commune_code) for r in out.collect()] == [("ambiguous", None)] * 2


def test_profile(spark):
    b = spark.createDataFrame([(1,), (2,)], "basin_id long")
    t = {g: spark.createDataFrame([(1, 1.0), (2, 2.0)], f"basin_id long, {g}_x double") for g in profile.REQUIRED}
    out = profile.assemble_profile(b, t | {"population": spark.createDataFrame([(1, 5)], "basin_id long, people int")}, "r")
    assert {r.basin_id: list(r.quality_flags) for r in out.collect()} == {1: [], 2: ["missing_population_observation"]}
    for bad in ({"soil": t["soil"].withColumn("flood_event_count", F.lit(1))}, {"soil": t["soil"].withColumn("terrain_x", F.lit(1))}, {"soil": t["soil"].filter("basin_id = 1")}, {"odd": t["soil"]}):
        with pytest.raises(ValueError):
            profile.assemble_profile(b, t | bad, "r")


def test_second_plan_only_reuses(spark):
    have = spark.createDataFrame([("a", "f1"), ("b", "f2")], "output_id string, fingerprint string")
    assert {r.action for r in catalog.plan_rebuild(have, have).collect()} == {"reuse"}


def test_cycle_is_found(spark):
    """A cycle, a node above it, one below it, a second cycle that the first leads to, and a path between them."""
    e = spark.createDataFrame([(1, 2), (2, 1), (3, 4), (5, 1), (2, 6), (6, 7), (7, 8), (8, 7), (8, 9), (10, 10)], "asset_id long, depends_on long")
    ids = spark.createDataFrame([(i,) for i in (1, 2, 3, 5, 6, 7, 8, 9, 10)], "asset_id long")
    c = catalog.lineage_closure(e, ids, ids.filter("asset_id = 9"), ids).collect()
    states = {(r.node_id, r.state) for r in c}
    assert states == {(1, "cyclic"), (2, "cyclic"), (3, "inner"), (4, "missing"), (5, "inner"), (6, "inner"), (7, "cyclic"), (8, "cyclic"), (9, "raw"), (10, "cyclic")}
    assert {r.node_id for r in c if r.root_id == 5} == {5, 1, 2, 6, 7, 8, 9}
    assets = ids.select("asset_id", *[F.lit("x").alias(f) for f in ("source", "version", "checksum", "path")], F.lit(1).alias("size_bytes"))
    closure = catalog.lineage_closure(e, ids, ids.filter("asset_id = 9"), ids)
    judged = lambda df: {r.check_id: r.passed for r in gates.gate_provenance(assets, df, 100).collect()}
    assert not judged(closure.filter("state != 'missing'"))["provenance.lineage"] and judged(closure.filter("state IN ('inner', 'raw')"))["provenance.lineage"]


def test_deep_lineage_is_whole(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    n = 24
    e = spark.createDataFrame([(i, i + 1) for i in range(n)], "asset_id long, depends_on long").coalesce(1)
    ids = spark.range(n).withColumnRenamed("id", "asset_id").coalesce(1)
    c = catalog.lineage_closure(e, ids.filter("asset_id = 0"), ids.limit(0), ids)
    assert c.count() == n + 1 and [r.node_id for r in c.filter("state = 'missing'").collect()] == [n]
    with pytest.raises(RuntimeError):
        catalog.lineage_closure(e, ids.filter("asset_id = 0"), ids.limit(0), ids, depth=2)
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_transitions_protect_fields(spark):
    rows = [(1, "failed", "fetching", {"note": "x"}), (2, "failed", "fetching", {"status": "derived"}), (3, "failed", "fetching", None), (4, "failed", "derived", None), (5, "failed", "fetching", {"asset_id": "9"})]
    got = catalog.check_transitions(spark.createDataFrame(rows, "asset_id long, from_status string, to_status string, updates map<string, string>"))
    assert {r.asset_id for r in got.collect()} == {2, 4, 5}


def test_fingerprint_ignores_order_and_copies(spark):
    make = lambda sums: catalog.fingerprint(spark.createDataFrame([("g", s) for s in sums] + [("h", None)], "g string, checksum string"), "g", "{}", "v")
    one, other, less = (dict(make(x).collect()) for x in (["abc1", "abc2", "def"], ["def", "abc2", "abc1", "abc2"], ["abc1", "def"]))
    assert one == other and one["g"] != less["g"] and one["h"] == less["h"]


def test_mapping_gate(spark):
    zones = spark.createDataFrame([(1,), (2,)], "HYBAS_ID long")
    units = spark.createDataFrame([("a",), ("b",)], "current_commune_code string")
    rivers = spark.createDataFrame([(7,)], "HYRIV_ID long")
    products = {k: gates.PRODUCTS[k] for k in ("commune", "river")}
    table = lambda rows, schema, name: spark.createDataFrame(rows, schema).select("*", *[F.lit(None).cast("boolean").alias(c) if c == "boundary_case" else F.lit("[]").alias(c) for c in gates.PRODUCTS[name][1] if c not in schema])
    commune = lambda rows: table(rows, "HYBAS_ID long, current_commune_code string, commune_fraction double", "commune")
    river = lambda rows: table(rows, "HYBAS_ID long, HYRIV_ID long", "river")

    def failed(maps, entities):
        return {r.check_id for r in gates.gate_mappings(maps, entities, zones, units, products=products).collect() if not r.passed}

    entities = {"commune": units, "river": rivers}
    whole = [(1, "a", 0.4), (2, "a", 0.6), (2, "b", 1.0)]
    assert failed({"commune": commune(whole), "river": river([(1, 7)])}, entities) == set()
    assert failed({"commune": commune(whole[1:]), "river": river([(3, 7), (1, 8)])}, entities) == {"mapping.commune.coverage", "mapping.river.keys.HYBAS_ID", "mapping.river.keys.HYRIV_ID"}
    assert failed({"commune": commune([*whole, (1, " ", 0.0), (None, "a", 0.0)])}, entities) == {"mapping.river.columns", "mapping.commune.keys.HYBAS_ID", "mapping.commune.keys.current_commune_code"}
    assert failed({"river": river([(1, 7)])}, {"commune": units}) == {"mapping.commune.columns", "mapping.commune.coverage", "mapping.river.keys.HYRIV_ID"}


def test_failing_gate_is_one_fatal_row(spark):
    text = spark.createDataFrame([("x",)], "t string")
    good = lambda: gates.no_rows(text.limit(0), "good")
    rows = gates.run_gates(spark, {"good": good, "run": lambda: gates.no_rows(text.filter(F.col("t").cast("int") > 0), "cast"), "plan": lambda: text.select("nowhere")}).collect()
    assert [(r.check_id, r.passed) for r in rows] == [("gate.plan", False), ("gate.run", False), ("good", True)] and len({r.report_id for r in rows}) == 1


def test_raster_gate_by_footprint(spark):
    area = boxes(spark.range(1), "id", *[F.lit(v) for v in (0, 0, 100, 100)])
    grid = {"a": 10.0, "b": 0.0, "c": 0.0, "d": 0.0, "e": -10.0, "f": 100.0}
    pixels = spark.range(100).select(F.lit(0).alias("raster_id"), (F.col("id") / 10).cast("int").alias("row"), (F.col("id") % 10).cast("int").alias("col"), (F.col("id") != 5).alias("valid"))
    got = lambda **r: {r.check_id: r.passed for r in gates.gate_rasters(r).collect()}
    assert got(pop=(pixels, area, grid, True)) == {"raster.pop.coverage": True, "raster.pop.nodata": False}
    assert got(pop=(pixels.filter("row < 8"), area, grid, True))["raster.pop.coverage"] is False
    assert got(dem=(pixels.withColumn("valid", F.col("row") > 0), area, grid, False))["raster.dem.coverage"] is False
    assert got(dem=(None, area, grid, False)) == {"raster.dem.coverage": False}


def test_interrupted_publication_is_recovered(spark, tmp_path):
    path = str(tmp_path / "t")
    io.write_table(spark.range(3).withColumnRenamed("id", "asset_id"), path, ["asset_id"])
    (tmp_path / "t").rename(tmp_path / "t.previous")  # as after a crash between the two moves
    assert io.read_catalog(spark, path).count() == 3
    io.write_table(spark.range(2).withColumnRenamed("id", "asset_id"), path, ["asset_id"])
    assert io.read_catalog(spark, path).count() == 2 and not (tmp_path / "t.previous").exists()


def test_write_replaces_whole_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in (5, 3):
        io.write_table(spark.range(n).withColumnRenamed("id", "asset_id"), path, ["asset_id"])
    assert sorted(r.asset_id for r in io.read_catalog(spark, path).collect()) == [0, 1, 2]
    with pytest.raises(ValueError):
        io.write_catalog(spark.createDataFrame([(1,), (1,)], "asset_id long"), path)


def test_stream_drains_updates(spark, tmp_path):
    from tributary.streaming.intake import drain_updates

    cat, ups, ck = (str(tmp_path / n) for n in ("cat", "ups", "ck"))
    io.write_catalog(spark.createDataFrame([(1, "old"), (2, "old")], "asset_id long, status string"), cat)
    spark.createDataFrame([(2, "new", 5), (3, "new", 1), (2, "older", 4)], "asset_id long, status string, sequence long").write.parquet(ups)
    for _ in range(2):
        drain_updates(spark, ups, "asset_id long, status string, sequence long", cat, ck)
        assert {(r.asset_id, r.status) for r in spark.read.parquet(cat).collect()} == {(1, "old"), (2, "new"), (3, "new")}


def test_redaction(spark):
    df = spark.createDataFrame([("Authorization: Bearer abc.def, https://u:p@h/x?api_key=1&y=2#z",)], "t string")
    assert df.select(T.redact(F.col("t"))).first()[0] == "Authorization: Bearer [REDACTED], https://[REDACTED]@h/x?api_key=[REDACTED]&y=2#z"


def brute_cyclic(edges):
    """Nodes that reach themselves."""
    out = {}
    for a, b in edges:
        out.setdefault(a, set()).add(b)
    found = set()
    for a in out:
        seen, todo = set(), list(out[a])
        while todo:
            x = todo.pop()
            if x not in seen:
                seen.add(x)
                todo += out.get(x, ())
        if a in seen:
            found.add(a)
    return found


@pytest.mark.parametrize("seed", [1, 2])
def test_cycles_of_any_shape(spark, seed):
    """Random graphs side by side, rings, rings joined by paths, an edge from a node to itself, and a node on two rings."""
    rng = random.Random(seed)
    edges = [(base + rng.randrange(14), base + rng.randrange(14)) for base in range(0, 600, 20) for _ in range(rng.choice([8, 14, 18]))]
    ring = lambda a, n: [(a + k, a + (k + 1) % n) for k in range(n)]
    edges += ring(1000, 7) + ring(1100, 2) + ring(1200, 30) + [(1003, 1050), (1050, 1051), (1051, 1205)] + [(1300, 1300), (1301, 1300)] + ring(1400, 5) + [(1400, 1450), (1450, 1451), (1451, 1400)] + [(1500 + k, 1501 + k) for k in range(40)]
    got = catalog.cyclic(spark.createDataFrame(edges, "asset_id long, depends_on long"))
    assert sorted(r.asset_id for r in got.collect()) == sorted(brute_cyclic(edges))


def test_a_long_ring(spark):
    n = 100_000
    ring = spark.range(n).select(F.col("id").alias("asset_id"), ((F.col("id") + 1) % n).alias("depends_on"))
    assert catalog.cyclic(ring).count() == n
    assert catalog.cyclic(ring.filter("asset_id < 12").unionByName(spark.createDataFrame([(12, 0)], "asset_id long, depends_on long"))).count() == 13


def test_upserts_touch_their_buckets_only(spark, tmp_path):
    from tributary.sources.buckets import read_buckets, upsert_buckets
    from tributary.streaming.intake import drain_into_buckets

    path, schema = str(tmp_path / "b"), "asset_id long, status string, sequence long"
    with pytest.raises(ValueError):
        read_buckets(spark, path)
    assert read_buckets(spark, path, "asset_id long").count() == 0
    assert len(upsert_buckets(spark.range(500).selectExpr("id AS asset_id", "'old' AS status", "0L AS sequence"), path, buckets=8)) == 8
    files = lambda: {str(f): f.stat().st_size for f in (tmp_path / "b" / "data").rglob("*.parquet")}
    first = files()
    touched = upsert_buckets(spark.createDataFrame([(3, "new", 1), (3, "newer", 2), (900, "new", 1)], schema), path)
    rows = {r.asset_id: r.status for r in read_buckets(spark, path).collect()}
    assert rows == {**dict.fromkeys(range(500), "old"), 3: "newer", 900: "new"} and len(touched) <= 2
    assert len(set(files()) - set(first)) == len(touched) and upsert_buckets(spark.createDataFrame([], schema), path) == []
    ups = str(tmp_path / "updates")
    for batch in ([(1, "a", 5)], [(1, "b", 6), (2, "c", 1)]):
        spark.createDataFrame(batch, schema).write.mode("append").parquet(ups)
        drain_into_buckets(spark, ups, schema, path, str(tmp_path / "ck"))
    rows = {r.asset_id: r.status for r in read_buckets(spark, path).collect()}
    assert len(rows) == 501 and (rows[1], rows[2], rows[3]) == ("b", "c", "newer")
    assert len(list((tmp_path / "b" / "manifests").iterdir())) == 2 and sum(f.name.startswith("bucket=") for f in (tmp_path / "b" / "data").rglob("bucket=*")) <= 16
