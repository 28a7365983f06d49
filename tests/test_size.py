"""Plans on tables whose files are small and whose rows are many, or that several steps read; files larger than a task should read."""

import gzip
import hashlib
import os
import random
import uuid

import pytest
from pyspark.sql import functions as F

from tests.test_geometry import HOLED, box_layer, line_layer, ring_layer
from tributary.operators import gates, zonal
from tributary.operators import geometry as G
from tributary.plans import records
from tributary.plans.fixtures import boxes
from tributary.sources import digests, io

DATA = "/root/testdata/sf0.001"
ZONES = [(z, 200.0 * (z % 5), 200.0 * (z // 5), 200.0 * (z % 5) + 200, 200.0 * (z // 5) + 200) for z in range(25)]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_band_of_edges(spark, monkeypatch):
    rows = [(1, HOLED + [[(4, 4), (6, 4), (6, 6), (4, 6)]]), (2, list(reversed(HOLED)))]
    found = []
    for edges in (1, 3, 16):
        monkeypatch.setattr(G, "BAND", edges)
        found.append({tuple(r) for r in ring_layer(spark, rows).collect()})
    assert found[0] == found[1] == found[2] and len(found[0]) == 20


def test_rings_are_dealt(spark, monkeypatch):
    monkeypatch.setattr(G, "FEATURES", 10)
    one = spark.range(0, 100, 1, 1).select("id", F.array(F.array(*[F.struct((F.col("id") + x).cast("double").alias("x"), F.lit(float(y)).alias("y")) for x, y in ((0, 0), (1, 0), (1, 1))])).alias("rings"))
    made = []
    keep = G.materialise
    monkeypatch.setattr(G, "materialise", lambda df, label: made.append((label, df.rdd.getNumPartitions())) or keep(df, label))
    assert G.measure(G.edges_from_rings(one, "id", "rings")).count() == 100
    assert dict(made)["rings"] == 10


def test_many_zones_are_not_broadcast(spark, tmp_path):
    path = f"{tmp_path}/{uuid.uuid4().hex}"
    spark.range(30_000).select(F.col("id").alias("k")).coalesce(1).write.parquet(path)
    k = F.col("k")
    layer = boxes(spark.read.parquet(path), "k", 3 * (k % 200), 3 * F.floor(k / 200), 3 * (k % 200) + 2, 3 * F.floor(k / 200) + 2)
    for df in (G.overlay_area(layer, layer), G.locate(spark.range(5).select(F.col("id").alias("point_id"), F.lit(1.0).alias("px"), F.lit(1.0).alias("py")), layer)):
        assert "BroadcastHashJoin" not in plan(df) and "SortMergeJoin" in plan(df)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")
def test_crosswalk_is_not_broadcast(spark):
    assert "Broadcast" not in plan(records.crosswalk(spark, DATA))


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")
def test_places_are_not_broadcast(spark):
    assert "Broadcast" not in plan(records.places(spark, DATA))


def test_pieces_stay_where_their_segment_is(spark, monkeypatch):
    monkeypatch.setattr(G, "SEGMENTS", 2)
    zones = box_layer(spark, ZONES)
    lines = line_layer(spark, [(i, 0, 0, 7.0 * i, 3.0, 990.0 - 11.0 * i, 995.0) for i in range(9)])
    cut = G.pieces(lines, zones)
    assert "hashpartitioning(id#" in plan(cut) and plan(cut).count("REPARTITION_BY_NUM") == 2
    assert not any("hashpartitioning(id#" in r and "ENSURE_REQUIREMENTS" in r for r in plan(cut).splitlines())
    rows = cut.collect()
    assert rows and all(r.inside or r.touches for r in rows)  # others are out of the zone's box
    got = {r.line_id: r.km for r in G.overlay_length(zones, lines).groupBy("line_id").agg(F.sum("intersection_length_km").alias("km")).collect()}
    assert got == {i: pytest.approx(((990 - 18 * i) ** 2 + 992**2) ** 0.5 / 1000) for i in range(9)}


def test_ends_on_edges_need_no_shuffle(spark):
    lines = line_layer(spark, [(1, 0, 0, 200.0, 50.0, 260.0, 80.0), (2, 0, 0, 210.0, 10.0, 220.0, 20.0), (3, 0, 0, 190.0, 190.0, 210.0, 210.0)])
    found = zonal.touches(lines, box_layer(spark, ZONES))
    assert "SortMergeJoin" not in plan(found) and plan(found).count("Exchange hashpartitioning") == 1
    assert {tuple(r) for r in found.collect()} == {(1, 0), (1, 1), (3, 0), (3, 1), (3, 5), (3, 6)}


def test_heights_are_joined_where_the_reaches_are(spark):
    dem = spark.range(100).select(F.lit(0).cast("long").alias("raster_id"), F.floor(F.col("id") / 10).cast("int").alias("row"), (F.col("id") % 10).cast("int").alias("col"), F.col("id").cast("double").alias("value"), F.lit(True).alias("valid"))
    grid = {"a": 100.0, "b": 0.0, "c": 0.0, "d": 0.0, "e": -100.0, "f": 1000.0}
    out = zonal.stream_gradient(box_layer(spark, ZONES), line_layer(spark, [(1, 0, 0, 10.0, 10.0, 150.0, 10.0)]), dem, grid)
    assert [(r.zone_id, r.stream_gradient) for r in out.collect() if r.valid] == [(0, pytest.approx(1 / 140))]
    assert "row#" not in "".join(r for r in plan(out).splitlines() if "Exchange hashpartitioning" in r)


def test_mappings_are_made_once(spark):
    made = spark.range(7, 1007).select((F.col("id") % 3).alias("z"), F.col("id").alias("k"), (F.col("id") > 500).alias("boundary_case"))
    checks = gates.gate_mappings({"p": made}, {"p": spark.range(2000).withColumnRenamed("id", "k")}, spark.range(3).withColumnRenamed("id", "z"), spark.range(1).withColumnRenamed("id", "u"), "z", {"p": (("k",), ("boundary_case",))}, ("p", "u", "f"))
    assert {r.check_id: r.actual for r in checks.collect()} == {"mapping.p.columns": "", "mapping.p.keys.z": "0", "mapping.p.keys.k": "0", "mapping.boundary_cases": "506"}
    assert "Range (7, 1007" not in plan(checks)


def test_provenance_is_read_once(spark):
    assets = spark.range(7, 1007).select(F.col("id").alias("asset_id"), *[F.lit("x").alias(c) for c in ("source", "version", "path")], F.col("id").cast("string").alias("checksum"), F.lit("raw").alias("kind"), F.lit(2).cast("long").alias("size_bytes"))
    closure = spark.range(9, 1009).select(F.col("id").alias("root_id"), F.col("id").alias("node_id"), F.lit("raw").alias("state"))
    checks = gates.gate_provenance(assets, closure, 2000)
    assert {r.check_id: (r.passed, r.actual) for r in checks.collect()} == {"provenance.fields": (True, "0"), "provenance.lineage": (True, "0"), "provenance.used": (True, "998"), "provenance.bytes": (True, "1996")}
    assert "Range (7, 1007" not in plan(checks) and "Range (9, 1009" not in plan(checks)


@pytest.mark.parametrize("length", [70_001, 64 * 1024, 4 * 16_384 + 512, 4 * 16_384 + 2_000])
def test_large_files_are_digested_in_pieces(spark, tmp_path, monkeypatch, length):
    monkeypatch.setattr(digests, "ONE_TASK", 10_000)
    monkeypatch.setattr(digests, "PIECES", ((1 << 14, 1 << 12), (1 << 11, 1 << 8), (1 << 11, 1)))
    data = random.Random(length).randbytes(length)
    names = {"plain.tif": data, "a,b {c} [d]*?.tif": data[:-1], "zeros.tif": bytes(length), "small.tif": data[:10_000], "packed.gz": gzip.compress(data), "named.gz": data[1:]}
    for name, content in names.items():
        (tmp_path / name).write_bytes(content)
    read = []
    monkeypatch.setattr(digests, "ended", lambda state, end=digests.ended: read.append(state[0]) or end(state))
    got = {os.path.basename(r.path): r for r in io.scan_assets(spark, str(tmp_path)).collect()}
    assert {k: (r.size_bytes, r.checksum, r.head) for k, r in got.items()} == {k: (len(v), hashlib.sha256(v).hexdigest(), v[:4].hex().upper()) for k, v in names.items()}
    assert sorted(read) == sorted(len(names[k]) for k in ("plain.tif", "a,b {c} [d]*?.tif", "zeros.tif"))


def test_a_piece_must_follow():
    state = digests.fed(digests.begun(), [(0, b"ab"), (2, b"cde")])
    assert digests.ended(digests.fed(state, [(5, b"f" * 100)])) == (hashlib.sha256(b"abcde" + b"f" * 100).hexdigest(), "61626364")
    with pytest.raises(ValueError, match="follows 5"):
        digests.fed(state, [(6, b"g")])
