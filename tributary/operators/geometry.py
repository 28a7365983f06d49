"""Geometry as edge tables: (feature_id, part, ring, seq, x1, y1, x2, y2), outer rings counter-clockwise, holes clockwise.

Every spatial operator is an equi-join on grid bins followed by an exact test, so no plan has a nested-loop join, and both
sides may be large. Results do not depend on the bin size. ``EPS`` is the one tolerance for "on the boundary".
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import materialise
from .joins import SMALL, is_small, large, sized

EPS = 1e-9
CELL = 100.0


PROBE = 0.3819660112501051  # of a ring's height: no vertex of a layer on a grid lies there
BAND = 16  # edges of a feature for one of its bands
FEATURES = 20_000  # rings of so many features are taken apart in a task


def ring_edges(layer: DataFrame, key: str, rings: str, shells: str | None = None) -> DataFrame:
    """Edges as the rings are given: (feature_id, ring, seq, x1, y1, x2, y2, rings, twice, added, hole).

    Points that repeat the one before are left out and open rings closed; ``added`` marks the edge that closes one. ``twice`` is the ring's signed area, doubled,
    ``rings`` their number. ``shells`` numbers the shell of each ring, the first of a number being the shell and the others holes.
    """
    hole = F.coalesce(F.get(F.col("__shells"), F.col("ring")) == F.get(F.col("__shells"), F.col("ring") - 1), F.lit(False)) if shells else F.lit(None).cast("boolean")
    each = layer.select(F.col(key).alias("feature_id"), F.size(rings).alias("rings"), F.col(shells).alias("__shells") if shells else F.lit(None).alias("__shells"), F.posexplode(rings).alias("ring", "pts"))
    open_ring = F.col("pts")[0] != F.element_at("pts", -1)
    each = each.filter(F.size("pts") >= 2).withColumns({"open": open_ring, "hole": hole}).withColumn("pts", F.when(F.col("open"), F.concat("pts", F.slice("pts", 1, 1))).otherwise(F.col("pts")))
    last = F.size("pts") - 2
    pairs = F.transform(F.sequence(F.lit(0), last), lambda i: F.struct(F.get("pts", i).alias("a"), F.get("pts", i + 1).alias("b"), (F.col("open") & (i == last)).alias("added")))
    each = each.withColumn("pairs", F.filter(pairs, lambda e: e["a"] != e["b"])).drop("pts")
    twice = F.aggregate("pairs", F.lit(0.0), lambda acc, e: acc + e["a"]["x"] * e["b"]["y"] - e["b"]["x"] * e["a"]["y"])
    rows = each.select("feature_id", "rings", "ring", "hole", twice.alias("twice"), F.posexplode("pairs").alias("seq", "e"))
    return rows.select("feature_id", "ring", "seq", F.col("e.a.x").alias("x1"), F.col("e.a.y").alias("y1"), F.col("e.b.x").alias("x2"), F.col("e.b.y").alias("y2"), "rings", "twice", F.col("e.added").alias("added"), "hole")


def ring_nesting(edges: DataFrame) -> DataFrame:
    """(feature_id, ring, outer): the rings of a feature that lie around each of its rings.

    A line at some height of a ring meets its leftmost point; a ring around it has an odd number of crossings to the left of that. Edges are filed under the bands of their feature
    that they pass, one for ``BAND`` edges of it, so a line meets only the edges near its height.
    """
    rings = edges.groupBy("feature_id", "ring").agg(F.min(F.least("y1", "y2")).alias("low"), F.max(F.greatest("y1", "y2")).alias("high"), F.count(F.lit(1)).alias("n"))
    whole = rings.groupBy("feature_id").agg(F.min("low").alias("bottom"), F.max("high").alias("top"), F.ceil(F.sum("n") / BAND).alias("bands")).filter("top > bottom")
    band = lambda y: F.floor((y - F.col("bottom")) / (F.col("top") - F.col("bottom")) * F.col("bands"))
    level = F.col("low") + PROBE * (F.col("high") - F.col("low"))
    probes = rings.filter("high > low").join(large(whole), "feature_id").select("feature_id", F.col("ring").alias("inner"), level.alias("y"), band(level).alias("band"))
    filed = edges.select("feature_id", "ring", "x1", "y1", "x2", "y2").filter("y1 != y2").join(large(whole), "feature_id")
    filed = filed.select("feature_id", "ring", "x1", "y1", "x2", "y2", F.explode(F.sequence(band(F.least("y1", "y2")), band(F.greatest("y1", "y2")))).alias("band"))
    met = filed.join(large(probes), ["feature_id", "band"]).filter("(y1 > y) != (y2 > y)").select("feature_id", "inner", "ring", F.expr("x1 + (y - y1) * (x2 - x1) / (y2 - y1)").alias("x"))
    met = materialise(met, "crossings")
    left = met.filter("ring = inner").groupBy("feature_id", "inner").agg(F.min("x").alias("left"))
    around = met.filter("ring != inner").join(large(left), ["feature_id", "inner"]).filter("x < left").groupBy("feature_id", "inner", "ring").agg((F.count(F.lit(1)) % 2 == 1).alias("odd"))
    return around.filter("odd").select("feature_id", F.col("inner").alias("ring"), F.col("ring").alias("outer"))


def _turned(edges: DataFrame, turn: Column, *extra: str) -> DataFrame:
    """The edges with those of rings that ``turn`` holds for run the other way; their seq runs backwards from -1."""
    swap = lambda a, b: F.when(turn, F.col(b)).otherwise(F.col(a))
    cols = [swap("x1", "x2").alias("x1"), swap("y1", "y2").alias("y1"), swap("x2", "x1").alias("x2"), swap("y2", "y1").alias("y2")]
    return edges.select("feature_id", "part", "ring", F.when(turn, -1 - F.col("seq")).otherwise(F.col("seq")).alias("seq"), *cols, *extra)


def edges_from_rings(layer: DataFrame, key: str, rings: str, shells: str | None = None, evidence: bool = False) -> DataFrame:
    """Edge table from ``rings array<array<struct<x,y>>>``, whatever the direction and order of the rings; open rings are closed.

    A ring in an even number of other rings of its feature is an outer one and a part of its own, one in an odd number a hole of the ring next around it. Features of one ring need no
    shuffle. The table is written to the shared folder, as operators read it several times. With ``evidence`` two columns tell what is wrong with the rings as given: ``added`` for an edge that closes an open ring, ``misplaced`` for a ring that
    ``shells`` calls a hole although it lies in no shell, or a shell although it lies in one.
    """
    raw = materialise(ring_edges(layer.repartition(math.ceil(layer.count() / FEATURES) or 1, key), key, rings, shells), "rings")
    extra = ["added", "misplaced"] if evidence else []
    one = _turned(raw.filter("rings = 1").withColumns({"part": F.lit(0), "misplaced": F.lit(False)}), F.col("twice") < 0, *extra)
    many = raw.filter("rings > 1")
    around = materialise(ring_nesting(many), "nesting")
    depth = around.groupBy("feature_id", "ring").agg(F.count(F.lit(1)).alias("depth"))
    above = around.join(large(depth.select("feature_id", F.col("ring").alias("outer"), F.col("depth").alias("d"))), ["feature_id", "outer"], "left")
    parent = above.groupBy("feature_id", "ring").agg(F.max_by("outer", F.coalesce("d", F.lit(0))).alias("parent"), F.count(F.lit(1)).alias("depth"))
    named = many.select("feature_id", "ring").distinct().join(large(parent), ["feature_id", "ring"], "left").withColumn("depth", F.coalesce("depth", F.lit(0)))
    named = named.withColumn("shell", F.when(F.col("depth") % 2 == 0, F.col("ring")).otherwise(F.col("parent")))
    place = F.dense_rank().over(Window.partitionBy("feature_id").orderBy("shell")) - 1
    inner = F.row_number().over(Window.partitionBy("feature_id", "shell").orderBy(F.col("depth") % 2, "ring")) - 1
    placed = named.select("feature_id", F.col("ring").alias("given"), "depth", place.alias("part"), inner.alias("ring"))
    both = many.withColumnRenamed("ring", "given").join(large(placed), ["feature_id", "given"])
    both = both.withColumn("misplaced", F.coalesce(F.col("hole") != (F.col("depth") % 2 == 1), F.lit(False)))
    return materialise(one.unionByName(_turned(both, (F.col("twice") < 0) == (F.col("depth") % 2 == 0), *extra)), "edges")


def edges_from_lines(layer: DataFrame, key: str, parts: str) -> DataFrame:
    """Segments (feature_id, part, seq, x1, y1, x2, y2) from ``parts array<array<struct<x,y>>>``: each part as it runs, never closed; segments without length are left out."""
    each = layer.select(F.col(key).alias("feature_id"), F.posexplode(parts).alias("part", "pts")).filter(F.size("pts") >= 2)
    pairs = F.transform(F.sequence(F.lit(0), F.size("pts") - 2), lambda i: F.struct(F.get("pts", i).alias("a"), F.get("pts", i + 1).alias("b")))
    rows = each.select("feature_id", "part", F.posexplode(F.filter(pairs, lambda e: e["a"] != e["b"])).alias("seq", "e"))
    return rows.select("feature_id", "part", "seq", F.col("e.a.x").alias("x1"), F.col("e.a.y").alias("y1"), F.col("e.b.x").alias("x2"), F.col("e.b.y").alias("y2"))


def measure(edges: DataFrame, flags: DataFrame | None = None) -> DataFrame:
    """(feature_id, area, length, xmin, ymin, xmax, ymax): area by the shoelace sum, length of all edges. With ``flags`` (feature_id, valid) an invalid feature has no area."""
    out = edges.groupBy("feature_id").agg(
        F.abs(F.sum(F.expr("x1 * y2 - x2 * y1")) / 2).alias("area"),
        F.sum(F.expr("sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1))")).alias("length"),
        *bounds(),
    )
    return out if flags is None else out.join(flags.select("feature_id", "valid"), "feature_id", "left").withColumn("area", F.when(F.col("valid"), F.col("area"))).drop("valid")


def valid_features(edges: DataFrame, flags: DataFrame) -> DataFrame:
    """The edges of the features that ``flags`` (feature_id, valid) calls valid."""
    return edges.join(flags.filter("valid").select("feature_id"), "feature_id", "left_semi")


def bounds() -> list[Column]:
    return [F.min(F.least("x1", "x2")).alias("xmin"), F.min(F.least("y1", "y2")).alias("ymin"), F.max(F.greatest("x1", "x2")).alias("xmax"), F.max(F.greatest("y1", "y2")).alias("ymax")]


def layer_bounds(edges: DataFrame) -> DataFrame:
    return edges.agg(*bounds())


def cells(low: Column, high: Column, cell: float, pad: float = 0.0) -> Column:
    return F.explode(F.sequence(F.floor((low - pad) / cell), F.floor((high + pad) / cell)))


def walked(df: DataFrame, cell: float = CELL, pad: float = 1e-6) -> DataFrame:
    """A row per grid bin (bx, by) that the segment (x1, y1)-(x2, y2) runs through or comes within ``pad`` of: per column of bins, the rows it crosses in the column widened by ``pad``."""
    rows = df.select("*", cells(F.least("x1", "x2"), F.greatest("x1", "x2"), cell, pad).alias("bx"))
    at = lambda x: F.when(F.col("x1") == F.col("x2"), F.col("y1")).otherwise(F.col("y1") + (x - F.col("x1")) * (F.col("y2") - F.col("y1")) / F.nullif(F.col("x2") - F.col("x1"), F.lit(0.0)))
    side = lambda k: F.greatest(F.least("x1", "x2"), F.least(F.greatest("x1", "x2"), (F.col("bx") + k) * cell + (2 * k - 1) * pad))
    upright = F.col("x1") == F.col("x2")
    low = F.when(upright, F.least("y1", "y2")).otherwise(F.least(at(side(0)), at(side(1))))
    high = F.when(upright, F.greatest("y1", "y2")).otherwise(F.greatest(at(side(0)), at(side(1))))
    return rows.select("*", cells(low, high, cell, pad).alias("by"))


def box_candidates(spots: DataFrame, boxes: DataFrame, cell: float = CELL) -> DataFrame:
    """Pairs of ``spots`` (px, py, ...) and ``boxes`` (zone_id, xmin, ymin, xmax, ymax) that hold them, without the box's columns.

    A box is filed at the level whose bins, ``cell`` times a power of two, are as large as it is, so it lies in a few of them whatever its size; spots are looked up at the levels that occur.
    """
    size = F.greatest(F.col("xmax") - F.col("xmin"), F.col("ymax") - F.col("ymin"), F.lit(cell))
    filed = boxes.withColumn("level", F.ceil(F.log2(size / cell)).cast("int"))
    counts = {r["level"]: r["count"] for r in filed.groupBy("level").count().collect()}  # a few dozen at most
    levels = list(counts) or [0]
    step = lambda level: F.pow(F.lit(2.0), level) * cell
    wide = step(F.col("level"))
    filed = filed.select("*", F.explode(F.sequence(F.floor((F.col("xmin") - EPS) / wide), F.floor((F.col("xmax") + EPS) / wide))).alias("bx"))
    filed = filed.select("*", F.explode(F.sequence(F.floor((F.col("ymin") - EPS) / wide), F.floor((F.col("ymax") + EPS) / wide))).alias("by"))
    at = spots.select("*", F.explode(F.array(*map(F.lit, levels))).alias("level")).withColumns({"bx": F.floor(F.col("px") / wide), "by": F.floor(F.col("py") / wide)})
    inside = F.expr(f"px BETWEEN xmin - {EPS} AND xmax + {EPS} AND py BETWEEN ymin - {EPS} AND ymax + {EPS}")
    return at.join(sized(filed, 9 * sum(counts.values()) <= SMALL), ["level", "bx", "by"]).filter(inside).drop("level", "bx", "by", "xmin", "ymin", "xmax", "ymax")


def segments(edges: DataFrame) -> DataFrame:
    """Edges with their own boxes."""
    return edges.withColumns({"xmin": F.least("x1", "x2"), "ymin": F.least("y1", "y2"), "xmax": F.greatest("x1", "x2"), "ymax": F.greatest("y1", "y2")})


CROSSES = "CASE WHEN (y1 > py) != (y2 > py) AND px < x1 + (py - y1) * (x2 - x1) / nullif(y2 - y1, 0D) THEN 1 ELSE 0 END"
DISTANCE2 = """CASE WHEN x1 = x2 AND y1 = y2 THEN (px - x1) * (px - x1) + (py - y1) * (py - y1) ELSE
  power(px - (x1 + least(1D, greatest(0D, ((px - x1) * (x2 - x1) + (py - y1) * (y2 - y1)) / nullif((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1), 0D))) * (x2 - x1)), 2) +
  power(py - (y1 + least(1D, greatest(0D, ((px - x1) * (x2 - x1) + (py - y1) * (y2 - y1)) / nullif((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1), 0D))) * (y2 - y1)), 2) END"""


def locate(points: DataFrame, edges: DataFrame, cell: float = CELL, pair: bool = False) -> DataFrame:
    """(point columns, zone_id, inside, touches) of candidate pairs of ``points`` (point_id, px, py) and zones.

    ``inside`` is the half-open crossing rule, so a point on a shared edge is inside one neighbour; ``touches`` is on the boundary.
    With ``pair`` the points name the only zone they are compared with, in ``zone_id``. Edges are filed under the horizontal bands they cross, so a
    point meets only the edges at its own height; zones are found through their boxes.
    """
    zone = edges.withColumnRenamed("feature_id", "zone_id")
    near = points if pair else box_candidates(points, zone.groupBy("zone_id").agg(*bounds()), cell)
    near = near.withColumn("band", F.floor(F.col("py") / cell))
    bands = segments(zone).select("zone_id", "x1", "y1", "x2", "y2", cells(F.col("ymin"), F.col("ymax"), cell, EPS).alias("band"))
    found = near.join(sized(bands), ["zone_id", "band"])
    keys = [*points.columns] if "zone_id" in points.columns else [*points.columns, "zone_id"]
    tested = found.groupBy(*keys).agg((F.sum(F.expr(CROSSES)) % 2 == 1).alias("inside"), (F.min(F.expr(DISTANCE2)) <= EPS * EPS).alias("touches"))
    return tested


def join_points_zones(points: DataFrame, edges: DataFrame, cell: float = CELL) -> DataFrame:
    """(point_id, zone_id, within, touches, nearest_boundary_tie, boundary_case): every zone that covers a point.

    A zone covers a point in it or on its boundary. A tie is a point that several zones cover and that lies on this zone's edge.
    """
    spots = points.select("point_id", F.col("x").alias("px"), F.col("y").alias("py"))
    covering = locate(spots, edges, cell).filter("inside OR touches")
    many = F.count(F.lit(1)).over(Window.partitionBy("point_id")) > 1
    tie = many & F.col("touches")
    return covering.select("point_id", "zone_id", (F.col("inside") & ~F.col("touches")).alias("within"), "touches", tie.alias("nearest_boundary_tie"), (F.col("touches") | tie).alias("boundary_case"))


#: How a point lies to a zone, and the flag of a tie.
WITHIN, TOUCHES, TIE, TIE_FLAG = "within", "touches", "nearest_boundary_tie", '{"boundary_tie":true}'


def map_points(points: DataFrame, edges: DataFrame, cell: float = CELL) -> DataFrame:
    """(zone_id, point_id, relationship_type, tags_json, boundary_case, quality_flags_json) of every zone that covers a point.

    relationship_type: within, touches, or nearest_boundary_tie where several zones cover the point and it lies on this one's edge. tags_json holds the other columns of ``points`` (point_id, x, y, ...) by
    name, those that are null left out; the flags say whether there is a tie.
    """
    tags = sorted(set(points.columns) - {"point_id", "x", "y"})
    json = F.to_json(F.struct(*tags)) if tags else F.lit("{}")
    tie = F.col("nearest_boundary_tie")
    kind = F.when(tie, TIE).when(F.col("within"), WITHIN).otherwise(TOUCHES)
    hit = join_points_zones(points, edges, cell).join(points.select("point_id", json.alias("tags_json")), "point_id")
    return hit.select("zone_id", "point_id", kind.alias("relationship_type"), "tags_json", F.col("touches").alias("boundary_case"), F.when(tie, TIE_FLAG).otherwise("{}").alias("quality_flags_json"))


def interior_point(edges: DataFrame) -> DataFrame:
    """(feature_id, x, y): on the line at mid-height, the middle of the widest stretch inside.

    Where the mid-height meets a vertex the half-open rule still pairs the crossings. Features of no height have none.
    """
    mid = edges.groupBy("feature_id").agg(((F.min(F.least("y1", "y2")) + F.max(F.greatest("y1", "y2"))) / 2).alias("y"))
    cut = edges.join(mid, "feature_id").filter("(y1 > y) != (y2 > y)").select("feature_id", "y", F.expr("x1 + (y - y1) * (x2 - x1) / nullif(y2 - y1, 0D)").alias("x"))
    order = Window.partitionBy("feature_id").orderBy("x")
    gaps = cut.withColumns({"next": F.lead("x").over(order), "nth": F.row_number().over(order)}).filter("nth % 2 = 1 AND next IS NOT NULL")
    best = gaps.groupBy("feature_id").agg(F.max_by(F.struct("x", "next", "y"), F.struct(F.col("next") - F.col("x"), -F.col("x"))).alias("g"))
    return best.select("feature_id", ((F.col("g.x") + F.col("g.next")) / 2).alias("x"), F.col("g.y").alias("y"))


CUT = ["part", "ring", "seq", "x1", "y1", "x2", "y2"]
SEGMENTS = 25_000  # dealt to a task


def pieces(lines: DataFrame, edges: DataFrame, cell: float = CELL, group: DataFrame | None = None) -> DataFrame:
    """Segments of ``lines`` cut at the edges of each zone that they meet or begin in; the pieces in the zone's box.

    One row per piece: (feature_id, part, ring, seq, zone_id, x1, y1, x2, y2, t, id, inside, touches, along): along is the direction of a zone edge that the
    piece lies on, 1 the same, -1 opposite, else 0; id numbers the segments. With ``group`` (feature_id, group) lines and zones are one layer: only other features of the
    same group are met, a segment is cut alike for all of them, and all pieces are given.

    Segments and edges meet in the bins they run through; a zone that a segment lies in without a crossing is found by its begin. Cuts of a segment
    and a zone come together by their numbers: where the zones are few, the segments are dealt by number beforehand, ``SEGMENTS`` a task, and what is made from them stays there.
    """
    own = (lines if "ring" in lines.columns else lines.withColumn("ring", F.lit(0))).select("feature_id", *CUT, F.monotonically_increasing_id().alias("id"))
    own = materialise(own, "segments")
    line = ["feature_id", *CUT]
    zone = walked(edges, cell).select(F.col("feature_id").alias("zone_id"), *[F.col(c).alias(f"e{c}") for c in ("x1", "y1", "x2", "y2")], "bx", "by")
    few = is_small(zone)
    if few and group is None:
        own = own.repartition(math.ceil(own.count() / SEGMENTS) or 1, "id")
    near = walked(own, cell).join(sized(zone, few), ["bx", "by"]).filter(F.expr(
        f"least(x1, x2) <= greatest(ex1, ex2) + {EPS} AND greatest(x1, x2) >= least(ex1, ex2) - {EPS} AND least(y1, y2) <= greatest(ey1, ey2) + {EPS} AND greatest(y1, y2) >= least(ey1, ey2) - {EPS}"))
    # parameters of the crossings of segment p + t r with edge q + u s, and of edge ends that lie on the segment
    near = near.withColumns({
        "cr": F.expr("(x2 - x1) * (ey2 - ey1) - (y2 - y1) * (ex2 - ex1)"),
        "tn": F.expr("(ex1 - x1) * (ey2 - ey1) - (ey1 - y1) * (ex2 - ex1)"),
        "un": F.expr("(ex1 - x1) * (y2 - y1) - (ey1 - y1) * (x2 - x1)"),
        "rr": F.expr("(x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)"),
    })
    crossing = F.expr("CASE WHEN cr != 0 AND un / nullif(cr, 0D) BETWEEN -1e-12 AND 1 + 1e-12 AND tn / nullif(cr, 0D) BETWEEN -1e-12 AND 1 + 1e-12 THEN array(tn / nullif(cr, 0D)) WHEN cr = 0 AND un = 0 THEN array(((ex1 - x1) * (x2 - x1) + (ey1 - y1) * (y2 - y1)) / nullif(rr, 0D), ((ex2 - x1) * (x2 - x1) + (ey2 - y1) * (y2 - y1)) / nullif(rr, 0D)) ELSE array() END")
    inner = F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("t"))), 12)
    met = near.select("id", "zone_id", *line, F.explode(crossing).alias("t")).withColumn("t", inner)
    begins = box_candidates(own.select("id", *line, F.col("x1").alias("px"), F.col("y1").alias("py")), edges.groupBy(F.col("feature_id").alias("zone_id")).agg(*bounds()), cell)
    found = met.unionByName(begins.select("id", "zone_id", *line, F.lit(1.0).alias("t")))
    if group is not None:
        of = lambda name, key: group.select(F.col("feature_id").alias(key), F.col("group").alias(name))
        found = found.filter("feature_id != zone_id").join(sized(of("g1", "feature_id")), "feature_id").join(sized(of("g2", "zone_id")), "zone_id").filter("g1 = g2").drop("g1", "g2")
        found = materialise(found.unionByName(own.select("id", F.lit(None).cast(dict(edges.dtypes)["feature_id"]).alias("zone_id"), *line, F.lit(1.0).alias("t"))), "pairs")  # a segment that meets no other feature is one piece
        found = found.drop("t").distinct().join(found.select("id", "t").distinct(), "id")
    order = Window.partitionBy("id", "zone_id").orderBy("t")
    found = found.withColumns({"from": F.coalesce(F.lag("t").over(order), F.lit(0.0)), "next": F.lead("t").over(order)})
    span = lambda a, b: F.struct(a.alias("t"), b.alias("t2"))
    cut = F.array(span(F.col("from"), F.col("t")), F.when(F.col("next").isNull(), span(F.col("t"), F.lit(1.0))))
    found = found.select("id", "zone_id", *line, F.explode(cut).alias("cut")).select("id", "zone_id", *line, "cut.t", "cut.t2").filter("t2 > t")
    part = found.select(
        "id", "feature_id", "part", "ring", "seq", "zone_id", "t",
        *[F.expr(e).alias(n) for n, e in (("ax", "x1 + t * (x2 - x1)"), ("ay", "y1 + t * (y2 - y1)"), ("bx2", "x1 + t2 * (x2 - x1)"), ("by2", "y1 + t2 * (y2 - y1)"))],
    ).withColumns({"px": F.expr("(ax + bx2) / 2"), "py": F.expr("(ay + by2) / 2")}).withColumn("band", F.floor(F.col("py") / cell))
    bands = segments(edges).select(F.col("feature_id").alias("zone_id"), "x1", "y1", "x2", "y2", cells(F.col("ymin"), F.col("ymax"), cell, 1e-6).alias("band"))
    if group is None:
        box = edges.groupBy(F.col("feature_id").alias("zone_id")).agg(*[b.alias(n) for b, n in zip(bounds(), ("zx1", "zy1", "zx2", "zy2"), strict=True)])
        boxed = bands.join(sized(box, few), "zone_id")
        tested = part.join(sized(boxed, few), ["zone_id", "band"]).filter("px BETWEEN zx1 - 1e-6 AND zx2 + 1e-6 AND py BETWEEN zy1 - 1e-6 AND zy2 + 1e-6")
    else:
        tested = part.join(sized(bands, few), ["zone_id", "band"], "left")
    beside = "px BETWEEN least(x1, x2) - 1e-6 AND greatest(x1, x2) + 1e-6 AND py BETWEEN least(y1, y2) - 1e-6 AND greatest(y1, y2) + 1e-6"
    on = F.expr(f"coalesce({beside} AND ({DISTANCE2}) <= 1e-14 AND abs((bx2 - ax) * (y2 - y1) - (by2 - ay) * (x2 - x1)) <= 1e-6 * sqrt(power(bx2 - ax, 2) + power(by2 - ay, 2)) * sqrt(power(x2 - x1, 2) + power(y2 - y1, 2)), false)")
    same = F.when(on, F.when(F.expr("(bx2 - ax) * (x2 - x1) + (by2 - ay) * (y2 - y1) > 0"), 1).otherwise(-1)).otherwise(0)
    out = tested.groupBy("id", "zone_id", "t", "feature_id", "part", "ring", "seq", "ax", "ay", "bx2", "by2").agg(
        (F.coalesce(F.sum(F.expr(CROSSES)), F.lit(0)) % 2 == 1).alias("inside"), F.coalesce(F.max(on), F.lit(False)).alias("touches"), F.max_by(same, F.abs(same)).alias("along"))
    return out.withColumnsRenamed({"ax": "x1", "ay": "y1", "bx2": "x2", "by2": "y2"})


LENGTH = "sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1))"
#: Output columns of the length overlay that a source column may not be named like.
RESERVED = ("zone_id", "intersection_length_km", "boundary_case", "intersection_wkt")


def overlay_length(edges: DataFrame, lines: DataFrame, attributes: DataFrame | None = None, keep_geometry: bool = False, cell: float = CELL) -> DataFrame:
    """(line_id, zone_id, intersection_length_km, boundary_case, ...): length of each line within each zone or on its boundary; above zero only.

    ``boundary_case``: part of the line runs along the boundary. Columns of ``attributes`` (feature_id, ...) pass through.
    """
    if attributes is not None and (clash := set(attributes.columns) & set(RESERVED)):
        raise ValueError(f"columns named like an output: {sorted(clash)}")
    kept = pieces(lines, edges, cell).filter("inside OR touches")
    wkt = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "seq", "t", "x1", "y1", "x2", "y2"))), lambda p: F.format_string("(%s %s, %s %s)", *[_number(p[c]) for c in ("x1", "y1", "x2", "y2")])), ", ")
    out = kept.groupBy("feature_id", "zone_id").agg((F.sum(F.expr(LENGTH)) / 1000).alias("intersection_length_km"), F.max("touches").alias("boundary_case"), *([wkt.alias("w"), F.count(F.lit(1)).alias("k")] if keep_geometry else []))
    out = out.filter("intersection_length_km > 0")
    if keep_geometry:
        text = F.when(F.col("k") == 1, F.concat(F.lit("LINESTRING "), "w")).otherwise(F.concat(F.lit("MULTILINESTRING ("), "w", F.lit(")")))
        out = out.withColumn("intersection_wkt", text).drop("w", "k")
    if attributes is not None:
        out = out.join(attributes, "feature_id", "left")
    return out.withColumnRenamed("feature_id", "line_id")


def _number(col: Column) -> Column:
    return F.regexp_replace(F.round(col, 6).cast("string"), r"\.0$", "")


def overlap_pieces(a: DataFrame, b: DataFrame, cell: float = CELL) -> DataFrame:
    """Boundary of every non-empty overlap as an edge table (a_id, b_id, x1, y1, x2, y2).

    Pieces of a inside b and of b inside a; where both run together one is kept if they run the same way, none if opposite.
    """
    first = pieces(a, b, cell).filter("(inside AND NOT touches) OR along = 1").select(F.col("feature_id").alias("a_id"), F.col("zone_id").alias("b_id"), "x1", "y1", "x2", "y2")
    second = pieces(b, a, cell).filter("inside AND NOT touches").select(F.col("zone_id").alias("a_id"), F.col("feature_id").alias("b_id"), "x1", "y1", "x2", "y2")
    return first.unionByName(second)


def overlay_area(zones: DataFrame, units: DataFrame, cell: float = CELL) -> DataFrame:
    """(zone_id, unit_id, intersection_area_km2, zone_fraction, unit_fraction) of pairs with an overlap above zero."""
    found = overlap_pieces(zones, units, cell).groupBy(F.col("a_id").alias("zone_id"), F.col("b_id").alias("unit_id")).agg(F.abs(F.sum(F.expr("x1 * y2 - x2 * y1")) / 2).alias("m2")).filter("m2 > 1e-6")
    za, ua = (measure(e).select(F.col("feature_id").alias(k), F.col("area").alias(f"{k}_area")) for e, k in ((zones, "zone_id"), (units, "unit_id")))
    out = found.join(sized(za), "zone_id").join(sized(ua), "unit_id")
    return out.select("zone_id", "unit_id", (F.col("m2") / 1e6).alias("intersection_area_km2"), (F.col("m2") / F.col("zone_id_area")).alias("zone_fraction"), (F.col("m2") / F.col("unit_id_area")).alias("unit_fraction"))


def clip_points(points: DataFrame, area: DataFrame, cell: float = CELL) -> DataFrame:
    """Points in the area or on its boundary."""
    spots = points.select("point_id", F.col("x").alias("px"), F.col("y").alias("py"))
    return points.join(locate(spots, area, cell).filter("inside OR touches").select("point_id").distinct(), "point_id", "left_semi")


def clip_lines(lines: DataFrame, area: DataFrame, cell: float = CELL) -> DataFrame:
    """The pieces of lines in the area or on its boundary (feature_id, part, seq, x1, y1, x2, y2); seq orders the pieces."""
    kept = pieces(lines, area, cell).filter("inside OR touches").select("feature_id", "part", "seq", "t", "x1", "y1", "x2", "y2").distinct()
    order = F.row_number().over(Window.partitionBy("feature_id", "part").orderBy("seq", "t")) - 1
    return kept.withColumn("seq", order).drop("t")


def clip_polygons(layer: DataFrame, area: DataFrame, cell: float = CELL) -> DataFrame:
    """The overlap of each feature with the area as an edge table; ring and seq are null."""
    return overlap_pieces(layer, area, cell).select(F.col("a_id").alias("feature_id"), F.lit(0).alias("part"), F.lit(None).cast("int").alias("ring"), F.lit(None).cast("int").alias("seq"), "x1", "y1", "x2", "y2")


def semi_intersects(layer: DataFrame, area: DataFrame, cell: float = CELL) -> DataFrame:
    """(feature_id) of polygons that meet an area: a piece of either boundary is in or on the other, or they touch at a point."""
    one = pieces(layer, area, cell).filter("inside OR touches").select("feature_id")
    two = pieces(area, layer, cell).filter("inside OR touches").select(F.col("zone_id").alias("feature_id"))
    corner = layer.select(F.monotonically_increasing_id().alias("point_id"), "feature_id", F.col("x1").alias("px"), F.col("y1").alias("py"))
    three = locate(corner, area, cell).filter("inside OR touches").select("feature_id")
    back = area.select(F.monotonically_increasing_id().alias("point_id"), F.col("x1").alias("px"), F.col("y1").alias("py"))
    four = locate(back, layer, cell).filter("touches").select(F.col("zone_id").alias("feature_id"))
    return one.union(two).union(three).union(four).distinct()


def near_edges(spots: DataFrame, edges: DataFrame, distance: float, cell: float = CELL) -> DataFrame:
    """Pairs of ``spots`` (px, py, ...) and ``edges`` (x1, y1, x2, y2, ...) at most ``distance`` apart.

    The bins are as large as the distance, ``cell`` times a power of two: an edge shorter than a bin is filed under nine of them or fewer, whatever the distance. A spot must lie in the edge's
    box, widened by the distance, before the exact test.
    """
    wide = cell * 2.0 ** max(0, math.ceil(math.log2(distance / cell))) if distance > 0 else cell
    at = spots.withColumns({"bx": F.floor(F.col("px") / wide), "by": F.floor(F.col("py") / wide)})
    reach = distance + EPS
    box = F.expr(f"px BETWEEN least(x1, x2) - {reach!r} AND greatest(x1, x2) + {reach!r} AND py BETWEEN least(y1, y2) - {reach!r} AND greatest(y1, y2) + {reach!r}")
    return at.join(walked(edges, wide, pad=reach), ["bx", "by"]).filter(box).filter(F.expr(DISTANCE2) <= distance * distance + EPS).drop("bx", "by")


def within_distance(points: DataFrame, edges: DataFrame, distance: float, cell: float = CELL) -> DataFrame:
    """(point_id) of points in an area or at most ``distance`` from its boundary."""
    spots = points.select("point_id", F.col("x").alias("px"), F.col("y").alias("py"))
    close = near_edges(spots, edges.select("x1", "y1", "x2", "y2"), distance, cell).select("point_id")
    return close.union(locate(spots, edges, cell).filter("inside OR touches").select("point_id")).distinct()


def union_pieces(edges: DataFrame, by: DataFrame | None = None, cell: float = CELL) -> DataFrame:
    """Boundary of the union of each group's features as an edge table (feature_id: the group), features may overlap in any number.

    A piece of a boundary stays if no other feature of its group has it inside; where boundaries run together the same way one stays, opposite ones go.
    """
    group = by if by is not None else edges.select("feature_id").distinct().withColumn("group", F.lit(0).cast("long"))
    own = edges.join(group.select("feature_id"), "feature_id", "left_semi")
    cut = pieces(own, own, cell, group)
    gone = F.max((F.col("inside") & ~F.col("touches")) | (F.col("along") == -1) | ((F.col("along") == 1) & (F.col("zone_id") < F.col("feature_id"))))
    kept = cut.groupBy("id", "t").agg(F.first(F.struct("feature_id", "x1", "y1", "x2", "y2")).alias("p"), F.coalesce(gone, F.lit(False)).alias("gone")).filter("NOT gone")
    return kept.select("p.*").join(group, "feature_id").select("group", "x1", "y1", "x2", "y2")


def dissolve(edges: DataFrame, by: DataFrame | None = None, cell: float = CELL) -> DataFrame:
    """Union of features as an edge table per group; features of a group may overlap, and runs of pieces on one line are joined.

    ``by`` has (feature_id, group); without it all features are one group.
    """
    named = union_pieces(edges, by, cell)
    # a line is named by its direction, reduced to one half-plane and scaled to length one, and its offset from the origin
    d = named.withColumn("len", F.expr(LENGTH)).filter("len > 0").withColumn("sign", F.expr("CASE WHEN x2 > x1 OR (x2 = x1 AND y2 > y1) THEN 1 ELSE -1 END"))
    d = d.withColumns({"ux": F.expr("sign * (x2 - x1) / len"), "uy": F.expr("sign * (y2 - y1) / len")})
    d = d.withColumns({"off": F.expr("round(ux * y1 - uy * x1, 6)"), "kx": F.round("ux", 9), "ky": F.round("uy", 9), "s1": F.expr("round(ux * x1 + uy * y1, 6)"), "s2": F.expr("round(ux * x2 + uy * y2, 6)")})
    line = ["group", "kx", "ky", "off"]
    steps = d.select(*line, "ux", "uy", F.explode(F.array(F.struct(F.least("s1", "s2").alias("s"), F.col("sign").alias("v")), F.struct(F.greatest("s1", "s2").alias("s"), (-F.col("sign")).alias("v")))).alias("e"))
    net = steps.groupBy(*line, "e.s").agg(F.sum("e.v").alias("v"), F.first("ux").alias("ux"), F.first("uy").alias("uy"))
    order = Window.partitionBy(*line).orderBy("s")
    runs = net.withColumns({"level": F.sum("v").over(order), "to": F.lead("s").over(order)}).filter("to IS NOT NULL AND level != 0")
    point = lambda s, axis: F.expr(f"{s} * u{axis} {'-' if axis == 'x' else '+'} off * u{'y' if axis == 'x' else 'x'}")
    a, b = F.when(F.col("level") > 0, F.col("s")).otherwise(F.col("to")), F.when(F.col("level") > 0, F.col("to")).otherwise(F.col("s"))
    runs = runs.withColumns({"sa": a, "sb": b})
    return runs.select(F.col("group").alias("feature_id"), F.lit(0).alias("part"), F.lit(None).cast("int").alias("ring"), F.lit(None).cast("int").alias("seq"), point("sa", "x").alias("x1"), point("sa", "y").alias("y1"), point("sb", "x").alias("x2"), point("sb", "y").alias("y2"))


def gap_overlap(units: DataFrame, reference: DataFrame, cell: float = CELL) -> DataFrame:
    """One row: gap and overlap of units against a reference, in percent of its area.

    Overlap: the sum of the units' areas above the area of their union; gap: the reference's area outside that union. Any number of units may cover a place.
    """
    outline = union_pieces(units, None, cell).select(F.col("group").alias("feature_id"), F.lit(0).alias("part"), F.lit(None).cast("int").alias("ring"), F.lit(None).cast("int").alias("seq"), "x1", "y1", "x2", "y2")
    outline = materialise(outline, "outline")
    total = measure(units).agg(F.sum("area").alias("units_area"))
    ref = measure(reference).agg(F.sum("area").alias("reference_area"))
    union = measure(outline).agg(F.coalesce(F.sum("area"), F.lit(0.0)).alias("union_area"))
    inside = overlay_area(outline, reference, cell).agg(F.coalesce(F.sum("intersection_area_km2") * 1e6, F.lit(0.0)).alias("inside"))
    one = total.join(F.broadcast(ref), F.lit(True)).join(F.broadcast(union), F.lit(True)).join(F.broadcast(inside), F.lit(True))  # single rows
    percent = lambda area: 100 * F.greatest(F.lit(0.0), area) / F.col("reference_area")
    return one.select(percent(F.col("units_area") - F.col("union_area")).alias("overlap_percent"), percent(F.col("reference_area") - F.col("inside")).alias("gap_percent"))


def area_difference(edges: DataFrame, legal: DataFrame, limit_percent: float = 2.0) -> DataFrame:
    """(feature_id, area, legal_area, difference_percent, exceeds) against ``legal`` (feature_id, legal_area); a legal area that is missing, null or not above zero exceeds."""
    rows = measure(edges).select("feature_id", "area").join(legal.select("feature_id", "legal_area"), "feature_id", "left")
    percent = F.when(F.col("legal_area") > 0, 100 * F.abs(F.col("area") - F.col("legal_area")) / F.nullif(F.col("legal_area"), F.lit(0.0)))
    return rows.select("feature_id", "area", "legal_area", percent.alias("difference_percent"), F.coalesce(percent > limit_percent, F.lit(True)).alias("exceeds"))


def flag_invalid_geometry(edges: DataFrame, cell: float = CELL) -> DataFrame:
    """(feature_id, closed, enough_points, self_crossing, nested, valid) of the features of an edge table.

    closed: the edges of a ring end where they begin, and none of them was added (a column of ``edges_from_rings``). enough_points: three edges a ring or more. self_crossing: two edges cross, run along
    each other, or meet in a point although they are of one ring and not neighbours; rings may touch each other in points. nested: no ring is ``misplaced`` (a column of the
    same). Edges meet in the bins they run through.
    """
    added, misplaced = (F.max(c) if c in edges.columns else F.lit(False) for c in ("added", "misplaced"))
    begin, end = F.min_by(F.struct("x1", "y1"), "seq"), F.max_by(F.struct(F.col("x2").alias("x1"), F.col("y2").alias("y1")), "seq")
    rings = edges.groupBy("feature_id", "part", "ring").agg(F.count(F.lit(1)).alias("n"), ((begin == end) & ~added).alias("closed"), misplaced.alias("misplaced"), F.min("seq").alias("first"), F.max("seq").alias("last"))
    shape = rings.groupBy("feature_id").agg(F.min("closed").alias("closed"), (F.min("n") >= 3).alias("enough_points"), (~F.max("misplaced")).alias("nested"))
    own = walked(edges.join(rings.select("feature_id", "part", "ring", "first", "last"), ["feature_id", "part", "ring"]), cell).select("feature_id", "part", "ring", "seq", "first", "last", "x1", "y1", "x2", "y2", "bx", "by")
    other = own.select("feature_id", "bx", "by", *[F.col(c).alias(f"o{c}") for c in ("part", "ring", "seq", "x1", "y1", "x2", "y2")])
    pair = own.join(other, ["feature_id", "bx", "by"]).filter("struct(part, ring, seq) < struct(opart, oring, oseq)")
    turn = lambda ax, ay, bx, by, cx, cy: F.expr(f"sign(({bx} - {ax}) * ({cy} - {ay}) - ({by} - {ay}) * ({cx} - {ax}))")
    pair = pair.withColumns({"d1": turn("x1", "y1", "x2", "y2", "ox1", "oy1"), "d2": turn("x1", "y1", "x2", "y2", "ox2", "oy2"), "d3": turn("ox1", "oy1", "ox2", "oy2", "x1", "y1"), "d4": turn("ox1", "oy1", "ox2", "oy2", "x2", "y2")})
    common = lambda c: f"least(greatest({c}1, {c}2), greatest(o{c}1, o{c}2)) - greatest(least({c}1, {c}2), least(o{c}1, o{c}2))"
    pair = pair.withColumns({"wide": F.expr(common("x")), "tall": F.expr(common("y"))})
    proper = F.expr("d1 * d2 < 0 AND d3 * d4 < 0")
    along = F.expr("d1 = 0 AND d2 = 0 AND wide >= 0 AND tall >= 0 AND (wide > 0 OR tall > 0)")
    meet = F.expr("d1 * d2 <= 0 AND d3 * d4 <= 0 AND wide >= 0 AND tall >= 0")
    neighbours = F.expr("oseq - seq = 1 OR (seq = first AND oseq = last)")
    crossing = pair.filter(proper | along | (meet & F.expr("part = opart AND ring = oring") & ~neighbours)).select("feature_id").distinct().withColumn("self_crossing", F.lit(True))
    out = shape.join(crossing, "feature_id", "left").withColumn("self_crossing", F.coalesce("self_crossing", F.lit(False)))
    return out.select("feature_id", "closed", "enough_points", "self_crossing", "nested", F.expr("closed AND enough_points AND NOT self_crossing AND nested").alias("valid"))


def polygons_within(layer: DataFrame, area: DataFrame, distance: float, cell: float = CELL) -> DataFrame:
    """(feature_id) of polygons that meet an area or come within ``distance`` of it. The distance of two disjoint polygons is that of a vertex of one to an edge of the other."""

    near = lambda corners, other: near_edges(corners, other.select(F.col("feature_id").alias("other_id"), "x1", "y1", "x2", "y2"), distance, cell)
    vertex = lambda edges: edges.select("feature_id", F.col("x1").alias("px"), F.col("y1").alias("py")).distinct()
    one = near(vertex(layer), area).select("feature_id")
    two = near(vertex(area), layer).select(F.col("other_id").alias("feature_id"))
    return one.union(two).union(semi_intersects(layer, area, cell)).distinct()


def footprint_ratio(box: tuple[float, float, float, float], area: DataFrame, cell: float = CELL) -> DataFrame:
    """(feature_id, ratio): the share of each area that lies within a raster's box (xmin, ymin, xmax, ymax)."""
    x0, y0, x1, y1 = box
    corners = [(x0, y0), (x1, y0), (x1, y1), (x0, y1)]
    edge = [F.struct(F.lit(i).alias("seq"), *[F.lit(float(v)).alias(n) for n, v in zip(("x1", "y1", "x2", "y2"), (*a, *b), strict=True)]) for i, (a, b) in enumerate(zip(corners, corners[1:] + corners[:1], strict=True))]
    frame = area.sparkSession.range(1).select(F.lit(0).cast("long").alias("feature_id"), F.lit(0).alias("part"), F.lit(0).alias("ring"), F.inline(F.array(*edge)))
    found = overlay_area(area, frame, cell).select(F.col("zone_id").alias("feature_id"), F.col("zone_fraction").alias("ratio"))
    return area.select("feature_id").distinct().join(found, "feature_id", "left").fillna(0.0, ["ratio"])


def validate_layer(attributes: DataFrame, edges: DataFrame, required: list[str], crs: str | None, expected_crs: str, cell: float = CELL) -> DataFrame:
    """One row: non_empty, columns_ok, crs_ok, geometry_present, geometry_valid, passed; ``attributes`` has feature_id."""
    have = edges.select("feature_id").distinct().withColumn("__geometry", F.lit(True))
    bad = flag_invalid_geometry(edges, cell).filter("NOT valid").select("feature_id").withColumn("__bad", F.lit(True))
    rows = attributes.select("feature_id").join(have, "feature_id", "left").join(bad, "feature_id", "left")
    checks = {"non_empty": F.count(F.lit(1)) > 0, "columns_ok": F.lit(set(required) <= set(attributes.columns)), "crs_ok": F.lit(crs == expected_crs), "geometry_present": F.count_if(F.col("__geometry").isNull()) == 0, "geometry_valid": F.count("__bad") == 0}
    return rows.agg(*[c.alias(n) for n, c in checks.items()]).withColumn("passed", F.expr(" AND ".join(checks)))
