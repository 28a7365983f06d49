"""Virtual layers over the given tables: geometry, pixels, units and assets by whole-number arithmetic on keys.

``CTE`` holds the same rules as SQL, so that another engine can repeat every query. The world is [0, 1000] x [0, 1000] metres.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Codes and names of land-cover classes.
CLASSES = {10: "tree_cover", 20: "shrubland", 30: "grassland", 40: "cropland", 50: "built_up", 60: "bare_sparse", 70: "snow_ice", 80: "permanent_water", 90: "herbaceous_wetland", 95: "mangroves", 100: "moss_lichen"}
CODES = [0, *CLASSES]
SIDE = 100  # pixels of a raster's side
CELL = 100.0  # default side of a grid bin


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(codes: list[int], at: Column) -> Column:
    return F.element_at(F.array(*[F.lit(c) for c in codes]), at.cast("int") + 1)


def boxes(df: DataFrame, key: str, x0: Column, y0: Column, x1: Column, y1: Column) -> DataFrame:
    """Edge table of boxes, counter-clockwise."""
    corners = df.select(F.col(key).alias("feature_id"), *[c.cast("double").alias(n) for n, c in zip(("x0", "y0", "x1", "y1"), (x0, y0, x1, y1), strict=True)])
    return quads(corners, *[(F.col(a), F.col(b)) for a, b in (("x0", "y0"), ("x1", "y0"), ("x1", "y1"), ("x0", "y1"))])


def quads(df: DataFrame, *corners: tuple[Column, Column]) -> DataFrame:
    point = [F.struct(x.cast("double").alias("x"), y.cast("double").alias("y")) for x, y in corners]
    edges = [F.struct(F.lit(i).alias("seq"), a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2")) for i, (a, b) in enumerate(zip(point, point[1:] + point[:1], strict=True))]
    return df.select("feature_id", F.lit(0).alias("part"), F.lit(0).alias("ring"), F.inline(F.array(*edges)))


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("n_nationkey").cast("long")
    x, y = 200 * (k % 5), 200 * F.floor(k / 5)
    return boxes(table(spark, sf_dir, "nation").withColumn("feature_id", k), "feature_id", x, y, x + 200, y + 200)


def zones_tilted(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("feature_id")
    x, y = 200 * (k % 5), 200 * F.floor(k / 5)
    lift = 7 + F.floor(k / 5)
    return quads(table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("feature_id")), (x, y), (x + 200, y + lift), (x + 200, y + 200 + lift), (x, y + 200))


def units(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("feature_id")
    x, y = 250 * (k % 4), 250 * F.floor(k / 4)
    return boxes(table(spark, sf_dir, "nation").filter("n_nationkey < 16").select(F.col("n_nationkey").cast("long").alias("feature_id")), "feature_id", x, y, x + 250, y + 250)


def turned(ring: Column, turn: Column) -> Column:
    return F.when(turn, F.reverse(ring)).otherwise(ring)


def square(x: Column, y: Column, low: float, high: float) -> Column:
    """A ring of four corners, counter-clockwise, not closed."""
    return F.array(*[F.struct((x + a).cast("double").alias("x"), (y + b).cast("double").alias("y")) for a, b in ((low, low), (high, low), (high, high), (low, high))])


def plots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(feature_id, rings): per part a shell, a hole in it and an island in the hole; rings in any order and direction."""
    k = F.col("p_partkey").cast("long")
    x, y = 20 * (k % 50), 20 * F.floor(k / 50)
    a, b, c = (turned(square(x, y, low, high), F.floor(k / n) % 2 == 1) for n, (low, high) in ((1, (0, 18)), (2, (2, 16)), (4, (5, 13))))
    rings = F.when(k % 3 == 0, F.array(a, b, c)).when(k % 3 == 1, F.array(c, a, b)).otherwise(F.array(b, c, a))
    return table(spark, sf_dir, "part").select(k.alias("feature_id"), rings.alias("rings"))


def lots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(feature_id, rings): per supplier a square that overlaps its neighbours, every other one clockwise."""
    k = F.col("s_suppkey").cast("long")
    return table(spark, sf_dir, "supplier").select(k.alias("feature_id"), F.array(turned(square(31 * (k % 32) + 3, 31 * F.floor(k / 32) + 5, 0, 35), k % 2 == 1)).alias("rings"))


def core(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = table(spark, sf_dir, "nation").filter("n_nationkey = 0").select(F.lit(0).cast("long").alias("feature_id"))
    return boxes(one, "feature_id", *[F.lit(v) for v in (100, 100, 900, 900)])


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, u = F.col("event_id"), F.col("user_id")
    return table(spark, sf_dir, "events").select(e.alias("point_id"), ((e * 7919) % 1001).cast("double").alias("x"), ((u * 104729 + e * 31) % 1001).cast("double").alias("y"), "event_type", "value")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments of lines (feature_id, part, seq, x1, y1, x2, y2); zero-length ones are left out."""
    o, c = F.col("o_orderkey"), F.col("o_custkey")
    at = [(o * 7919) % 1001, (o * 104729) % 1001, (c * 15485863 + o) % 1001, (c * 32452843 + o * 3) % 1001]
    rows = table(spark, sf_dir, "orders").select(o.alias("feature_id"), F.lit(0).alias("part"), F.lit(0).alias("seq"), *[v.cast("double").alias(n) for n, v in zip(("x1", "y1", "x2", "y2"), at, strict=True)])
    return rows.filter("x1 != x2 OR y1 != y2")


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One pixel per order: rasters of 100 x 100 pixels of 10 m, as many as the orders fill."""
    o, c = F.col("o_orderkey"), F.col("o_custkey")
    return table(spark, sf_dir, "orders").select(
        F.floor(o / (SIDE * SIDE)).cast("long").alias("raster_id"),
        F.floor(o % (SIDE * SIDE) / SIDE).cast("int").alias("row"),
        (o % SIDE).cast("int").alias("col"),
        pick(CODES, c % 12).alias("class"),
        ((o * 37 + c * 11) % 1000).cast("double").alias("value"),
        (c % 50).cast("double").alias("population"),
        (c % 10 != 0).alias("valid"),
    )


def grid(tied: bool = False) -> dict[str, float]:
    """Affine terms of the rasters; ``tied`` shifts centres onto multiples of 10."""
    return {"a": 10.0, "b": 0.0, "c": -5.0 if tied else 0.0, "d": 0.0, "e": -10.0, "f": 1005.0 if tied else 1000.0}


def topology(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").filter("c_custkey > 0").select(k.alias("basin_id"), F.when(k <= 1, 0).otherwise(F.floor(k / 2)).cast("long").alias("next_down"))


def assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.concat_ws("/", "source", "lang", F.lpad(F.col("doc_id").cast("string"), 9, "0"))
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("asset_id"), path.alias("path"), "source", F.lit("1").alias("version"), F.lit("raw").alias("kind"),
        F.col("lang").alias("media_type"), F.sha2("text", 256).alias("checksum"), F.col("n_chars").alias("size_bytes"),
        pick_text(["validated", "harmonized", "derived", "failed"], F.col("doc_id") % 4).alias("status"),
    )


def pick_text(values: list[str], at: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), at.cast("int") + 1)


def unit_names(col: Column, k: Column) -> Column:
    """A unit's display name: level prefix by k and the given base name."""
    return F.concat(pick_text(["Xã ", "Phường ", "Thị trấn "], k % 3), col, F.lit(" "), k.cast("string"))


CTE = {
    "zones": "zones AS (SELECT n_nationkey::BIGINT AS zone_id, 200*(n_nationkey%5) AS x0, 200*(n_nationkey//5) AS y0, 200*(n_nationkey%5)+200 AS x1, 200*(n_nationkey//5)+200 AS y1 FROM nation)",
    "tilted": """corners AS (SELECT n_nationkey::BIGINT AS zone_id, 200.0*(n_nationkey%5) AS x, 200.0*(n_nationkey//5) AS y, 7+n_nationkey//5 AS lift FROM nation),
        tilted AS (SELECT zone_id, 0 AS seq, x AS ex1, y AS ey1, x+200 AS ex2, y+lift AS ey2 FROM corners
          UNION ALL SELECT zone_id, 1, x+200, y+lift, x+200, y+200+lift FROM corners
          UNION ALL SELECT zone_id, 2, x+200, y+200+lift, x, y+200 FROM corners
          UNION ALL SELECT zone_id, 3, x, y+200, x, y FROM corners)""",
    "units": "units AS (SELECT n_nationkey::BIGINT AS unit_id, 250*(n_nationkey%4) AS x0, 250*(n_nationkey//4) AS y0, 250*(n_nationkey%4)+250 AS x1, 250*(n_nationkey//4)+250 AS y1 FROM nation WHERE n_nationkey < 16)",
    "plots": "plots AS (SELECT p_partkey::BIGINT AS plot_id, 20*(p_partkey%50) AS x, 20*(p_partkey//50) AS y FROM part)",
    "lots": "lots AS (SELECT s_suppkey::BIGINT AS lot_id, 31*(s_suppkey%32)+3 AS x, 31*(s_suppkey//32)+5 AS y FROM supplier)",
    "points": "points AS (SELECT event_id AS point_id, ((event_id*7919)%1001)::DOUBLE AS x, ((user_id*104729+event_id*31)%1001)::DOUBLE AS y, event_type, value FROM events)",
    "lines": "lines AS (SELECT * FROM (SELECT o_orderkey AS line_id, ((o_orderkey*7919)%1001)::DOUBLE AS x1, ((o_orderkey*104729)%1001)::DOUBLE AS y1, ((o_custkey*15485863+o_orderkey)%1001)::DOUBLE AS x2, ((o_custkey*32452843+o_orderkey*3)%1001)::DOUBLE AS y2 FROM orders) WHERE x1 != x2 OR y1 != y2)",
    "pixels": """pixels AS (SELECT o_orderkey//10000 AS raster_id, (o_orderkey%10000//100)::INT AS "row", (o_orderkey%100)::INT AS col,
        ([0,10,20,30,40,50,60,70,80,90,95,100])[1+o_custkey%12] AS class, ((o_orderkey*37+o_custkey*11)%1000)::DOUBLE AS value, (o_custkey%50)::DOUBLE AS population, o_custkey%10 != 0 AS valid,
        (o_orderkey%100)*10+5 AS px, 1000-(o_orderkey%10000//100)*10-5 AS py FROM orders)""",
    "topology": "topology AS (SELECT c_custkey AS basin_id, CASE WHEN c_custkey <= 1 THEN 0 ELSE c_custkey//2 END AS next_down FROM customer WHERE c_custkey > 0)",
    "assets": """assets AS (SELECT doc_id AS asset_id, concat_ws('/', source, lang, lpad(doc_id::VARCHAR, 9, '0')) AS path, source, '1' AS version, 'raw' AS kind, lang AS media_type, sha256("text") AS checksum, n_chars AS size_bytes,
        (['validated','harmonized','derived','failed'])[1+doc_id%4] AS status FROM documents)""",
}


def sql(names: str, body: str, recursive: bool = False) -> str:
    """A query that starts with the named rules."""
    return f"WITH {'RECURSIVE ' if recursive else ''}{', '.join(CTE[n] for n in names.split())} {body}" if names else body
