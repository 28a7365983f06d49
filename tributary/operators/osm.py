"""Selections and parts of map features that carry tags."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import truthy_tag

#: Tag values of the selections.
AMENITIES = ("hospital", "clinic", "school", "kindergarten", "college", "university", "fire_station", "police", "townhall", "shelter")
PLACES = ("city", "town", "village", "hamlet", "locality")
NATURAL_WATER = ("water", "bay")


def _tag(df: DataFrame, name: str):
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def select_roads(df: DataFrame) -> DataFrame:
    return df.filter(_tag(df, "highway").isNotNull())


def select_bridges(df: DataFrame) -> DataFrame:
    return df.filter(truthy_tag(_tag(df, "bridge")))


def select_facilities(df: DataFrame, amenities: tuple[str, ...] = AMENITIES) -> DataFrame:
    any_of = F.coalesce(F.lower(_tag(df, "amenity")).isin(*amenities), F.lit(False))
    for name in ("healthcare", "emergency", "government"):
        any_of = any_of | truthy_tag(_tag(df, name))
    return df.filter(any_of)


def select_settlements(df: DataFrame, places: tuple[str, ...] = PLACES) -> DataFrame:
    return df.filter(F.lower(_tag(df, "place")).isin(*places))


def select_water(*layers: DataFrame) -> DataFrame:
    """Water features of several layers; columns that a layer lacks are null."""
    df = union_layers(*layers)
    water = truthy_tag(_tag(df, "water")) | truthy_tag(_tag(df, "waterway")) | F.coalesce(F.lower(_tag(df, "natural")).isin(*NATURAL_WATER), F.lit(False)) | F.coalesce(F.lower(_tag(df, "landuse")) == "reservoir", F.lit(False))
    return df.filter(water)


def union_layers(*layers: DataFrame) -> DataFrame:
    df = layers[0]
    for more in layers[1:]:
        df = df.unionByName(more, allowMissingColumns=True)
    return df


def explode_parts(lines: DataFrame) -> DataFrame:
    """One row per part of a line with a highway tag; segment_id is osm_id and the part's number in source order. ``parts``: array of point arrays; parts of under two points are skipped, their number is kept."""
    each = select_roads(lines).select(*[c for c in lines.columns if c != "parts"], F.posexplode("parts").alias("part_index", "pts")).filter(F.size("pts") >= 2)
    return each.withColumn("segment_id", F.format_string("%s:%03d", "osm_id", "part_index"))


def cell_ids(boxes: DataFrame) -> DataFrame:
    """(cell_id) of one-degree cells that boxes (xmin, ymin, xmax, ymax) cross, like N21_E103."""
    lat = F.explode(F.sequence(F.floor("ymin"), F.ceil("ymax") - 1)).alias("lat")
    lon = F.explode(F.sequence(F.floor("xmin"), F.ceil("xmax") - 1)).alias("lon")
    each = boxes.select("xmin", "xmax", lat).select("lat", lon)
    name = F.format_string("%s%02d_%s%03d", F.when(F.col("lat") >= 0, "N").otherwise("S"), F.abs("lat"), F.when(F.col("lon") >= 0, "E").otherwise("W"), F.abs("lon"))
    return each.select(name.alias("cell_id")).distinct()


def select_online_product(products: DataFrame, dataset: str, product_type: str) -> tuple[DataFrame, DataFrame]:
    """(chosen, problems): cells with exactly one online product of the dataset and type; other cells with their number."""
    fit = products.withColumn("fits", F.col("online") & (F.col("dataset") == dataset) & (F.col("product_type") == product_type))
    counts = fit.groupBy("cell_id").agg(F.count_if("fits").alias("online_products"))
    chosen = fit.filter("fits").join(counts.filter("online_products = 1"), "cell_id", "left_semi").drop("fits")
    return chosen, counts.filter("online_products != 1")
