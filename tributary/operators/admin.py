"""Administrative units: crosswalk between old and current units, places of dated events, basin topology and parents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..sources.scratch import materialise
from . import geometry
from .joins import large

VIABLE = 0.95
REFORM = "2025-07-01"
FORMER = " (cũ)"


def filter_province(units: DataFrame, name: str, column: str = "province") -> DataFrame:
    """Units of one province by normalized label; none is an error."""
    out = units.filter(T.normalize_label(F.col(column)) == T.normalize_label(F.lit(name)))
    if out.isEmpty():
        raise ValueError(f"no unit of province {name}")
    return out


def unit_aliases(index: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(aliases, conflicts) of an index (magoc, ma, malk): the five-digit code and ``malk`` name a code; an alias of two codes is a conflict. Rows without ``ma`` are left out."""
    pairs = index.filter("ma IS NOT NULL").select(T.zfill5(F.col("ma")).alias("code"), F.explode(F.array(F.col("malk").cast("string"), T.zfill5(F.col("ma")))).alias("alias")).filter("alias IS NOT NULL").distinct()
    bad = pairs.groupBy("alias").agg(F.count(F.lit(1)).alias("codes")).filter("codes > 1")
    return pairs.join(bad, "alias", "left_anti"), bad


def join_identity(geometry_rows: DataFrame, aliases: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with code, rows without): the code by raw id, else by padded id."""
    raw = aliases.select(F.col("alias").alias("raw_id"), F.col("code").alias("code_raw"))
    padded = aliases.select(F.col("alias").alias("padded_id"), F.col("code").alias("code_padded"))
    rows = geometry_rows.withColumns({"raw_id": F.col("unit_id").cast("string"), "padded_id": T.zfill5(F.col("unit_id"))})
    rows = rows.join(raw, "raw_id", "left").join(padded, "padded_id", "left").withColumn("code", F.coalesce("code_raw", "code_padded")).drop("raw_id", "padded_id", "code_raw", "code_padded")
    return rows.filter("code IS NOT NULL"), rows.filter("code IS NULL")


def build_crosswalk(current: DataFrame, current_edges: DataFrame, old: DataFrame, old_edges: DataFrame, viable: float = VIABLE, cell: float = geometry.CELL, composed: bool = False) -> DataFrame:
    """Old units to current ones, where name and overlap agree.

    ``current``: feature_id, code, name, predecessors; ``old``: feature_id, old_id, old_name, valid_to. One viable candidate: matched; several: ambiguous; none:
    unresolved. Old units that are viable for more than one code make all rows that count on them ambiguous.
    """
    named, _ = T.explode_predecessors(current, "predecessors", composed)
    named = named.withColumn("row_id", F.concat_ws("\0", "code", "position"))
    olds = old.withColumn("normalized", T.normalize_unit_name(F.col("old_name"), composed)).select(F.col("feature_id").alias("old_feature"), "old_id", "old_name", "valid_to", "normalized")
    area = geometry.overlay_area(old_edges, current_edges, cell).select(F.col("zone_id").alias("old_feature"), F.col("unit_id").alias("feature_id"), (F.col("intersection_area_km2") * 1e6).alias("overlap_area"), F.col("zone_fraction").alias("overlap_fraction"))
    pair = named.select("row_id", "feature_id", "normalized").join(large(olds), "normalized").join(large(area), ["old_feature", "feature_id"], "left").fillna(0.0, ["overlap_area", "overlap_fraction"])
    metric = F.struct("old_id", "overlap_fraction", "overlap_area")
    good = F.col("overlap_fraction") >= viable
    found = pair.groupBy("row_id").agg(
        F.array_sort(F.collect_list(metric)).alias("metrics"), F.array_sort(F.collect_set(F.when(good, F.col("old_id")))).alias("viable_ids"),
        F.min_by(F.struct("old_id", "old_name", "valid_to"), F.when(good, F.col("old_id"))).alias("best"), F.count(F.lit(1)).alias("candidates"), F.min("old_id").alias("only_id"))
    rows = named.join(large(materialise(found, "candidates")), "row_id", "left")
    n = F.coalesce(F.size("viable_ids"), F.lit(0))
    matched = n == 1
    rows = rows.withColumns({"n": n, "first_status": F.when(matched, "matched").when(n > 1, "ambiguous").otherwise("unresolved")})
    # the codes that count on each old id; a row without a code of its own adds the text None
    claims = rows.select(F.explode("viable_ids").alias("old_id"), F.when(F.col("n") == 1, F.col("code")).otherwise("None").alias("claimed")).distinct().groupBy("old_id").agg((F.count(F.lit(1)) > 1).alias("contested")).filter("contested")
    contested = rows.select("row_id", F.explode("viable_ids").alias("old_id")).join(large(claims.select("old_id")), "old_id").select("row_id").distinct().withColumn("contested", F.lit(True))
    rows = rows.join(large(contested), "row_id", "left").withColumn("contested", F.coalesce("contested", F.lit(False)))
    sure = (F.col("n") == 1) & ~F.col("contested")
    same = T.normalize_unit_name(F.col("name"), composed) == F.col("normalized")
    return rows.select(
        F.when(F.col("n") == 1, F.col("best.old_id")).when(F.col("candidates") == 1, F.col("only_id")).alias("old_admin_id"),
        F.when(F.col("n") == 1, F.col("best.old_name")).otherwise(T.strip_unit_prefix(F.col("written"), True)).alias("old_admin_name"),
        F.col("unit_type").alias("old_admin_type"), F.col("normalized").alias("old_admin_normalized_name"),
        F.when(sure, F.col("code")).alias("current_commune_code"), F.when(sure, F.col("name")).alias("current_commune_name"),
        F.when(sure, F.when(same, "unchanged").otherwise("merged")).alias("relationship_type"),
        F.when(F.col("contested"), "ambiguous").otherwise(F.col("first_status")).alias("match_status"),
        F.when(F.col("n") == 1, F.col("best.valid_to")).alias("valid_to"),
        F.coalesce(F.transform("metrics", lambda m: m["old_id"]), F.array().cast("array<string>")).alias("candidate_old_admin_ids"), "metrics",
        F.col("code").alias("source_code"), "position")


def place_grams(events: DataFrame, place: str, longest: int) -> DataFrame:
    """(event_id, gram, former): runs of up to ``longest`` words of the place text; a separator other than one space breaks a run.

    ``former``: somewhere in the text the run is followed by the mark of a former unit.
    """
    folded = F.regexp_replace(F.lower(T.collapse(F.col(place))), T.UNIT_PREFIX, "")
    chunks = events.select("event_id", folded.alias("folded")).select("event_id", "folded", F.explode(F.split("folded", r"(?U)[^\w ]+| {2,}")).alias("chunk"))
    words = chunks.select("event_id", "folded", F.filter(F.split(F.trim("chunk"), " "), lambda w: w != "").alias("w")).filter(F.size("w") > 0)
    starts = words.select("event_id", "folded", "w", F.explode(F.sequence(F.lit(1), F.size("w"))).alias("i"))
    spans = starts.select("event_id", "folded", "w", "i", F.explode(F.sequence(F.lit(1), F.least(F.lit(longest), F.size("w") - F.col("i") + 1))).alias("n"))
    gram = F.array_join(F.slice("w", F.col("i"), F.col("n")), " ")
    return spans.select("event_id", gram.alias("gram"), F.col("folded").contains(F.concat(gram, F.lit(FORMER))).alias("former")).distinct()


def resolve_places(events: DataFrame, current: DataFrame, crosswalk: DataFrame, composed: bool = False) -> DataFrame:
    """Events (event_id, place, start date) against the units valid on their day.

    Names are runs of words of the place text, found by equi-join; names with other signs than words and single spaces are found by their first word and then compared by containment.
    """
    now = current.select(T.normalize_unit_name(F.col("name"), composed).alias("gram"), T.zfill5(F.col("code")).alias("code"), F.lit(False).alias("unsure"), F.lit("current").alias("regime"))
    then = crosswalk.filter(F.col("match_status").isin("matched", "ambiguous")).filter("current_commune_code IS NOT NULL OR match_status = 'ambiguous'").select(
        T.normalize_unit_name(F.col("old_admin_name"), composed).alias("gram"), T.zfill5(F.col("current_commune_code")).alias("code"), (F.col("match_status") == "ambiguous").alias("unsure"), F.lit("historical").alias("regime"))
    lookup = materialise(now.unionByName(then).groupBy("regime", "gram").agg(F.array_sort(F.collect_set("code")).alias("codes"), F.max("unsure").alias("unsure")), "lookup")
    longest = lookup.agg(F.max(F.size(F.split("gram", " ")))).first()[0] or 1
    reform = F.lit(REFORM).cast("date")
    dated = events.withColumn("regime", F.when(F.col("start") < reform, "historical").when(F.col("start").isNotNull(), "current"))
    plain = lookup.filter(F.col("gram").rlike(r"(?U)^[\w]+( [\w]+)*$"))
    grams = place_grams(dated.filter("regime IS NOT NULL AND place IS NOT NULL"), "place", longest).join(large(dated.select("event_id", "regime")), "event_id")
    hits = grams.join(large(plain), ["regime", "gram"]).filter("regime = 'historical' OR NOT former").select("event_id", "gram", "codes", "unsure")
    first = F.regexp_extract("gram", r"(?U)(\w+)", 1)  # a whole word wherever the name stands; empty for a name of signs only
    odd = materialise(lookup.filter(~F.col("gram").rlike(r"(?U)^[\w]+( [\w]+)*$")).withColumn("word", first), "odd")
    if not odd.isEmpty():
        folded = F.regexp_replace(F.lower(T.collapse(F.col("place"))), T.UNIT_PREFIX, "")
        words = F.array_distinct(F.concat(F.array(F.lit("")), F.regexp_extract_all("folded", F.lit(r"(?U)(\w+)"), F.lit(1))))
        near = dated.select("event_id", "regime", folded.alias("folded")).filter("regime IS NOT NULL AND folded IS NOT NULL").withColumn("word", F.explode(words)).join(large(odd), ["regime", "word"])
        quoted = F.concat(F.lit(r"(?U)(?<![\w])\Q"), "gram", F.lit(r"\E(?![\w])"))
        extra = near.filter(F.regexp_like("folded", quoted)).filter(F.expr("regime = 'historical'") | ~F.col("folded").contains(F.concat("gram", F.lit(FORMER)))).select("event_id", "gram", "codes", "unsure")
        hits = hits.unionByName(extra)
    sums = hits.distinct().groupBy("event_id").agg(F.array_sort(F.collect_set("gram")).alias("names"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("codes")))).alias("codes"), F.min((F.size("codes") == 1) & ~F.col("unsure")).alias("one_each"), F.max("unsure").alias("any_unsure"))
    out = dated.join(large(sums), "event_id", "left")
    status = F.when(F.coalesce("one_each", F.lit(False)), "matched").when((F.coalesce(F.size("codes"), F.lit(0)) > 0) | F.coalesce("any_unsure", F.lit(False)), "ambiguous").otherwise("unresolved")
    empty = F.array().cast("array<string>")
    out = out.withColumn("match_status", status).withColumns({"names": F.coalesce("names", empty), "codes": F.coalesce("codes", empty)})
    return out.drop("one_each", "any_unsure").withColumn("match_confidence", F.expr("CASE match_status WHEN 'matched' THEN 1.0D WHEN 'ambiguous' THEN 0.5D ELSE 0.0D END"))


def select_with_upstream(basins: DataFrame, core: DataFrame, hops: int) -> DataFrame:
    """(basin_id, hop): the core set and all basins up to ``hops`` steps upstream along next_down, each at its fewest hops; repeated ids of basins are an error.

    A hop joins the last frontier with the basins and is written to the shared folder, so the plan of a hop doesn't hold those before; it ends early where nothing lies further up.
    """
    if hops < 0:
        raise ValueError("hops must not be negative")
    if not (repeated := basins.groupBy("basin_id").count().filter("count > 1")).isEmpty():
        raise ValueError(f"repeated basin: {repeated.first()['basin_id']}")
    links = basins.select("basin_id", "next_down")
    front = seen = materialise(core.select("basin_id").distinct().withColumn("hop", F.lit(0)), "upstream")
    for hop in range(1, hops + 1):
        step = links.join(front.select(F.col("basin_id").alias("next_down")), "next_down", "left_semi").select("basin_id").join(seen, "basin_id", "left_anti")
        front = materialise(step.withColumn("hop", F.lit(hop)), "front")
        if front.isEmpty():
            break
        seen = seen.unionByName(front)
        if hop % 8 == 0:
            seen = materialise(seen, "upstream")  # one table instead of nine
    return seen


def assign_parents(children: DataFrame, child_edges: DataFrame, parents: DataFrame, parent_edges: DataFrame, cell: float = geometry.CELL) -> DataFrame:
    """(basin_id, parent_id, covering, code_ok): the parent that covers a child's interior point; ``covering`` other than one, or a code that doesn't start with the parent's, is a violation."""
    at = geometry.interior_point(child_edges).withColumnRenamed("feature_id", "point_id")
    cover = geometry.join_points_zones(at, parent_edges, cell).groupBy(F.col("point_id").alias("basin_id")).agg(F.count(F.lit(1)).alias("covering"), F.min("zone_id").alias("parent_id"))
    out = children.select("basin_id", "code").join(cover, "basin_id", "left").fillna(0, ["covering"])
    out = out.join(parents.select(F.col("basin_id").alias("parent_id"), F.col("code").alias("parent_code")), "parent_id", "left")
    return out.select("basin_id", F.when(F.col("covering") == 1, F.col("parent_id")).alias("parent_id"), "covering", F.coalesce(F.col("code").startswith(F.col("parent_code")), F.lit(False)).alias("code_ok"))


def scope_exits(basins: DataFrame) -> DataFrame:
    """``basins`` (basin_id, next_down) with scope_exit: the basin downstream isn't selected, or none is named; 0 is the sea."""
    ids = basins.select(F.col("basin_id").alias("next_down")).distinct().withColumn("__in", F.lit(True))
    return basins.join(ids, "next_down", "left").withColumn("scope_exit", F.col("next_down").isNull() | ((F.col("next_down") != 0) & F.col("__in").isNull())).drop("__in")


def unit_counts(units: DataFrame) -> DataFrame:
    """One row: total, wards, communes, other, unique codes."""
    kind = T.classify_unit(F.col("name"))
    return units.agg(F.count(F.lit(1)).alias("total"), F.count_if(kind == "ward").alias("wards"), F.count_if(kind == "commune").alias("communes"), F.count_if(kind.isNull()).alias("other"), F.countDistinct("code").alias("unique_codes"))


def subset_by_keys(atlas: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return atlas.join(ids.select(key), key, "left_semi")


def join_attributes(df: DataFrame, atlas: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """A 1:1 left join of atlas fields; null or infinite fields and repeated keys of the atlas are errors, found in one aggregate."""
    bad = F.lit(False)
    for f in fields:
        bad = bad | F.col(f).isNull() | F.isnan(F.col(f).cast("double")) | (F.abs(F.col(f).cast("double")) == float("inf"))
    want = subset_by_keys(atlas, df, key).select(key, *fields)
    n, ids, wrong = want.agg(F.count(F.lit(1)), F.countDistinct(key), F.count_if(bad)).first()
    if n != ids or wrong:
        raise ValueError(f"attributes: {n - ids} repeated keys, {wrong} rows with missing fields")
    return df.join(want, key, "left")


def null_if_empty(col: Column) -> Column:
    return F.nullif(F.trim(col), F.lit(""))


def part_numbers(df: DataFrame, key: str, order: str) -> DataFrame:
    return df.withColumn("part_index", F.row_number().over(Window.partitionBy(key).orderBy(order)) - 1)


def study_areas(basins: DataFrame, edges: DataFrame, core: DataFrame, country: DataFrame, hops: int = 1, distance: float = 10_000.0, cell: float = geometry.CELL) -> DataFrame:
    """(area, basin_id): membership of basins (basin_id, next_down) in the four areas.

    core: basins that meet the core; hydrological: those and ``hops`` steps upstream; environmental: within ``distance`` of the core; exposure: of these, those that meet the country. An empty area is an error.
    """
    meets = geometry.semi_intersects(edges, core, cell).select(F.col("feature_id").alias("basin_id"))
    near = geometry.polygons_within(edges, core, distance, cell).select(F.col("feature_id").alias("basin_id"))
    inside = geometry.semi_intersects(edges, country, cell).select(F.col("feature_id").alias("basin_id"))
    areas = {"core": meets, "hydrological": select_with_upstream(basins, meets, hops).select("basin_id"), "environmental": near, "exposure": near.join(inside, "basin_id", "left_semi")}
    out = None
    for name, ids in areas.items():
        part = ids.select(F.lit(name).alias("area"), "basin_id")
        out = part if out is None else out.unionByName(part)
    found = {r["area"] for r in out.groupBy("area").count().collect()}  # four rows
    if missing := [a for a in areas if a not in found]:
        raise ValueError(f"empty areas: {missing}")
    return out
