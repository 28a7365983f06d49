"""One checked row per basin, and fingerprints of content."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Groups of the profile and words that would leak outcomes.
REQUIRED, OPTIONAL = ("terrain", "soil", "landcover", "hydrology"), ("population",)
LEAKS = ("event", "label", "outcome", "status")


def check_table(df: DataFrame, ids: DataFrame, key: str, complete: bool) -> None:
    """Raise unless keys are whole and unique, all selected, and (``complete``) none is missing; one aggregate."""
    own = df.select(F.col(key).alias("k"), F.lit(True).alias("own"))
    marked = own.join(ids.select(F.col(key).alias("k"), F.lit(True).alias("sel")).distinct(), "k", "full_outer")
    mine = lambda test: F.count_if(F.col("own").isNotNull() & test)
    n, distinct, odd, outside, missing = marked.agg(
        F.count("own"), F.countDistinct(F.when(F.col("own"), F.col("k"))), mine(F.col("k").isNull() | (F.col("k") != F.floor(F.col("k").cast("double")))), mine(F.col("sel").isNull()), F.count_if(F.col("own").isNull())).first()
    if odd or n != distinct:
        raise ValueError(f"{key}: {odd} keys aren't whole, {n - distinct} repeated")
    if outside or complete and missing:
        raise ValueError(f"{key}: {outside} keys outside the selection, {missing} missing")


def leaking_columns(columns: list[str]) -> list[str]:
    return [c for c in columns if set(re.split("[_-]", c.lower())) & set(LEAKS)]


def assemble_profile(basins: DataFrame, tables: dict[str, DataFrame], run_id: str, sources: dict[str, list[str]] | None = None, key: str = "basin_id") -> DataFrame:
    """Exactly one row per basin: feature groups joined 1:1, with run, content fingerprint, sources per group and flags for missing optional groups."""
    if bad := set(tables) - {*REQUIRED, *OPTIONAL}:
        raise ValueError(f"unknown groups: {sorted(bad)}")
    if bad := set(REQUIRED) - set(tables):
        raise ValueError(f"missing groups: {sorted(bad)}")
    seen = set(basins.columns)
    out, flags = basins, []
    for name, df in tables.items():
        own = [c for c in df.columns if c != key]
        if leaks := leaking_columns(own):
            raise ValueError(f"{name}: columns that may leak outcomes: {leaks}")
        if clash := seen & set(own):
            raise ValueError(f"{name}: repeated columns: {sorted(clash)}")
        check_table(df, basins, key, name in REQUIRED)
        seen |= set(own)
        marked = df.withColumn(f"__{name}", F.lit(True))
        out = out.join(marked, key, "left")
        if name in OPTIONAL:
            flags.append(F.when(F.col(f"__{name}").isNull(), f"missing_{name}_observation"))
    flagged = F.filter(F.array(*flags), lambda f: f.isNotNull()) if flags else F.array().cast("array<string>")
    print_ = content_fingerprint({"basins": basins, **tables}, key)
    extra = {"run_id": F.lit(run_id), "content_fingerprint": F.lit(print_), "quality_flags": flagged}
    extra |= {f"{n}_source_ids": F.array(*[F.lit(s) for s in sorted(ids)]) for n, ids in (sources or {}).items()}
    return out.withColumns(extra).drop(*[f"__{n}" for n in tables])


def row_digests(df: DataFrame, key: str) -> DataFrame:
    """(key, digest) of each row's content, columns in order of name."""
    return df.select(key, F.sha2(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}), 256).alias("digest"))


def content_fingerprint(tables: dict[str, DataFrame], key: str, buckets: int = 4096) -> str:
    """One sha256 of all tables; the order of rows and tables doesn't matter.

    Rows are digested where they are; digests are sorted and digested within buckets of their key, and at most ``buckets`` digests a table meet at the end.
    """
    parts = []
    for name, df in sorted(tables.items()):
        rows = row_digests(df, key).withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)))
        digest = rows.groupBy("bucket").agg(F.sha2(F.array_join(F.array_sort(F.collect_list("digest")), ","), 256).alias("digest"))
        parts.append(digest.select(F.lit(name).alias("name"), "bucket", "digest"))
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    ordered = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("name", "bucket", "digest"))), lambda d: F.concat_ws(":", d["name"], d["bucket"], d["digest"])), ",")
    return every.agg(F.sha2(ordered, 256)).first()[0]


def join_warnings(entities: DataFrame, mapping: DataFrame, key: str) -> DataFrame:
    """``entities`` with warning: a flag, a boundary case, a repaired geometry or ties, there or in the mapping."""
    from ..functions.text import evidence_truthy

    def own(df: DataFrame):
        cond = F.lit(False)
        for c, t in df.dtypes:
            if c in ("boundary_case", "geometry_repaired", "nearest_boundary_tie"):
                cond = cond | F.coalesce(F.col(c), F.lit(False))
            elif c in ("ties", "boundary_ties"):
                cond = cond | F.coalesce(F.col(c) > 0, F.lit(False))
            elif c == "quality_flags":
                cond = cond | (evidence_truthy(F.col(c)) if t == "string" else F.coalesce(F.size(c) > 0, F.lit(False)))
        return cond

    hit = mapping.groupBy(key).agg(F.max(own(mapping)).alias("__mapped"))
    return entities.withColumn("__own", own(entities)).join(hit, key, "left").withColumn("warning", F.col("__own") | F.coalesce("__mapped", F.lit(False))).drop("__own", "__mapped")


PREFERRED_KEYS = ("basin_id", "unit_id", "line_id", "point_id", "asset_id")


def warning_key(entities: DataFrame, mapping: DataFrame) -> str:
    """The first preferred column that both have; else the shared column with the most distinct values among the entities."""
    shared = [c for c in entities.columns if c in mapping.columns]
    for c in PREFERRED_KEYS:
        if c in shared:
            return c
    if not shared:
        raise ValueError("no shared column")
    counts = entities.agg(*[F.countDistinct(c).alias(c) for c in shared]).first()
    return max(shared, key=lambda c: counts[c])
