"""A keyed table in buckets by hash of the key: an upsert rewrites the buckets it touches and no others.

A manifest names the folder that holds each bucket. Manifests are numbered and moved to their place whole, so the highest number is the table; a batch that is cut short leaves nothing
that is read. Folders that neither the new manifest nor the one before names are deleted, so readers of the last version can finish.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.catalog import upsert_latest
from .io import _paths

BUCKETS = 64
MANIFEST = "bucket int, place string, buckets int"


def _versions(spark: SparkSession, path: str) -> list[int]:
    fs, root = _paths(spark, f"{path}/manifests")
    if not fs.exists(root):
        return []
    return sorted(int(s.getPath().getName().removeprefix("v")) for s in fs.listStatus(root) if s.getPath().getName().startswith("v"))


def _manifest(spark: SparkSession, path: str, version: int) -> tuple[dict[int, str], int]:
    """(place of each bucket, number of buckets): as many rows as buckets at most."""
    rows = spark.read.schema(MANIFEST).parquet(f"{path}/manifests/v{version}").collect()
    return {r["bucket"]: r["place"] for r in rows}, rows[0]["buckets"] if rows else BUCKETS


def read_buckets(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """The table as its newest manifest has it; ``schema`` is needed while it has no rows."""
    path = path.rstrip("/")
    places = _manifest(spark, path, versions[-1])[0] if (versions := _versions(spark, path)) else {}
    if not places:
        if schema is None:
            raise ValueError(f"{path} holds no rows and no schema is given")
        return spark.createDataFrame([], schema)
    return spark.read.parquet(*[f"{path}/{p}" for _, p in sorted(places.items())])


def upsert_buckets(updates: DataFrame, path: str, key: str = "asset_id", buckets: int = BUCKETS) -> list[int]:
    """Apply ``updates`` (key, ..., sequence) as ``upsert_latest`` does; the buckets that were rewritten. The number of buckets is that of the first batch. One writer at a time."""
    spark, path = updates.sparkSession, path.rstrip("/")
    versions = _versions(spark, path)
    places, buckets = _manifest(spark, path, versions[-1]) if versions else ({}, buckets)
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
    touched = sorted(r["bucket"] for r in updates.select(bucket.alias("bucket")).distinct().collect())  # at most ``buckets``
    if not touched:
        return []
    names = [c for c in updates.columns if c != "sequence"]
    old = [f"{path}/{places[b]}" for b in touched if b in places]
    before = spark.read.parquet(*old).select(names) if old else updates.select(names).limit(0)
    data = f"data/{uuid.uuid4().hex}"
    upsert_latest(before, updates, key).withColumn("bucket", bucket).repartition("bucket").sortWithinPartitions("bucket", key).write.partitionBy("bucket").parquet(f"{path}/{data}")
    now = places | {b: f"{data}/bucket={b}" for b in touched}
    version = versions[-1] + 1 if versions else 1
    staging = f"{path}/staging-{uuid.uuid4().hex}"
    spark.createDataFrame([(b, p, buckets) for b, p in sorted(now.items())], MANIFEST).coalesce(1).write.parquet(staging)
    fs, made, target, root = _paths(spark, staging, f"{path}/manifests/v{version}", f"{path}/manifests")
    fs.mkdirs(root)
    if fs.exists(target) or not fs.rename(made, target):
        raise OSError(f"{staging} could not be moved to {target}")
    _clean(spark, path, version, set(places.values()) | set(now.values()))
    return touched


def _clean(spark: SparkSession, path: str, version: int, used: set[str]) -> None:
    """Delete bucket folders that aren't ``used`` and manifests before the last but one."""
    fs, data = _paths(spark, f"{path}/data")
    for batch in fs.listStatus(data):
        kept = 0
        for place in fs.listStatus(batch.getPath()):
            name = place.getPath().getName()
            if not name.startswith("bucket="):
                continue
            if f"data/{batch.getPath().getName()}/{name}" in used:
                kept += 1
            else:
                fs.delete(place.getPath(), True)
        if not kept:
            fs.delete(batch.getPath(), True)
    for v in _versions(spark, path):
        if v < version - 1:
            fs.delete(_paths(spark, f"{path}/manifests/v{v}")[1], True)
