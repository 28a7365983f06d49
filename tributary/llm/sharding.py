"""Sharding by fixed virtual slots and a stored, versioned slot-to-shard map.

Every record is hashed by its id and text into one of ``slots`` virtual slots, which never change; rows that repeat one record are dealt to slots of their own, so no slot holds more than
its share whatever repeats. Bytes are aggregated per
slot, and only the map from slots to shards, a few thousand rows, is planned on the driver. The map is
stored with a version; ``rebalance`` edits it slot by slot, so that a new version moves few records. The
law that holds is ``bytes``: sums of sizes per shard are near equal.

Defined results: size is the UTF-8 length of the text plus ``OVERHEAD``; a null text has no bytes. A null
id leaves the text to be hashed. Repeated rows all keep their own place; ties within a slot go by id, checksum and size, and rows that tie in all are alike. A long text is one record of its size. An empty table gives an
empty result, extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import heapq
import uuid
from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialise, shared_dir, table

SLOTS, SHARDS, OVERHEAD = 4096, 40, 16
MAP_SCHEMA = "version int, slot int, shard int, slot_bytes long, slot_rows long, first long"


def slotted(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """(doc_id, size, text_crc32, vslot) of each row."""
    text = F.coalesce("text", F.lit(""))
    base = docs.select(
        "doc_id",
        (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64("doc_id", F.xxhash64(text)).alias("record"),
        F.monotonically_increasing_id().alias("row"),
    )
    base = materialise(base, "records")
    repeated = materialise(base.groupBy("record").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1").select("record", F.lit(True).alias("again")), "repeated")
    key = F.col("record")
    if not repeated.isEmpty():
        base = base.join(repeated, "record", "left")
        key = F.when(F.col("again"), F.xxhash64("record", "row")).otherwise(key)
    return base.select("doc_id", "size", "text_crc32", F.pmod(key, F.lit(slots)).cast("int").alias("vslot"))


def slot_weights(rows: DataFrame) -> list[tuple[int, int, int]]:
    """(slot, bytes, rows) of the slots in use: as many rows as there are slots at most."""
    got = rows.groupBy("vslot").agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n")).collect()
    return sorted((r["vslot"], r["b"], r["n"]) for r in got)


def plan(weights: list[tuple[int, int, int]], shards: int = SHARDS) -> dict[int, int]:
    """A first map: the heaviest slots first, each to the lightest shard."""
    load = [(0, s) for s in range(shards)]
    out = {}
    for slot, b, _ in sorted(weights, key=lambda w: (-w[1], w[0])):
        had, s = heapq.heappop(load)
        out[slot] = s
        heapq.heappush(load, (had + b, s))
    return out


def rebalance(old: dict[int, int], weights: list[tuple[int, int, int]], shards: int, tolerance: float = 0.02) -> dict[int, int]:
    """Edit a map for new weights or another number of shards, moving as few slots as needed.

    Slots of shards that are gone and slots not seen before go to the lightest shard; then shards above
    the mean by more than ``tolerance`` give slots to the lightest one while that lessens the larger of both.
    """
    size = {slot: b for slot, b, _ in weights}
    out = {k: s for k, s in old.items() if k in size and s < shards}
    load, members = [0] * shards, defaultdict(list)
    for k, s in out.items():
        load[s] += size[k]
        members[s].append(k)
    for k in sorted(set(size) - set(out), key=lambda k: (-size[k], k)):
        s = min(range(shards), key=lambda s: (load[s], s))
        out[k] = s
        load[s] += size[k]
        members[s].append(k)
    mean = sum(size.values()) / max(shards, 1)
    while True:
        high, low = max(range(shards), key=lambda s: load[s]), min(range(shards), key=lambda s: load[s])
        if load[high] <= mean * (1 + tolerance):
            return out
        fits = [k for k in members[high] if load[low] + size[k] < load[high] and size[k] > 0]
        if not fits:
            return out
        gap = min(load[high] - mean, mean - load[low])
        k = min(fits, key=lambda k: (abs(size[k] - gap), k))
        members[high].remove(k)
        members[low].append(k)
        load[high] -= size[k]
        load[low] += size[k]
        out[k] = low


def store_map(spark: SparkSession, path: str, version: int, to: dict[int, int], weights: list[tuple[int, int, int]]) -> None:
    """Append a version to the map table. ``first``: the rows of the shard that stand before the slot's."""
    before, rows = defaultdict(int), []
    for slot, b, n in weights:
        rows.append((version, slot, to[slot], b, n, before[to[slot]]))
        before[to[slot]] += n
    spark.createDataFrame(rows, MAP_SCHEMA).coalesce(1).write.mode("append").partitionBy("version").parquet(path)


def load_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """A version of the map, the newest if none is named."""
    stored = spark.read.schema(MAP_SCHEMA).parquet(path)
    if version is None:
        version = stored.agg(F.max("version")).first()[0]
    return stored.filter(F.col("version") == version)


def place(rows: DataFrame, slot_map: DataFrame) -> DataFrame:
    """Add shard and the place in it, gapless from 0. The map has a row per slot at most, so it is broadcast."""
    within = F.row_number().over(Window.partitionBy("vslot").orderBy("doc_id", "text_crc32", "size")) - 1
    small = F.broadcast(slot_map.select(F.col("slot").alias("vslot"), "shard", "first"))
    return rows.withColumn("within", within).join(small, "vslot").withColumn("slot", (F.col("first") + F.col("within")).cast("long"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = slotted(table(spark, sf_dir, "documents"))
    weights = slot_weights(rows)
    path = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/slot-map-{uuid.uuid4().hex}"
    store_map(spark, path, 1, plan(weights), weights)
    placed = place(rows, load_map(spark, path))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), F.col("vslot").alias("virtual_slot")
    )


QUERIES = {"op5_sharding": op5_sharding}
ORACLE_SQL: dict[str, str] = {}
