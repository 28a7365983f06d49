"""Exact deduplication by skew-safe combining, in DataFrame functions only.

Rows are grouped three times and every grouping key holds the whole text, so equal digests alone never
make two texts equal:

1. in the mapper: the partial aggregation of the first grouping leaves one row per text and task;
2. by (digest, salt, text): the copies of one text meet in at most ``salts`` places;
3. by (digest, text): at most ``salts`` winners of each text meet in one place.

No list of members is ever built; rows find their class by an equi-join of ids and digests, which adaptive
execution splits where a digest is hot. Only where the row that stays is repeated, its repetitions are numbered, per salt first.

Defined results: a null text counts as empty. A null id ranks below all others. Rows with equal text and
equal id are repetitions of one row: all count in ``group_size``, exactly one is kept. Long texts are compared whole. An empty table
gives an empty result. Extra columns are ignored by ``annotate`` and carried along by ``keep_one``,
whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialise, table

SALTS = 16


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def winners(keyed: DataFrame, salts: int = SALTS) -> DataFrame:
    """(digest, text, keep_id, group_size) of each distinct text of (doc_id, text, digest)."""
    local = keyed.withColumn("salt", F.spark_partition_id() % salts)
    salted = local.groupBy("digest", "salt", "text").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("n"))
    return salted.groupBy("digest", "text").agg(F.max("keep_id").alias("keep_id"), F.sum("n").alias("group_size"))


def annotate(docs: DataFrame, digest: Callable[[Column], Column] = sha256, salts: int = SALTS) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, digest) for each row of ``docs`` (doc_id, text, ...).

    ``digest`` may be weak: digests that several texts share are told apart by the texts themselves.
    """
    keyed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("digest", digest(F.col("text")))
    found = winners(keyed, salts)
    classes = materialise(
        found.groupBy("digest").agg(F.count(F.lit(1)).alias("contents"), F.max("keep_id").alias("keep_id"), F.max("group_size").alias("group_size")),
        "classes",
    )
    parts = keyed.select("doc_id", "digest").join(classes.filter("contents = 1").drop("contents"), "digest").withColumn("text", F.lit(None).cast("string"))
    shared = classes.filter("contents > 1")
    if not shared.isEmpty():
        both = keyed.join(shared.select("digest"), "digest", "left_semi")
        parts = parts.unionByName(both.join(found, ["digest", "text"]))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    out = parts.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "digest", "text")
    repeated = materialise(parts.filter(kept).groupBy("digest", "text").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.col("digest").alias("d"), F.col("text").alias("t")), "repeated")
    if repeated.isEmpty():
        return out.drop("text")
    again = F.col("kept") & (F.col("digest") == F.col("d")) & F.col("text").eqNullSafe(F.col("t"))
    salted = out.join(repeated, again, "left_semi").withColumn("salt", F.spark_partition_id() % salts)
    first = salted.withColumn("nth", F.row_number().over(Window.partitionBy("digest", "text", "salt").orderBy("doc_id")))
    least = F.row_number().over(Window.partitionBy("digest", "text").orderBy("salt"))  # a row a salt at most
    winner = first.filter("nth = 1").withColumn("nth", least).withColumn("kept", F.col("nth") == 1)
    rest = first.filter("nth > 1").withColumn("kept", F.lit(False))
    names = ["doc_id", "keep_id", "group_size", "kept", "digest"]
    return out.join(repeated, again, "left_anti").select(names).unionByName(winner.select(names)).unionByName(rest.select(names))


def keep_one(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """One row of ``docs``, with all its columns, per distinct text: the one with the largest id."""
    row = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)])
    keyed = docs.select(
        F.coalesce("text", F.lit("")).alias("content"),
        F.struct("doc_id", F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns if c != "text"])).alias("rank"),
        row.dropFields(f"c{docs.columns.index('text')}").alias("row"),
        F.col("text").isNull().alias("void"),
    )
    keyed = keyed.withColumn("digest", sha256(F.col("content"))).withColumn("salt", F.spark_partition_id() % salts)
    best = lambda df, *key: df.groupBy(*key).agg(F.max_by(F.struct("row", "void", "rank"), "rank").alias("best")).select(*[k for k in key if k != "salt"], "best.*")
    last = best(best(keyed, "digest", "salt", "content"), "digest", "content")
    text = F.when(~F.col("void"), F.col("content"))
    return last.select(*[(text if c == "text" else F.col(f"row.c{i}")).alias(c) for i, c in enumerate(docs.columns)])


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return annotate(table(spark, sf_dir, "documents")).withColumnRenamed("digest", "text_sha256")


QUERIES = {"op4_exact_dedup": op4_exact_dedup}
ORACLE_SQL = {
    "op4_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, sha256(coalesce("text", '')) AS text_sha256
        FROM documents WINDOW w AS (PARTITION BY coalesce("text", ''))""",
}
