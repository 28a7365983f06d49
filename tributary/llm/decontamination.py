"""Benchmark decontamination: a prefix-filtered set join of item windows with documents, in DataFrame functions only.

Every window of ``window`` consecutive words of an item is a set of ``shingle``-word shingles, each with its place in the window. An item with fewer
words is one window, and a window with fewer words than a shingle is one shingle of its own length. The join has four steps:

1. all shingles of the documents meet the shingles of the items; only those that occur in an item go on (``found``), and they give each shingle its rarity over all documents;
2. the shingles of a window are ordered by rarity. Where at least ``share`` of its m shingles must be in place, one of its first ``m - ceil(share * m) + 1`` must
   be, so only these prefix tokens are joined with ``found``;
3. a candidate is a window laid so that the shingle lies on its match. Bounds: it must start at the first word or later and end by the last one;
4. candidates of a text are compared with its words, item-sized stretch by window, so a shared hash never counts. Equal texts are compared once.

The texts are read twice, once for shingles and once for the comparison; the second time only those with a candidate are cut into words. Items and prefix tokens are broadcast up to
``BROADCAST`` shingles, digests of texts with a candidate up to ``BROADCAST_TEXTS``, which are counted first; above that the joins shuffle. A hot passage makes a hot shingle on the side of the documents only, a group of copies a hot digest there; adaptive
execution splits both. No task holds more than one text with its candidates.

Defined results: a null or empty text has no words and no hits; an item without words has no window. Words are compared with A-Z lower-cased. Rows with an equal
id are judged each by its own text, items with an equal id are one item, a null item id counts as an item with the empty id. Ties in rarity go by hash, then place. Long texts are
compared whole. Empty tables: no documents give no rows, no items leave all documents clean. Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialise, table

WINDOW, SHINGLE, SHARE = 10, 3, 1.0
BROADCAST, BROADCAST_TEXTS = 1_000_000, 200_000  # shingles, and digests of texts
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
NON_ASCII_CAPITAL = r"[[\p{IsUppercase}\p{Lt}]&&[^A-Z]]"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once a row."""
    return F.get(F.transform(F.array(value), lambda v: use(v)), F.lit(0))


def lower_ascii(text: Column) -> Column:
    """The text with A-Z lower-cased and nothing else; the plain function serves where it can't touch other letters."""
    return F.when(text.rlike(NON_ASCII_CAPITAL), F.translate(text, UPPER, UPPER.lower())).otherwise(F.lower(text))


def words(text: Column) -> Column:
    """The words of a text, which may be null."""
    def inner(parts: Column) -> Column:
        head = (F.get(parts, F.lit(0)) == "").cast("int")
        tail = ((F.size(parts) > 1) & (F.get(parts, F.size(parts) - 1) == "")).cast("int")
        return F.slice(parts, head + 1, F.size(parts) - head - tail)

    return let(F.split(lower_ascii(F.coalesce(text, F.lit(""))), GAP, -1), inner)


def hashed(parts: Column, at: Column, length: int) -> Column:
    """The hash of ``length`` words from place ``at``, from 0; past the end there are none."""
    return F.xxhash64(F.lit(length), *[F.get(parts, at + j) for j in range(length)])


def windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item_id string, win array of words) of the distinct windows of each item."""
    cut = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), words(F.col("text")).alias("w")).filter(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - (window - 1), F.lit(1)))
    return cut.select("item_id", "w", F.explode(starts).alias("i")).select("item_id", F.slice("w", F.col("i"), F.lit(window)).alias("win")).distinct()


def _needed(count: Column, share: float) -> Column:
    return F.greatest(F.ceil(F.lit(share) * count - 1e-9), F.lit(1))


def shingled(wins: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(win, place, length, h, m): the m shingles of each window."""
    lengths = F.least(F.size("win"), F.lit(shingle))
    placed = wins.select("win", lengths.alias("length"), (F.size("win") - lengths + 1).alias("m"))
    h = F.lit(None).cast("long")
    for n in range(1, shingle + 1):
        h = F.when(F.col("length") == n, hashed(F.col("win"), F.col("place"), n)).otherwise(h)
    return placed.select("*", F.explode(F.sequence(F.lit(0), F.col("m") - 1)).alias("place")).withColumn("h", h)


def _met(docs: DataFrame, tokens: DataFrame, lengths: list[int], small: bool) -> DataFrame:
    """(doc_id, digest, n_words, pos, h): pos 0 is the row of the document, others the places, from 1, of shingles in ``tokens`` (h)."""
    known = tokens.withColumn("known", F.lit(True))
    parts = []
    for i, n in enumerate(lengths or [1]):
        def listed(w: Column, n: int = n) -> Column:
            hashes = F.transform(w, lambda _, at: hashed(w, at, n))
            return F.struct(F.size(w).alias("n_words"), F.concat(F.array(F.lit(None).cast("long")), hashes).alias("hashes"))

        text = F.coalesce("text", F.lit(""))
        made = docs.select("doc_id", F.sha2(text, 256).alias("digest"), let(words(F.col("text")), listed).alias("s"))
        each = made.select("doc_id", "digest", F.col("s.n_words").alias("n_words"), F.posexplode("s.hashes").alias("pos", "h"))
        met = each.join(F.broadcast(known) if small else known, "h", "left")
        parts.append(met.filter((F.lit(i == 0) & (F.col("pos") == 0)) | F.col("known")).drop("known"))
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out


def _verified(docs: DataFrame, candidates: DataFrame, share: float, shingle: int) -> DataFrame:
    """(digest, hits array of (start, end, win)) of the texts that hold one of their candidates (digest, start, win), sorted."""
    listed = materialise(candidates.groupBy("digest").agg(F.collect_set(F.struct("start", "win")).alias("laid")), "candidates")
    near = listed.select("digest")
    near = F.broadcast(near) if listed.count() <= BROADCAST_TEXTS else near  # else all texts are shuffled
    text = F.coalesce("text", F.lit(""))
    some = docs.select(text.alias("text"), F.sha2(text, 256).alias("digest")).join(near, "digest", "left_semi")
    once = some.groupBy("digest").agg(F.first("text").alias("text")).join(listed, "digest")

    def holds(w: Column, c: Column) -> Column:
        length = F.least(F.size(c["win"]), F.lit(shingle))
        m = F.size(c["win"]) - length + 1
        right = F.filter(F.sequence(F.lit(1), m), lambda j: F.slice(w, c["start"] + j - 1, length) == F.slice(c["win"], j, length))
        return F.size(right) >= _needed(m, share)

    kept = let(words(F.col("text")), lambda w: F.filter("laid", lambda c: holds(w, c)))
    spans = F.transform(kept, lambda c: F.struct(c["start"].alias("start"), (c["start"] + F.size(c["win"]) - 1).alias("end"), c["win"].alias("win")))
    return once.select("digest", F.array_sort(spans).alias("hits")).filter(F.size("hits") > 0)


def covered(hits: Column) -> Column:
    """The number of words inside any of the sorted (start, end, ...)."""
    def step(acc: Column, o: Column) -> Column:
        gain = F.greatest(o["end"] - F.greatest(acc["upto"], o["start"] - 1), F.lit(0))
        return F.struct(F.greatest(acc["upto"], o["end"]).alias("upto"), (acc["n"] + gain).alias("n"))

    return F.aggregate(hits, F.struct(F.lit(0).alias("upto"), F.lit(0).alias("n")), step, lambda acc: acc["n"].cast("long"))


def overlaps(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, share: float = SHARE) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows (doc_id, digest, n_words) of all documents, (digest, hits) of the texts with hits, and (item_id, win) of the items."""
    wins = materialise(windows(items, window), "windows")
    tokens = materialise(shingled(wins.select("win").distinct(), shingle), "tokens")
    lengths = sorted(r.length for r in tokens.select("length").distinct().collect())  # at most ``shingle`` numbers
    small = tokens.count() <= BROADCAST
    found = materialise(_met(docs.select("doc_id", "text"), tokens.select("h").distinct(), lengths, small), "found")
    laid = found.filter("pos > 0")
    counts = laid.groupBy("h").agg(F.count(F.lit(1)).alias("rarity"))
    by_rarity = F.row_number().over(Window.partitionBy("win").orderBy(F.coalesce("rarity", F.lit(0)), "h", "place"))  # at most ``window`` rows a window
    prefix = tokens.join(counts, "h", "left").withColumn("nth", by_rarity).filter(F.col("nth") <= F.col("m") - _needed(F.col("m"), share) + 1)
    prefix = materialise(prefix.select("h", "place", "win"), "prefix")
    start = F.col("pos") - F.col("place")
    inside = (start >= 1) & (start + F.size("win") - 1 <= F.col("n_words"))
    candidates = laid.join(F.broadcast(prefix) if small else prefix, "h").filter(inside).select("digest", start.alias("start"), "win")
    return found.filter("pos = 0").select("doc_id", "digest", "n_words"), materialise(_verified(docs, candidates, share, shingle), "hits"), wins


def decontaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, share: float = SHARE) -> DataFrame:
    """Per row of ``docs`` (doc_id, text, ...): doc_id, n_words, n_hit, items (sorted ids of the items with a window in the text)."""
    rows, hits, wins = overlaps(docs, items, window, shingle, share)
    whose = hits.select("digest", F.explode(F.array_distinct(F.transform("hits", lambda o: o["win"]))).alias("win")).join(wins, "win")
    listed = whose.groupBy("digest").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    verdict = hits.select("digest", covered(F.col("hits")).alias("n_hit")).join(listed, "digest")
    out = rows.join(verdict, "digest", "left")
    none = F.array().cast("array<string>")
    return out.select("doc_id", F.col("n_words").cast("long").alias("n_words"), F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.coalesce("items", none).alias("items"))


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


QUERIES = {"op13_decontamination": op13_decontamination}
ORACLE_SQL = {
    "op13_decontamination": r"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce("text", ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z0-9\x{80}-\x{10FFFF}]+') AS w FROM documents),
        b AS (SELECT item_id, regexp_extract_all(translate(coalesce("text", ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z0-9\x{80}-\x{10FFFF}]+') AS w FROM benchmark),
        wins AS (SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[i : i + 9], ' ') AS win FROM (SELECT *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
        laid AS (SELECT r, i, k, array_to_string(w[i : i + k - 1], ' ') AS win FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM wins))),
        hits AS (SELECT r, i, laid.k, item_id FROM laid JOIN wins USING (win)),
        hit AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + k)) AS p FROM hits) GROUP BY r),
        items AS (SELECT r, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT r, coalesce(item_id::VARCHAR, '') AS id FROM hits) GROUP BY r)
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(hit.n, 0)::BIGINT AS n_hit, coalesce(items.n, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
        FROM d LEFT JOIN hit USING (r) LEFT JOIN items USING (r)""",
}
