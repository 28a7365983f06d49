"""Quality rules: base counts of each document, and line frequency across documents.

One pass over the texts makes the base counts and, per document, its distinct normalised lines as 64-bit hashes. Per host, the documents
that hold a line are counted; a line that more than ``max_docs`` distinct documents hold is above the limit. A document is a distinct whole text, so
exact copies count once. Lines above the limit are removed, and a document that has under ``min_left`` of its words left is rejected.

Normalised: white space collapsed, A-Z lower-cased, digits replaced by 0. Counting never meets in one task: lines are first made
distinct by (host, line, text), then counted per (host, line) with a partial count in the mappers.

Defined results: a null or empty text has no words and fails the base rules. A null host counts as the empty host.
Rows with equal id and text are judged alike. A line held by just ``max_docs`` documents stays. A long text is one row with one entry a distinct
line; it is read line by line and never cut. An empty table gives an empty result. Extra columns are ignored by ``judge`` and carried along by ``cleaned``, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, numbered, restored, table

MAX_DOCS, MIN_LEFT = 20, 0.2
RUN = 8
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MEASURED = ", ".join(f"{c} long" for c in BASE) + ", lines array<struct<h: long, n: long>>"
SPACE = bytes(range(9, 14)) + b" "
DIGITS = bytes.maketrans(b"0123456789", b"0000000000")
SYMBOLS = "#*$%&|<>"


def repeated_words(ids: np.ndarray, run: int = RUN) -> int:
    """Words that lie in a window of ``run`` words (a power of two) found twice or more.

    Windows are named exactly: the name of 2k words is the rank of the pair of the names of its halves.
    """
    if len(ids) <= run:
        return 0
    names, width = ids.astype(np.int64), 1
    while width < run:
        pair = names[:-width] * (len(ids) + 1) + names[width:]
        _, names = np.unique(pair, return_inverse=True)
        width *= 2
    again = np.bincount(names)[names] > 1
    if not again.any():
        return 0
    at = np.flatnonzero(again)
    edge = np.bincount(at, minlength=len(ids) + 1) - np.bincount(at + run, minlength=len(ids) + 1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def line_hash(words: list[bytes]) -> int:
    """The signed hash of a normalised line."""
    h = xxhash.xxh3_64_intdigest(b" ".join(words).lower().translate(DIGITS))
    return h - (1 << 64) if h >> 63 else h


def measure(text: str | None) -> tuple:
    """The base counts and the distinct lines of one text, with their words."""
    text = text or ""
    by_line = [(line, line.encode().split()) for line in text.split("\n")]
    by_line = [(line, words) for line, words in by_line if words]
    words = [w for _, ws in by_line for w in ws]
    n = len(words)
    symbols = sum(map(text.count, SYMBOLS))
    if not n:
        return 0, 0, symbols, 0, 0, []
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    chars = len(text) - sum(map(text.count, SPACE.decode()))
    dup_lines = len(by_line) - len({line for line, _ in by_line})
    merged: dict[int, int] = {}
    for _, ws in by_line:
        h = line_hash(ws)
        merged[h] = merged.get(h, 0) + len(ws)
    return n, chars, symbols, dup_lines, repeated_words(ids), [{"h": h, "n": c} for h, c in merged.items()]


def _measured(docs: DataFrame, host: str) -> DataFrame:
    schema = "doc_id long, text_key long, text_bytes int, host string, " + MEASURED
    kinds = [pa.int64()] * len(BASE) + [pa.list_(pa.struct([("h", pa.int64()), ("n", pa.int64())]))]
    names = ["doc_id", "text_key", "text_bytes", "host", *BASE, "lines"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                rows = [measure(t.as_py()) for t in batch.column(4)]
                made = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([*batch.columns[:4], *made], names)

    return keyed(docs.select("doc_id", F.coalesce(F.col(host), F.lit("")).alias("host"), "text")).select("doc_id", "text_key", "text_bytes", "host", "text").mapInArrow(run, schema)


def keyed(docs: DataFrame) -> DataFrame:
    """Add (text_key, text_bytes), which with doc_id name a row, or rows that repeat it."""
    text = F.coalesce("text", F.lit(""))
    return docs.withColumns({"text_key": F.xxhash64(text), "text_bytes": F.octet_length(text)})


KEY = ["doc_id", "text_key", "text_bytes"]


def frequent_lines(lines: DataFrame, max_docs: int = MAX_DOCS) -> DataFrame:
    """(host, h) of the lines that more than ``max_docs`` distinct texts of a host hold, from (host, h, text_key)."""
    return lines.select("host", "h", "text_key").distinct().groupBy("host", "h").agg(F.count(F.lit(1)).alias("documents")).filter(F.col("documents") > max_docs).select("host", "h")


def judge(docs: DataFrame, host: str = "source", max_docs: int = MAX_DOCS, min_left: float = MIN_LEFT) -> DataFrame:
    """Per row: its key, the base counts, base_failed, the words left, the hashes of removed lines, and kept."""
    found = materialise(_measured(docs, host).withColumn("row", F.monotonically_increasing_id()), "measured")
    lines = found.select("row", "host", "text_key", F.explode("lines").alias("line")).select("row", "host", "text_key", "line.h", "line.n")
    high = materialise(frequent_lines(lines, max_docs), "frequent")
    removed = lines.join(high, ["host", "h"]).groupBy("row").agg(F.sum("n").alias("n_removed"), F.collect_list("h").alias("removed_lines"))
    out = found.drop("lines").join(removed, "row", "left").withColumn("words_left", F.col("n_words") - F.coalesce("n_removed", F.lit(0)))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    depleted = F.col("words_left") < F.lit(min_left) * F.col("n_words")
    return out.select(*KEY, "host", *BASE, failed.alias("base_failed"), "words_left", "removed_lines", (~failed & ~depleted).alias("kept"))


def cleaned(docs: DataFrame, host: str = "source", max_docs: int = MAX_DOCS, min_left: float = MIN_LEFT) -> DataFrame:
    """The documents that stay, without their lines above the limit, in the columns of ``docs``."""
    judged = judge(docs, host, max_docs, min_left).filter("kept").select(*KEY, "host", "removed_lines").dropDuplicates([*KEY, "host"])
    verdicts = judged.select(*[F.col(c).alias(f"v_{c}") for c in judged.columns])
    place = {c: F.col(f"c{docs.columns.index(c)}") for c in ("doc_id", "text", host)}
    text = F.coalesce(place["text"], F.lit(""))
    own = {"doc_id": place["doc_id"], "text_key": F.xxhash64(text), "text_bytes": F.octet_length(text), "host": F.coalesce(place[host], F.lit(""))}
    same = F.lit(True)
    for k, value in own.items():
        same &= value.eqNullSafe(F.col(f"v_{k}"))
    inner = numbered(docs)
    joined = inner.join(verdicts, same).select(*inner.columns, "v_removed_lines")
    at, width = docs.columns.index("text"), len(docs.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [without(t, set(gone)) if gone else t for t, gone in zip(batch.column(at).to_pylist(), batch.column(width).to_pylist(), strict=True)]
            columns = list(batch.columns[:-1])
            columns[at] = pa.array(out, pa.string())
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names[:-1])

    return restored(joined.mapInArrow(run, inner.schema), docs)


def without(text: str, gone: set[int]) -> str:
    """The text without the lines whose hashes are in ``gone``."""
    by_line = ((line, line.encode().split()) for line in text.split("\n"))
    return "\n".join(line for line, words in by_line if not words or line_hash(words) not in gone)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents")).select("doc_id", *BASE, "base_failed", "kept", "words_left")


QUERIES = {"op8_quality": op8_quality}
ORACLE_SQL = {
    "op8_quality": r"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce("text", '') AS t, coalesce(source, '') AS h FROM documents),
        listed AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM d),
        windows AS (SELECT r, i, array_to_string(w[i : i + 7], ' ') AS key FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM listed WHERE len(w) >= 8)),
        twice AS (SELECT r, i FROM (SELECT *, count(*) OVER (PARTITION BY r, key) AS n FROM windows) WHERE n > 1),
        repeated AS (SELECT r, count(DISTINCT k) AS n FROM (SELECT r, unnest(range(i, i + 8)) AS k FROM twice) GROUP BY r),
        each AS (SELECT r, h, t, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS w FROM (SELECT r, h, t, unnest(string_split(t, chr(10))) AS line FROM d)),
        lines AS (SELECT r, h, t, line, len(w) AS n, regexp_replace(translate(array_to_string(w, ' '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9]', '0', 'g') AS normal FROM each WHERE len(w) > 0),
        frequent AS (SELECT h, normal FROM lines GROUP BY h, normal HAVING count(DISTINCT t) > 20),
        gone AS (SELECT r, sum(n) AS n FROM lines JOIN frequent USING (h, normal) GROUP BY r),
        doubled AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM lines GROUP BY r),
        base AS (SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars, (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
          coalesce(doubled.n, 0)::BIGINT AS n_dup_lines, coalesce(repeated.n, 0)::BIGINT AS n_repeat_words, (len(w) - coalesce(gone.n, 0))::BIGINT AS words_left
          FROM listed LEFT JOIN doubled USING (r) LEFT JOIN repeated USING (r) LEFT JOIN gone USING (r)),
        judged AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM base)
        SELECT *, NOT base_failed AND words_left >= 0.2::DOUBLE * n_words AS kept FROM judged""",
}
