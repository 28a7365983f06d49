"""Phrase collocations: exact counts of word n-grams in counting quotient filters, and scores of their weakest cut.

1. Texts are cut into words once. A chunk of texts of one language keeps its words as places in its own vocabulary; vocabularies are counted per (language, word), words with
   ``min_count`` or more get whole numbers as ids, and the chunks, joined with their part of the dictionary, are written as ids, with 0 for a rarer word or the end of a piece.
   A phrase that reaches ``min_count`` has no rarer part, so nothing is lost.
2. For n from 2 up, a task packs n ids into whole 64-bit words, permutes them by an invertible function and cuts the result into quotient and full remainder. Its filter is sorted by both: a block of
   quotients is a row with run lengths for the quotients, remainders, and counters of one byte, or eight where that is too few. Nothing is hashed away, so counts are exact.
   Filters of all tasks meet by block, which the permutation makes even whatever the words, and are merged; entries of ``min_count`` or more are turned back into ids.
3. An n-gram can only reach ``min_count`` where both (n-1)-grams in it do. A bitmap over the leading bits of their permuted keys, of at most 2^``BITMAP`` bits, tells tasks
   where that may be; a false hit costs a counter and no more, as the count itself is exact.
4. Parts of a phrase are found by equi-joins on ids; scores are decimals, as products may pass 64 bits.

Memory: a task holds chunks of up to four times ``CHUNK`` bytes of text together, or one text, and ``ENTRIES`` counters; more are written as one more filter. A merging task holds the entries of one block; blocks are
as many as shuffle partitions at least. The driver gets numbers of rows and the bitmap.

Defined results: a null text counts as empty, a null language as ``und``. Rows with equal ids or texts count each. A text is never cut; a piece may be as long as it.
Ties go as the order says; phrases that tie in everything are one phrase. An empty table gives no rows. Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialise, table

LONGEST, MIN_COUNT, ABSORB, TOP = 5, 100, 100, 2000
CHUNK, ENTRIES = 4 << 20, 2_000_000
BITMAP, SLOT_BITS = 26, 4
KIND = np.zeros(256, np.uint8)  # 1: between words, 2: between pieces
KIND[[0x20, 0x09]] = 1
KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
FACTORS = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)  # odd, so that multiplying by them can be undone
INVERSES = tuple(pow(f, -1, 1 << 64) for f in FACTORS)
ROUNDS = 2


# texts as ids


def words_of(data: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The words of UTF-8 bytes, and whether a word is the first of its piece."""
    kind = KIND[data]
    inside = kind == 0
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    offsets = np.append(0, np.cumsum(ends - starts)).astype(np.int32)
    listed = pa.Array.from_buffers(pa.string(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(LOWER[data[inside]])])
    piece = np.cumsum(kind == 2, dtype=np.int32)[starts]
    return listed, np.diff(piece, prepend=-1) != 0


def chunk_of(data: np.ndarray) -> tuple | None:
    """(ids, vocabulary, counts) of the bytes: ids from 1 in order, two bytes each or four, 0 before each piece; None without words."""
    listed, first = words_of(data)
    if not len(listed):
        return None
    coded = listed.dictionary_encode()
    at = coded.indices.to_numpy()
    ids = np.insert(at.astype(np.int64) + 1, np.flatnonzero(first), 0)
    return ids.astype("<u2" if len(coded.dictionary) < 1 << 16 else "<u4").tobytes(), coded.dictionary, np.bincount(at)


def chunks(docs: DataFrame) -> DataFrame:
    """(lang, ids, wide, vocabulary, counts) of stretches of texts of one language."""
    schema = "lang string, ids binary, wide boolean, vocabulary array<string>, counts array<long>"

    def made(lang: str, texts: list[bytes]) -> Iterator[pa.RecordBatch]:
        if found := chunk_of(np.frombuffer(b"\n".join(texts), np.uint8)):
            ids, vocabulary, counts = found
            columns = [pa.array([lang]), pa.array([ids], pa.binary()), pa.array([len(vocabulary) >= 1 << 16]), pa.ListArray.from_arrays([0, len(vocabulary)], vocabulary), pa.ListArray.from_arrays([0, len(counts)], pa.array(counts, pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "ids", "wide", "vocabulary", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[bytes]] = {}
        sizes: dict[str, int] = {}
        total = 0
        for batch in batches:
            for lang, text in zip(*batch.columns, strict=True):
                lang, text = lang.as_py(), text.as_buffer().to_pybytes()
                held.setdefault(lang, []).append(text)
                sizes[lang] = sizes.get(lang, 0) + len(text) + 1
                total += len(text) + 1
                if sizes[lang] > CHUNK or total > 4 * CHUNK:
                    largest = max(sizes, key=sizes.get)
                    total -= sizes.pop(largest)
                    yield from made(largest, held.pop(largest))
        for lang, texts in held.items():
            yield from made(lang, texts)

    return docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, schema)


def numbered_words(words: DataFrame) -> DataFrame:
    """``words`` with an id from 1 without gaps: places in partitions after the rows of the partitions before."""
    placed = materialise(words.withColumn("m", F.monotonically_increasing_id()), "words")
    part = F.shiftright("m", 33)
    sizes = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    before = sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))  # a row for each partition
    local = F.col("m").bitwiseAND(F.lit((1 << 33) - 1))
    return materialise(placed.withColumn("part", part).join(F.broadcast(before), "part").withColumn("id", (F.col("before") + local + 1).cast("int")).drop("m", "part", "before"), "dictionary", replaces=placed)


def _listed(rows: DataFrame) -> DataFrame:
    """(chunk, known binary): per chunk the ids of ``rows`` (chunk, at, id) in order, four bytes each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts = None, []
        for batch in batches:
            chunk, ids = batch.column(0).to_numpy(), batch.column(1).to_numpy().astype("<u4")
            cuts = np.flatnonzero(np.diff(chunk)) + 1
            for at, to in zip([0, *cuts], [*cuts, len(chunk)], strict=True):
                if to > at:
                    if now is not None and chunk[at] != now:
                        yield pa.RecordBatch.from_arrays([pa.array([now]), pa.array([b"".join(parts)])], ["chunk", "known"])
                        parts = []
                    now = int(chunk[at])
                    parts.append(ids[at:to].tobytes())
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now]), pa.array([b"".join(parts)])], ["chunk", "known"])

    return rows.repartition("chunk").sortWithinPartitions("chunk", "at").select("chunk", "id").mapInArrow(run, "chunk long, known binary")


def encoded(cut: DataFrame, dictionary: DataFrame) -> DataFrame:
    """(ids): the chunks of ``cut`` (chunk, ids, wide, lang, vocabulary) by the ids of ``dictionary`` (lang, word, id)."""
    own = cut.select("chunk", "lang", F.posexplode("vocabulary").alias("at", "word")).join(dictionary.select("lang", "word", "id"), ["lang", "word"], "left")
    known = _listed(own.select("chunk", "at", F.coalesce("id", F.lit(0)).alias("id")))  # every word of the chunk, 0 for a rarer one

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw, wide, known in zip(*batch.columns, strict=True):
                local = np.frombuffer(raw.as_buffer(), "<u4" if wide.as_py() else "<u2")
                out = np.append(np.zeros(1, "<u4"), np.frombuffer(known.as_buffer(), "<u4"))[local]
                out = out[(out != 0) | (np.append(out[1:], 0) != 0)]  # one 0 is enough
                yield pa.RecordBatch.from_arrays([pa.array([out.tobytes()], pa.binary())], ["ids"])

    return cut.select("chunk", "ids", "wide").join(known, "chunk").select("ids", "wide", "known").mapInArrow(run, "ids binary")


# packed n-grams and filters


def packed(ids: list[np.ndarray], bits: int) -> list[np.ndarray]:
    """The numbers whose digits of ``bits`` bits are ``ids``, as 64-bit words, the least significant first."""
    out = [np.zeros(len(ids[0]), np.uint64) for _ in range(-(-len(ids) * bits // 64))]
    for i, x in enumerate(reversed(ids)):
        word, shift = divmod(i * bits, 64)
        x = x.astype(np.uint64)
        out[word] |= x << np.uint64(shift)
        if shift + bits > 64:
            out[word + 1] |= x >> np.uint64(64 - shift)
    return out


def unpacked(words: list[np.ndarray], n: int, bits: int) -> list[np.ndarray]:
    out = []
    for i in reversed(range(n)):
        word, shift = divmod(i * bits, 64)
        x = words[word] >> np.uint64(shift)
        if shift + bits > 64:
            x |= words[word + 1] << np.uint64(64 - shift)
        out.append(x & np.uint64((1 << bits) - 1))
    return out


def _mix(x: np.ndarray) -> np.ndarray:
    for f in FACTORS:
        x = (x ^ (x >> np.uint64(32))) * np.uint64(f)
    return x ^ (x >> np.uint64(32))


def _unmix(x: np.ndarray) -> np.ndarray:
    for f in reversed(INVERSES):
        x = (x ^ (x >> np.uint64(32))) * np.uint64(f)
    return x ^ (x >> np.uint64(32))


def permuted(words: list[np.ndarray]) -> list[np.ndarray]:
    """An invertible function of all words: each in turn is mixed with its neighbour."""
    out = list(words)
    for _ in range(ROUNDS):
        for j in range(len(out)):
            out[j] = _mix(out[j] ^ out[j - 1]) if len(out) > 1 else _mix(out[j])
    return out


def restored_words(words: list[np.ndarray]) -> list[np.ndarray]:
    out = list(words)
    for _ in range(ROUNDS):
        for j in reversed(range(len(out))):
            out[j] = _unmix(out[j]) ^ out[j - 1] if len(out) > 1 else _unmix(out[j])
    return out


def counted(keys: list[np.ndarray], counts: np.ndarray | None = None) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct keys, sorted by their words from the first, with the sums of their counts (one each if None)."""
    if len(keys) == 1 and counts is None:
        keys = [np.sort(keys[0])]
        order = None
    else:
        order = np.lexsort(keys[::-1])
        keys = [k[order] for k in keys]
    new = np.ones(len(keys[0]), bool)
    new[1:] = reduce(np.logical_or, [k[1:] != k[:-1] for k in keys])
    at = np.flatnonzero(new)
    if counts is None:
        return [k[at] for k in keys], np.diff(np.append(at, len(new)))
    return [k[at] for k in keys], np.add.reduceat(counts[order], at) if len(at) else counts


def merged(filters: list[tuple]) -> tuple[list[np.ndarray], np.ndarray]:
    if len(filters) == 1:
        return filters[0]
    return counted([np.concatenate(c) for c in zip(*(f[0] for f in filters), strict=True)], np.concatenate([f[1] for f in filters]))


def to_blocks(keys: list[np.ndarray], counts: np.ndarray, block_bits: int) -> Iterator[tuple]:
    """(block, runs, remainders, counters, large) of a filter: quotients are the leading ``block_bits + SLOT_BITS`` bits of the first word."""
    rest_bits = 64 - block_bits - SLOT_BITS
    width = -(-rest_bits // 8)
    quotient = keys[0] >> np.uint64(rest_bits)
    rest = np.ascontiguousarray((keys[0] & np.uint64((1 << rest_bits) - 1)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width])
    bounds = np.searchsorted(quotient, np.arange((1 << block_bits) + 1, dtype=np.uint64) << np.uint64(SLOT_BITS))
    for block in np.flatnonzero(np.diff(bounds)):
        at, to = bounds[block], bounds[block + 1]
        runs = np.bincount((quotient[at:to] & np.uint64((1 << SLOT_BITS) - 1)).astype(np.int64), minlength=1 << SLOT_BITS)
        some = counts[at:to]
        others = b"".join(k[at:to].astype("<u8").tobytes() for k in keys[1:])
        yield int(block), runs.astype("<u4").tobytes(), rest[at:to].tobytes() + others, np.minimum(some, 255).astype(np.uint8).tobytes(), some[some >= 255].astype("<u8").tobytes()


def from_block(block: int, runs: bytes, remainders: bytes, counters: bytes, large: bytes, block_bits: int) -> tuple[list[np.ndarray], np.ndarray]:
    rest_bits = 64 - block_bits - SLOT_BITS
    width = -(-rest_bits // 8)
    counts = np.frombuffer(counters, np.uint8).astype(np.int64)
    n = len(counts)
    counts[counts == 255] = np.frombuffer(large, "<u8")
    rest = np.zeros((n, 8), np.uint8)
    rest[:, :width] = np.frombuffer(remainders, np.uint8, n * width).reshape(n, width)
    slot = np.repeat(np.arange(1 << SLOT_BITS, dtype=np.uint64), np.frombuffer(runs, "<u4"))
    quotient = np.uint64(block << SLOT_BITS) | slot
    first = rest.view("<u8")[:, 0] | (quotient << np.uint64(rest_bits))
    others = np.frombuffer(remainders[n * width :], "<u8")
    return [first, *others.reshape(-1, n)], counts


def grams_at(ids: np.ndarray, at: np.ndarray, n: int, bits: int) -> list[np.ndarray]:
    """The permuted keys of the n-grams that start at ``at``."""
    return permuted(packed([ids[at + i] for i in range(n)], bits))


def whole(ids: np.ndarray, n: int) -> np.ndarray:
    """Where n ids stand one after the other without 0 between them."""
    some = ids != 0
    return np.flatnonzero(reduce(np.logical_and, [some[i : len(some) - n + 1 + i] for i in range(n)])) if len(ids) >= n else np.zeros(0, np.int64)


def possible(ids: np.ndarray, n: int, bits: int, bitmap: np.ndarray | None) -> np.ndarray:
    """Where n-grams start both of whose (n-1)-grams are in the bitmap; all without a bitmap."""
    if bitmap is None:
        return whole(ids, n)
    shift = np.uint64(64 - int(bitmap.nbytes * 8).bit_length() + 1)
    at = whole(ids, n - 1)
    place = grams_at(ids, at, n - 1, bits)[0] >> shift
    hit = (bitmap[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1)
    at = at[hit.astype(bool)]
    return at[:-1][np.diff(at) == 1] if len(at) else at


BLOCK = "block int, runs binary, remainders binary, counters binary, large binary"
BLOCK_TYPES = [pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    names = [c.split()[0] for c in BLOCK.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 5, BLOCK_TYPES, strict=True)], names)


def filters(texts: DataFrame, n: int, bits: int, block_bits: int, bitmap) -> DataFrame:
    """The blocks of each task's filters of n-grams of ``texts`` (ids)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        known = bitmap.value if bitmap is not None else None
        for batch in batches:
            for raw in batch.column(0):
                ids = np.frombuffer(raw.as_buffer(), "<u4")
                at = possible(ids, n, bits, known)
                if not len(at):
                    continue
                parts.append(counted(grams_at(ids, at, n, bits)))
                held += len(parts[-1][1])
                if held > ENTRIES:
                    parts = [merged(parts)]
                    held = len(parts[0][1])
                    if held > ENTRIES // 2:
                        yield _rows(list(to_blocks(*parts[0], block_bits)))
                        parts, held = [], 0
        if parts:
            yield _rows(list(to_blocks(*merged(parts), block_bits)))

    return texts.mapInArrow(run, BLOCK)


def grams(blocks: DataFrame, n: int, bits: int, block_bits: int, min_count: int) -> DataFrame:
    """(ids array, f, place) of the n-grams that reach ``min_count``: blocks meet and are merged; ``place`` is the first word of the key."""

    def found(parts: list[tuple]) -> pa.RecordBatch:
        keys, counts = merged(parts)
        some = counts >= min_count
        keys, counts = [k[some] for k in keys], counts[some]
        ids = np.stack(unpacked(restored_words(keys), n, bits), axis=1).astype(np.int32)
        listed = pa.ListArray.from_arrays(pa.array(np.arange(len(ids) + 1, dtype=np.int32) * n), pa.array(ids.reshape(-1)))
        return pa.RecordBatch.from_arrays([listed, pa.array(counts, pa.int64()), pa.array(keys[0].view(np.int64))], ["ids", "f", "place"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts, held = None, [], 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[0] != now and parts:
                    yield found(parts)
                    parts, held = [], 0
                now = row[0]
                parts.append(from_block(*row, block_bits))
                held += len(parts[-1][1])
                if held > ENTRIES:
                    parts = [merged(parts)]
                    held = len(parts[0][1]) // 2  # merge anew once as many again have come
        if parts:
            yield found(parts)

    return blocks.repartition("block").sortWithinPartitions("block").mapInArrow(run, "ids array<int>, f long, place long")


def bitmap_of(found: DataFrame, rows: int) -> np.ndarray:
    """Bits over the leading bits of the places of ``found``, 16 a row or more up to 2^``BITMAP``."""
    m = min(max((16 * rows).bit_length(), 10), BITMAP)
    bit = F.shiftrightunsigned("place", 64 - m)
    word = found.groupBy(F.shiftright(bit, 6).cast("int").alias("at")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(place, {64 - m}) & 63 as int))")).alias("bits")).toArrow()
    out = np.zeros(1 << (m - 6), np.uint64)
    out[word.column(0).to_numpy()] = word.column(1).to_numpy().view(np.uint64)
    return out


# phrases


def frequent_grams(docs: DataFrame, longest: int = LONGEST, min_count: int = MIN_COUNT) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(ids, f) of all n-grams up to ``longest`` that reach ``min_count``; the dictionary (lang, word, id, f); (lang, n) with all words."""
    cut = materialise(chunks(docs.select("lang", "text")).withColumn("chunk", F.monotonically_increasing_id()), "chunks")
    words = cut.select("lang", F.explode(F.arrays_zip(F.col("vocabulary").alias("word"), F.col("counts").alias("n"))).alias("w")).groupBy("lang", F.col("w.word").alias("word")).agg(F.sum("w.n").alias("f"))
    totals = materialise(cut.select("lang", F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x).alias("n")).groupBy("lang").agg(F.sum("n").alias("n")), "totals")
    dictionary = numbered_words(words.filter(F.col("f") >= min_count))
    rows = dictionary.count()
    bits = max(rows.bit_length(), 1)
    texts = materialise(encoded(cut, dictionary), "encoded", replaces=cut)
    spark = docs.sparkSession
    block_bits = max(6, (2 * int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length())
    parts, bitmap = [dictionary.select(F.array("id").alias("ids"), "f")], None
    for n in range(2, longest + 1):
        blocks = filters(texts, n, bits, block_bits, spark.sparkContext.broadcast(bitmap) if bitmap is not None else None)
        found = materialise(grams(blocks, n, bits, block_bits, min_count), f"grams{n}")
        rows = found.count()
        parts.append(found.select("ids", "f"))
        if not rows:
            break
        bitmap = bitmap_of(found, rows)
    return reduce(DataFrame.unionByName, parts), dictionary, totals


def _part(name: str, start: Column, length: Column) -> Column:
    return F.slice("ids", start, length).alias(name)


def collocations(docs: DataFrame, longest: int = LONGEST, min_count: int = MIN_COUNT, absorb: int = ABSORB, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language of ``docs`` (lang, text, ...).

    ``a``, ``l`` and ``r`` count the phrase and the parts of its lowest-scoring cut. A phrase inside a longer one that has ``absorb`` percent of its count or more is left out.
    """
    every, dictionary, totals = frequent_grams(docs, longest, min_count)
    phrases = every.filter(F.size("ids") > 1)
    cuts = phrases.select("ids", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.size("ids") - 1)).alias("k"))
    cuts = cuts.select("ids", "a", "k", _part("first", F.lit(1), F.col("k")), _part("rest", F.col("k") + 1, F.size("ids") - F.col("k")))
    sized = cuts.join(every.select(F.col("ids").alias("first"), F.col("f").alias("l")), "first").join(every.select(F.col("ids").alias("rest"), F.col("f").alias("r")), "rest")
    lang = dictionary.select(F.col("id").alias("head"), "lang").join(totals, "lang")
    sized = sized.withColumn("head", F.get("ids", F.lit(0))).join(lang, "head")
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    sized = sized.withColumns({"over": wide("a") * wide("n") * F.lit(1000).cast("decimal(4,0)"), "under": wide("l") * wide("r")}).withColumn("score", F.expr("over div under"))
    scored = sized.groupBy("ids", "lang", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    inside = F.explode(F.flatten(F.transform(F.sequence(F.lit(2), F.size("ids") - 1), lambda m: F.transform(F.sequence(F.lit(1), F.size("ids") - m + 1), lambda i: F.slice("ids", i, m)))))
    longer = phrases.filter(F.size("ids") > 2).select(inside.alias("ids"), "f").groupBy("ids").agg(F.max("f").alias("most"))
    kept = scored.join(longer, "ids", "left").filter(F.col("most").isNull() | (100 * F.col("most") < absorb * F.col("a")))
    spelt = kept.select("ids", F.posexplode("ids").alias("at", "id")).join(dictionary.select("id", "word"), "id").groupBy("ids").agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("words"))
    named = kept.join(spelt, "ids").select("lang", F.array_join(F.transform("words", lambda w: w["word"]), " ").alias("phrase"), "a", "cut.l", "cut.r", "n", "cut.score")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    return named.withColumn("rank", rank).filter(F.col("rank") <= top).select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


QUERIES = {"op11_collocations": op11_collocations}
ORACLE_SQL = {
    "op11_collocations": r"""
        WITH pieces AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\n\x0B\f\r]')) AS p FROM (SELECT coalesce(lang, 'und') AS lang, translate(coalesce("text", ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)),
        listed AS (SELECT lang, regexp_extract_all(p, '[^ \t]+') AS w FROM pieces),
        totals AS (SELECT lang, sum(len(w)) AS n FROM listed GROUP BY lang),
        grams AS (SELECT lang, g, count(*) AS f FROM (SELECT lang, w[i : i + k - 1] AS g FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM listed, range(1, 6) AS t(k))) GROUP BY lang, g HAVING count(*) >= 100),
        cuts AS (SELECT c.lang, c.g, c.f AS a, k, l.f AS l, r.f AS r, n, (1000::HUGEINT * c.f * n) // (l.f::HUGEINT * r.f) AS score
          FROM grams c JOIN range(1, 5) AS t(k) ON k < len(c.g) JOIN grams l ON l.lang = c.lang AND l.g = c.g[:k] JOIN grams r ON r.lang = c.lang AND r.g = c.g[k + 1 :] JOIN totals ON totals.lang = c.lang),
        lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
        inside AS (SELECT lang, g, max(f) AS most FROM (SELECT lang, w[i : i + m - 1] AS g, f FROM (SELECT lang, g AS w, f, m, unnest(range(1, len(g) - m + 2)) AS i FROM grams, range(2, 5) AS t(m) WHERE m < len(g))) GROUP BY lang, g),
        kept AS (SELECT lowest.* FROM lowest LEFT JOIN inside USING (lang, g) WHERE most IS NULL OR 100 * most < 100 * a)
        SELECT * FROM (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(g, ' ')) AS rank, array_to_string(g, ' ') AS phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score FROM kept) WHERE rank <= 2000""",
}
