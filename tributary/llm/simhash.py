"""SimHash near-deduplication with deletion-variant signatures.

A fingerprint is cut into fewer segments than the bits that may differ, so that in one segment near copies differ by at most one
bit. Each segment is indexed as a whole and with single bits deleted: an equal segment meets in the whole signature, one that differs by
one bit meets where that bit is deleted. Fingerprints are made distinct before indexing, so copies never meet each other. Two layouts are given:

* ``NARROW``: 64 bits of three-word shingles in two halves with every bit deleted, 66 signatures. All pairs within three bits meet.
* ``wide``: distinct five-word shingles for a similarity of 0.8. A segment has as many bits as keep about 16 fingerprints to a signature by chance, 18 at least, and there are as many
  segments as it takes to find near copies, 32 at 18 bits and more the longer they are. A bit that differs between near copies nearly always is one whose majority is small, so only the two closest
  bits of a segment are deleted, three signatures a segment. 512 bits are compared: pairs of similarity 0.8 differ by 78 of them in the mean, with a deviation of 8; pairs within 92
  are linked. Recall is measured in the tests.

Rows with one signature come together by an equality shuffle. A signature with a deleted bit only counts if both values of that bit
occur, since equal segments meet in the whole signature. Pairs are verified with the full Hamming distance and never listed:
within a signature a fingerprint that is reached leaves the rest at once, so m fingerprints give at most m - 1
links, a spanning forest of all verified pairs. Members of a narrow signature with more than ``SPLIT`` of them are dealt out anew by the bytes of the other
half, as three differing bits leave one of four bytes equal. Components of these links are found by ``graph``.

Memory: a task holds the distinct fingerprints of one signature, 8 bytes (narrow, at most ``SPLIT`` beyond the first pass) or 72 bytes (wide) each. Those of near copies of one text
reach each other in a few steps.

Defined results: a null text or one without words has fingerprint zero, linked like any other. Fewer words than a shingle:
the whole sequence is the one shingle. A null id takes part but is never a component's id; a component of null ids
only has the id null. Of a component, ``keep_one`` keeps one row: that of the component's id, among rows repeating it any one, among null ids the one of the least text hash.
Long texts are hashed in blocks of ``BLOCK`` shingles. An empty table gives an empty result. Extra columns are ignored by ``near_duplicates`` and carried along by ``keep_one``, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, numbered, restored, table
from .graph import components

SEED = 42
SPLIT = 20_000
BLOCK = 1 << 16


@dataclass(frozen=True)
class Layout:
    words: int  # of a shingle
    lanes: int  # 64-bit words of a fingerprint that are compared
    segments: int
    width: int  # bits of a segment
    deleted: int  # bits of a segment that are deleted, those of the smallest majorities
    limit: int  # differing bits of a link

    @property
    def names(self) -> list[str]:
        return ["fp"] if self.lanes == 1 else [f"f{i}" for i in range(self.lanes)]


NARROW = Layout(words=3, lanes=1, segments=2, width=32, deleted=32, limit=3)
LEAST_WIDTH, MEMBERS = 18, 16
FOUND, PER_BIT, MISSED = 0.1, 0.865, 0.035  # measured at a similarity of 0.8 to 0.85: pairs that one segment of 18 bits finds, by how much one more bit lowers that; pairs that all segments may miss


def wide(rows: int) -> Layout:
    """The layout for five-word shingles and a similarity of 0.8 among ``rows`` fingerprints."""
    width = max(LEAST_WIDTH, math.ceil(math.log2(max(rows, 1) / MEMBERS)))
    found = FOUND * PER_BIT ** (width - LEAST_WIDTH)
    return Layout(words=5, lanes=8, segments=math.ceil(math.log(MISSED) / math.log(1 - found)), width=width, deleted=2, limit=92)


WIDE = wide(0)


def majorities(hashes: np.ndarray) -> np.ndarray:
    """Twice the number of hashes that set each bit, less the number of hashes; ``hashes``: (n, lanes)."""
    set_bits = np.zeros(64 * hashes.shape[1], np.int64)
    for at in range(0, len(hashes), BLOCK):
        some = np.ascontiguousarray(hashes[at : at + BLOCK])
        bits = np.unpackbits(some.view(np.uint8).reshape(len(some), -1), axis=1, bitorder="little").view(np.uint64)  # eight counters of a byte each
        sums = np.add.reduceat(bits, np.arange(0, len(bits), 255), axis=0)
        set_bits += sums.view(np.uint8).sum(axis=0, dtype=np.int64)
    return 2 * set_bits - len(hashes)


def packed(bits: np.ndarray) -> np.ndarray:
    return np.packbits(bits, bitorder="little").view("<u8")


def fingerprint(text: str | None, words: int = NARROW.words) -> int:
    """The narrow fingerprint as an unsigned number: XXH64 of shingles, A-Z lower-cased, words cut at ASCII white space."""
    parts = (text or "").encode().lower().split()
    if not parts:
        return 0
    whole = b" ".join(parts)
    n = max(1, len(parts) - words + 1)
    if n == 1:
        return xxhash.xxh64_intdigest(whole, SEED)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(whole[a:b], SEED) for a, b in zip(starts[:n].tolist(), ends[words - 1 :].tolist(), strict=True)), "<u8", n)
    return int(packed(majorities(hashes[:, None]) > 0)[0])


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def shingles(text: str | None, words: int) -> np.ndarray:
    """Distinct 64-bit hashes of the shingles of a text."""
    parts = (text or "").encode().lower().split()
    if not parts:
        return np.zeros(0, np.uint64)
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in parts), np.int64, len(parts))
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, number), np.uint64, len(number))[ids]
    n = max(1, len(parts) - words + 1)
    out = np.zeros(n, np.uint64)
    for k in range(min(words, len(parts))):
        out = out * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + n]
    return np.unique(mixed(out))


def wide_signatures(text: str | None, layout: Layout = WIDE) -> tuple[np.ndarray, np.ndarray]:
    """(the fingerprint's lanes, its signatures); signatures are numbered as by ``narrow_signatures``."""
    hashes = shingles(text, layout.words)
    used = layout.segments * layout.width
    lanes = np.arange(1, max(layout.lanes, -(-used // 64)) + 1, dtype=np.uint64) * np.uint64(0x632BE59BD9B4E019)
    most = majorities(mixed(hashes[:, None] + lanes))
    bits = most > 0
    cut = bits[:used].reshape(layout.segments, layout.width)
    close = np.argsort(np.abs(most[:used]).reshape(cut.shape), axis=1, kind="stable")[:, : layout.deleted]
    whole = cut @ (np.int64(1) << np.arange(layout.width))
    rest = whole[:, None] & ~(np.int64(1) << close)
    part = np.arange(layout.segments)[:, None] * (layout.width + 1)
    return packed(bits[: 64 * layout.lanes]), np.concatenate([(part + layout.width) << 32 | whole[:, None], (part + close) << 32 | rest], axis=1).ravel()


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


KEY = ["doc_id", "text_key", "text_bytes"]


def fingerprints(docs: DataFrame, layout: Layout = NARROW) -> DataFrame:
    """(doc_id, text_key, text_bytes, lanes...) of each row, with an array ``sigs`` of signatures if wide; lanes are signed."""

    def narrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = pa.array([signed(fingerprint(t.as_py(), layout.words)) for t in batch.column(3)], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], fp], [*KEY, "fp"])

    def wide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [wide_signatures(t.as_py(), layout) for t in batch.column(3)]
            lanes = [pa.array([x.view(np.int64)[i] for x, _ in made], pa.int64()) for i in range(layout.lanes)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *lanes, pa.array([s for _, s in made], pa.list_(pa.int64()))], [*KEY, *layout.names, "sigs"])

    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", F.xxhash64(text).alias("text_key"), F.octet_length(text).alias("text_bytes"), "text")
    schema = "doc_id long, text_key long, text_bytes int, " + ", ".join(f"{c} long" for c in layout.names)
    return rows.mapInArrow(narrow, schema) if layout.lanes == 1 else rows.mapInArrow(wide, f"{schema}, sigs array<long>")


def narrow_signatures(fps: DataFrame) -> DataFrame:
    """(sig, id, fp): 66 rows a fingerprint. sig holds the half, the deleted bit (32: none) and the rest of the half."""
    part = F.explode(F.sequence(F.lit(0), F.lit(65))).alias("part")
    half = F.when(F.col("part") < 33, F.col("fp").bitwiseAND(0xFFFFFFFF)).otherwise(F.shiftrightunsigned("fp", 32))
    bit = F.expr("shiftleft(1L, part % 33) & 4294967295L")
    rest = half.bitwiseAND(F.bitwise_not(bit))
    return fps.select("fp", part).select((F.expr("shiftleft(cast(part as long), 32)").bitwiseOR(rest)).alias("sig"), F.col("fp").alias("id"), "fp")


def distance(some: np.ndarray, one: np.ndarray) -> np.ndarray:
    """Differing bits of each row of ``some`` (n, lanes) from ``one``."""
    return np.bitwise_count(some ^ one).sum(axis=1, dtype=np.int64)


def forest(ids: np.ndarray, members: np.ndarray, limit: int) -> list[tuple[int, np.ndarray]]:
    """Links (id, other ids) that span the same components as all pairs within ``limit``. ``members``: distinct rows (n, lanes)."""
    out, queue = [], []
    while len(ids):
        if not queue:
            queue, ids, members = [(ids[0], members[0])], ids[1:], members[1:]
        one, bits = queue.pop()
        near = distance(members, bits) <= limit
        if near.any():
            out.append((one, ids[near]))
            queue.extend(zip(ids[near], members[near], strict=True))
            ids, members = ids[~near], members[~near]
    return out


def bucket_links(sig: int, ids: np.ndarray, members: np.ndarray, layout: Layout = NARROW) -> list[tuple[int, np.ndarray]]:
    """Links among the distinct fingerprints with one signature."""
    segment, bit = divmod(sig >> 32, layout.width + 1)
    if bit < layout.width:
        lane, place = divmod(segment * layout.width + bit, 64)
        if lane < layout.lanes:
            value = (members[:, lane] >> np.uint64(place)) & np.uint64(1)
            if value.all() or not value.any():
                return []
    return forest(ids, members, layout.limit)


def grouped_links(rows: DataFrame, keys: list[str], layout: Layout, split: int | None = None) -> DataFrame:
    """(u, v, sig) of the links within each group of ``rows`` (sig, keys..., id, lanes...) with equal sig and keys.

    A group of more than ``split`` members is handed back as rows (id, null, sig).
    """
    count = 1 + len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_key, held = None, []

        def done(key: tuple, parts: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
            ids, members = (np.concatenate(x) for x in zip(*parts, strict=True))
            if split is not None and len(ids) > split:
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.nulls(len(ids), pa.int64()), pa.array(np.full(len(ids), key[0]))], ["u", "v", "sig"])
            elif len(ids) > 1 and (pairs := bucket_links(key[0], ids, members, layout)):
                u, v = np.repeat(np.array([a for a, _ in pairs]), [len(b) for _, b in pairs]), np.concatenate([b for _, b in pairs])
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v), pa.nulls(len(u), pa.int64())], ["u", "v", "sig"])

        for batch in batches:
            columns = [c.to_numpy() for c in batch.columns]
            if not len(columns[0]):
                continue
            change = np.zeros(len(columns[0]) - 1, bool)
            for c in columns[:count]:
                change |= c[1:] != c[:-1]
            cuts = np.concatenate([[0], np.flatnonzero(change) + 1, [len(columns[0])]])
            ids, members = columns[count], np.stack(columns[count + 1 :], axis=1).view(np.uint64)
            key_at = lambda i: tuple(int(c[i]) for c in columns[:count])
            if held_key is not None and key_at(0) != held_key:
                yield from done(held_key, held)
                held = []
            if len(cuts) == 2:
                held_key = key_at(0)
                held.append((ids, members))
                continue
            yield from done(key_at(0), [*held, (ids[: cuts[1]], members[: cuts[1]])])
            sizes = np.diff(cuts)
            two = cuts[1:-2][sizes[1:-1] == 2]
            two = two[distance(members[two], members[two + 1]) <= layout.limit]
            if len(two):
                yield pa.RecordBatch.from_arrays([pa.array(ids[two]), pa.array(ids[two + 1]), pa.nulls(len(two), pa.int64())], ["u", "v", "sig"])
            for i in (np.flatnonzero(sizes[1:-1] > 2) + 1).tolist():
                yield from done(key_at(cuts[i]), [(ids[cuts[i] : cuts[i + 1]], members[cuts[i] : cuts[i + 1]])])
            held_key, held = key_at(cuts[-2]), [(ids[cuts[-2] :], members[cuts[-2] :])]
        if held_key is not None:
            yield from done(held_key, held)

    every = ["sig", *keys]
    return rows.select(*every, "id", *layout.names).repartition(*every).sortWithinPartitions(*every).mapInArrow(run, "u long, v long, sig long")


def links(signatures: DataFrame, layout: Layout = NARROW) -> DataFrame:
    """(u, v) of distinct fingerprints within the limit, from (sig, id, lanes...): a spanning forest per signature."""
    if layout != NARROW:
        return grouped_links(signatures, [], layout).select("u", "v").distinct()
    first = materialise(grouped_links(signatures, [], layout, SPLIT), "links")
    found = first.filter("sig IS NULL").select("u", "v")
    hot = first.filter("sig IS NOT NULL")
    if not hot.isEmpty():
        byte = F.explode(F.sequence(F.lit(0), F.lit(3))).alias("byte")
        spread = hot.select("sig", F.col("u").alias("id"), F.col("u").alias("fp"), byte)
        value = F.expr("shiftrightunsigned(fp, cast(8 * byte + if(shiftright(sig, 32) >= 33, 0, 32) AS int)) & 255")
        found = found.unionByName(grouped_links(spread.withColumn("value", value), ["byte", "value"], layout).select("u", "v"))
    return found.distinct()


def near_duplicates(docs: DataFrame, layout: Layout = NARROW) -> DataFrame:
    """(doc_id, text_key, text_bytes, lanes..., component_id) of each row of ``docs`` (doc_id, text, ...)."""
    rows = materialise(fingerprints(docs, layout), "fingerprints")
    lanes = layout.names
    if layout.lanes == 1:
        fps = materialise(rows.groupBy("fp").agg(F.min("doc_id").alias("least")).withColumn("id", F.col("fp")), "distinct")
        found = links(narrow_signatures(fps), layout)
    else:
        fps = rows.groupBy(*lanes).agg(F.min("doc_id").alias("least"), F.min("sigs").alias("sigs"))
        fps = materialise(fps.withColumn("id", F.monotonically_increasing_id()), "distinct")
        found = links(fps.select(F.explode("sigs").alias("sig"), "id", *lanes), layout)
    roots = components(found)
    labels = materialise(fps.join(roots.withColumnRenamed("node", "id"), "id", "left").select(*lanes, "least", F.coalesce("root", "id").alias("label")), "labels")
    least = materialise(labels.groupBy("label").agg(F.min("least").alias("component_id")), "least")  # a table, so that the join can split a large component
    ids = labels.select(*lanes, "label").join(least, "label").withColumnRenamed("label", "component")
    return rows.drop("sigs").join(materialise(ids, "components"), lanes)


def keep_one(docs: DataFrame, layout: Layout | None = None) -> DataFrame:
    """One row of ``docs``, with all its columns, per component: the one with the component's id. Without a layout the wide one for the number of rows is taken."""
    layout = layout or wide(docs.count())
    found = near_duplicates(docs, layout).filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    stay = found.groupBy("component").agg(F.min(F.struct("doc_id", "text_key", "text_bytes")).alias("k")).select(*[F.col(f"k.{c}").alias(f"k_{c}") for c in KEY])
    inner = numbered(docs)
    doc_id, text = (F.col(f"c{docs.columns.index(c)}") for c in ("doc_id", "text"))
    text = F.coalesce(text, F.lit(""))
    same = doc_id.eqNullSafe(F.col("k_doc_id")) & (F.xxhash64(text) == F.col("k_text_key")) & (F.octet_length(text) == F.col("k_text_bytes"))
    joined = inner.join(stay, same)
    repeated = materialise(found.groupBy(*KEY).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1").select(*[F.col(c).alias(f"k_{c}") for c in KEY]), "repeated")
    if repeated.isEmpty():
        return restored(joined, docs)
    again = F.lit(True)
    for c in KEY:
        again &= joined[f"k_{c}"].eqNullSafe(repeated[f"k_{c}"])
    one = joined.join(repeated, again, "left_semi").groupBy(*[f"k_{c}" for c in KEY]).agg(F.first(F.struct(*inner.columns)).alias("row")).select("row.*")
    return restored(joined.join(repeated, again, "left_anti").select(*inner.columns).unionByName(one), docs)


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


QUERIES = {"op7_simhash": op7_simhash}
ORACLE_SQL: dict[str, str] = {}
