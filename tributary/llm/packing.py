"""Packing along a space-filling curve.

Each document's tokens are hashed into a vector that is projected to ``DIMENSIONS`` coordinates by a fixed random
matrix; the coordinates' place on a Hilbert curve is the sort key. Rows are range-partitioned by that key, so documents
with similar tokens are neighbours, and the tokens are laid end to end along the curve and cut every ``LENGTH`` tokens. Only the last sequence of all
has padding.

Texts are tokenized once; ids are kept in a table in the shared folder while narrow rows (key, count) are ranged. A document's place is the sum of the
tokens before its range partition plus the running sum within it; the driver sees no rows, the sums of the partitions are joined as a table.

Defined results: a null or empty text is its closing id alone. Ties of the key are ordered by id, then by the stored row. Repeated rows are packed
each by itself. An empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialise, table

LENGTH, CLOSING = 2048, 1
DIMENSIONS, GRID_BITS, SEED = 3, 16, 7
#: Runs that a worker remembers, bytes of text worked on at once, runs merged side by side.
CACHE, CHUNK, SIDE_BY_SIDE = 600_000, 1 << 22, 1 << 13
NEVER = np.int32(1 << 24)  # above every rank; ranks and columns share 31 bits
COLUMNS = 6  # bits of a column number
LONGEST = 1 << COLUMNS


def byte_signs() -> list[str]:
    """The sign of each byte in byte-level vocabularies: itself where printable, else the next free code point from 256."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b if b in plain else next(others)) for b in range(256)]


SPACE, LETTER, SIGN, DIGIT, ODD = range(5)


def byte_kinds() -> np.ndarray:
    """The kind of each byte. Letters are a-z, A-Z and U+00C0 to U+012F, whose lower case is their own; the apostrophe and all else is odd."""
    kinds = np.full(256, ODD, np.uint8)
    kinds[[*range(9, 14), 32]] = SPACE
    kinds[[c for c in range(33, 127) if c != ord("'")]] = SIGN
    kinds[48:58] = DIGIT
    kinds[[*range(65, 91), *range(97, 123), 0xC3, 0xC4, *range(0x80, 0xC0)]] = LETTER
    return kinds


KINDS = byte_kinds()
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


class PairRanks:
    """Rank and product of pairs of ids: every pair stands in one of two slots of a hash table."""

    def __init__(self, pairs: list[tuple[int, int]], made: list[int]):
        self.bits = max(4, (4 * len(pairs)).bit_length())
        self.key = np.full(1 << self.bits, -1, np.int64)
        self.rank = np.full(1 << self.bits, NEVER, np.int32)
        self.made = np.array(made, np.int32)
        keys = np.array([a << 32 | b for a, b in pairs], np.int64)
        slots = [s.tolist() for s in self._slots(keys)]
        taken: dict[int, int] = {}
        for i in range(len(keys)):
            at, moved = slots[0][i], i
            for _ in range(500):
                moved, taken[at] = taken.get(at, -1), moved
                if moved < 0:
                    break
                at = slots[0][moved] + slots[1][moved] - at  # its other slot
            else:
                raise ValueError("the pairs don't fit the table")
        at, of = np.array(list(taken), np.int64), np.array(list(taken.values()), np.int64)
        if len(of):
            self.key[at], self.rank[at] = keys[of], of

    def _slots(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x = keys.view(np.uint64)
        shift = np.uint64(64 - self.bits)
        return tuple(((x ^ x >> np.uint64(29)) * np.uint64(k) >> shift).astype(np.int64) for k in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93))

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        want = a.astype(np.int64) << 32 | b
        first, second = self._slots(want)
        return np.where(self.key[first] == want, self.rank[first], np.where(self.key[second] == want, self.rank[second], NEVER))


def gathered(pool: np.ndarray, first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The stretches of ``pool`` that start at ``first`` and are ``count`` long, end to end."""
    ends = np.cumsum(count)
    return pool[np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - ends + count, count)]


PROBE = "The quick-brown FOX's 42 jumps,\tover 3.5% of it!? don't (ÀÉ\u00a0x) ..."


class WordTokenizer:
    """Ids of whole texts, many at a time, through a cache of the ids of runs of letters and of signs.

    Strings of special tokens in a text are ordinary text (``encode_special_tokens``, as the vocabulary's notes have it), so a text can't close a document.
    The tokenizer must lower-case, drop white space, never join across it, split letters from signs and take digits one by one; one that codes ``PROBE`` otherwise is refused. The bytes of
    a chunk are cut into runs as a whole, equal runs are found by Arrow's dictionary, and only runs not seen before are merged, many side by side, by the merges of the
    tokenizer's file. Words with any other character go through the tokenizer itself.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        vocabulary = self.tokenizer.get_vocab()
        self.size = max(vocabulary.values()) + 1
        self.kind = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        with open(path) as f:
            merges = [pair if isinstance(pair, list) else pair.split(" ") for pair in json.load(f)["model"]["merges"]]
        self.ranks = PairRanks([(vocabulary[a], vocabulary[b]) for a, b in merges], [vocabulary[a + b] for a, b in merges])
        signs = byte_signs()
        self.inner = np.array([vocabulary[c] for c in signs], np.int32)
        self.last = np.array([vocabulary[c + "</w>"] for c in signs], np.int32)
        self._forget()
        probe = np.frombuffer(PROBE.encode(), np.uint8)
        if self.encode(probe, np.zeros(1, np.int64))[0].tolist() != self.tokenizer.encode(PROBE, add_special_tokens=False).ids:
            raise ValueError(f"{path} isn't a tokenizer of lower-case words")

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.first, self.count, self.pool = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, self.kind)

    def _direct(self, texts: list[bytes]) -> list[np.ndarray]:
        return [np.array(e.ids, self.kind) for e in self.tokenizer.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)]

    def _merged(self, runs: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, count, ids of these rows end to end) of runs of ``width`` bytes, merged side by side.

        Each round performs one merge, the leftmost of lowest rank, in every row left, so all rows left have the same number of ids.
        """
        raw = np.frombuffer(b"".join(runs), np.uint8).reshape(len(runs), width).T
        ids = self.inner[raw]
        ids[-1] = self.last[raw[-1]]
        ranks = self.ranks(ids[:-1], ids[1:])
        rows, ended = np.arange(len(runs)), []
        while len(rows):
            width = len(ids)
            best = np.full(len(rows), NEVER << COLUMNS if width > 1 else np.iinfo(np.int32).max, np.int32)
            for c in range(width - 1):
                np.minimum(best, (ranks[c] << COLUMNS) | c, out=best)
            going = best < NEVER << COLUMNS
            if not going.all():
                ended.append((rows[~going], np.full(int((~going).sum()), width), ids[:, ~going].T.ravel()))
                rows, best, ids, ranks = rows[going], best[going], ids[:, going], ranks[:, going]
                if not len(rows):
                    break
            at = best & (LONGEST - 1)
            new = self.ranks.made[best >> COLUMNS]
            column = np.arange(width - 1)[:, None]
            after = np.where(column < at, ids[:-1], ids[1:])
            of = np.arange(len(rows))
            after[at, of] = new
            if width > 2:
                ranks = np.where(column[:-1] < at, ranks[:-1], ranks[1:])
                has = np.flatnonzero(at > 0)
                ranks[at[has] - 1, has] = self.ranks(after[at[has] - 1, has], new[has])
                has = np.flatnonzero(at < width - 2)
                ranks[at[has], has] = self.ranks(new[has], after[at[has] + 1, has])
            else:
                ranks = ranks[:0]
            ids = after
        row, count, flat = (np.concatenate(x) for x in zip(*ended, strict=True))
        return row, count, flat.astype(self.kind)

    def _learn(self, runs: list[bytes], odd: list[bool]) -> None:
        """Add runs that aren't known; ``odd`` ones go through the tokenizer, white space has no ids."""
        groups: dict[int, list[int]] = {}
        direct = []
        count = np.zeros(len(runs), np.int64)
        for i, (run, strange) in enumerate(zip(runs, odd, strict=True)):
            if strange or len(run) >= LONGEST:
                direct.append(i)
            elif KINDS[run[0]] != SPACE:
                groups.setdefault(len(run), []).append(i)
        first, parts, total = np.zeros(len(runs), np.int64), [self.pool], len(self.pool)

        def add(of: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> None:
            nonlocal total
            count[of] = counts
            first[of] = total + np.cumsum(counts) - counts
            parts.append(ids)
            total += len(ids)

        for width, members in groups.items():
            for at in range(0, len(members), SIDE_BY_SIDE):
                some = members[at : at + SIDE_BY_SIDE]
                row, counts, ids = self._merged([runs[i] for i in some], width)
                add(np.array(some)[row], counts, ids)
        if direct:
            ids = self._direct([runs[i] for i in direct])
            add(np.array(direct), np.array([len(x) for x in ids]), np.concatenate(ids))
        self.known.update(zip(runs, range(len(self.known), len(self.known) + len(runs)), strict=True))
        self.first, self.count, self.pool = np.concatenate([self.first, first]), np.concatenate([self.count, count]), np.concatenate(parts)

    def _runs(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(lower-cased bytes, place of each run, runs that are odd words). Texts begin at ``starts``; a word with an odd byte is one run."""
        kind = KINDS[data]
        two = np.flatnonzero((data == 0xC3) | (data == 0xC4))
        low = LOWER[data]
        if len(two):
            latin, next_byte = data[two] == 0xC3, data[two + 1]
            kind[two[np.where(latin, (next_byte == 0x97) | (next_byte == 0xB7), next_byte > 0xAF)]] = ODD
            low[two + 1] += np.where(latin, np.where(next_byte < 0x9F, 32, 0), (next_byte + 1) & 1).astype(np.uint8)
        cut = np.ones(len(data), bool)
        np.not_equal(kind[1:], kind[:-1], out=cut[1:])
        cut |= kind == DIGIT
        cut[starts] = True
        odd = np.flatnonzero(kind == ODD)
        if not len(odd):
            return low, np.flatnonzero(cut), odd
        word = kind != SPACE
        begins = word.copy()
        begins[1:] &= ~word[:-1]
        begins[starts] = word[starts]
        begins = np.flatnonzero(begins)
        ends = np.append(begins[1:], len(data))  # with the white space that follows
        of = np.unique(np.searchsorted(begins, odd, "right") - 1)
        a, b = begins[of], ends[of]
        inside = np.zeros(len(data) + 1, np.int8)
        inside[a] = 1
        np.subtract.at(inside, b, 1)
        inside = (np.cumsum(inside[:-1], dtype=np.int8) > 0) & word
        low[inside] = data[inside]
        inside[a] = False  # a word itself begins a run
        cut &= ~inside
        at = np.flatnonzero(cut)
        return low, at, np.searchsorted(at, a)

    def encode(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids end to end, how many of each text) of the texts in ``data`` (bytes of UTF-8), which begin at ``starts``."""
        counts = np.zeros(len(starts), np.int64)
        ends = np.append(starts[1:], len(data))
        if not len(data):
            return np.zeros(0, self.kind), counts
        if len(self.known) > CACHE:
            self._forget()
        low, at, strange = self._runs(data, np.unique(starts[starts < ends]))
        offsets = np.append(at, len(data)).astype(np.int32)
        runs = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(low)]).dictionary_encode()
        index, names = runs.indices.to_numpy(), runs.dictionary.to_pylist()
        found = np.fromiter((-1 if k is None else k for k in map(self.known.get, names)), np.int64, len(names))
        new = np.flatnonzero(found < 0)
        if len(new):
            odd = np.zeros(len(names), bool)
            odd[index[strange]] = True
            found[new] = len(self.known) + np.arange(len(new))
            self._learn([names[i] for i in new.tolist()], odd[new].tolist())
        found = found[index]
        count = self.count[found]
        total = np.append(0, np.cumsum(count))
        counts = total[np.searchsorted(at, ends)] - total[np.searchsorted(at, starts)]
        some = np.flatnonzero(count)
        return gathered(self.pool, self.first[found[some]], count[some]), counts


@lru_cache(maxsize=1)
def tokenizer_of(path: str) -> WordTokenizer:
    """One tokenizer, with its caches, for all tasks of a worker."""
    return WordTokenizer(path)


def hilbert(grid: np.ndarray, bits: int = GRID_BITS) -> np.ndarray:
    """Place on the Hilbert curve of each row of whole coordinates in [0, 2^bits)."""
    x = grid.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            flip = (x[i] & q) > 0
            swap = np.where(flip, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(flip, x[0] ^ p, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        turn = np.where((x[n - 1] & q) > 0, turn ^ (q - 1), turn)
        q >>= 1
    x ^= turn
    key = np.zeros(x.shape[1], np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << 1 | (x[i] >> b & 1)
    return key


def chunks(bounds: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of texts of ``CHUNK`` bytes at most, or of one text; text i lies from bounds[i] to bounds[i + 1]."""
    at = 0
    while at < len(bounds) - 1:
        to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + CHUNK, "right")) - 1)
        yield at, to
        at = to


def encoded(tokenizer: WordTokenizer, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As ``encode``; a text longer than ``CHUNK`` is worked off in pieces that end before white space."""
    if len(data) <= CHUNK or len(starts) > 1:
        return tokenizer.encode(data, starts)
    parts, at = [], 0
    while at < len(data):
        to = at + CHUNK
        if to < len(data):
            gaps = np.flatnonzero(KINDS[data[at + 1 : to]] == SPACE)
            if len(gaps):
                to = at + 1 + int(gaps[-1])
            else:
                while to < len(data) and KINDS[data[to]] != SPACE:
                    to += 1
        parts.append(tokenizer.encode(data[at:to], np.zeros(1, np.int64))[0])
        at = to
    ids = np.concatenate(parts)
    return ids, np.array([len(ids)])


def tokens(docs: DataFrame, path: str, closing: int = CLOSING) -> DataFrame:
    """(doc_id, ids binary, n_tokens, place) of each row; ids end with ``closing``. Little-endian, two bytes each if the vocabulary allows, else four."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = tokenizer_of(path)
        axes = np.random.default_rng(SEED).standard_normal((DIMENSIONS, max(tokenizer.size, closing + 1))).astype(np.float32)
        for batch in batches:
            texts = pc.fill_null(batch.column(1), "").cast(pa.large_string())
            bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
            data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
            for at, to in chunks(bounds):
                ids, counts = encoded(tokenizer, data[bounds[at] : bounds[to]], bounds[at:to] - bounds[at])
                ids = np.insert(ids, np.cumsum(counts), closing)
                counts += 1
                ends = np.cumsum(counts)
                spot = np.stack([np.add.reduceat(axis[ids], ends - counts, dtype=np.float64) for axis in axes], axis=1)
                spot /= np.linalg.norm(spot, axis=1, keepdims=True)
                place = hilbert(np.clip((spot + 1) / 2 * (1 << GRID_BITS), 0, (1 << GRID_BITS) - 1).astype(np.int64))
                offsets = np.append(0, ends * ids.itemsize).astype(np.int64)
                raw = pa.Array.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(offsets), pa.py_buffer(ids)]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, to - at), raw, pa.array(counts), pa.array(place)], ["doc_id", "ids", "n_tokens", "place"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids binary, n_tokens long, place long")


def positions(rows: DataFrame) -> DataFrame:
    """(row_id, position): the tokens that stand before each row along the curve."""
    order = ["place", "doc_id", "row_id"]
    ranged = rows.select("row_id", "doc_id", "place", "n_tokens").repartitionByRange(*order).withColumn("part", F.spark_partition_id())
    ranged = materialise(ranged, "ranged")
    sums = ranged.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = sums.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))  # a row for each range partition
    running = F.sum("n_tokens").over(Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)) - F.col("n_tokens")
    return ranged.withColumn("running", running).join(F.broadcast(before), "part").select("row_id", (F.col("before") + F.col("running")).alias("position"))


def pack(docs: DataFrame, path: str, length: int = LENGTH, closing: int = CLOSING) -> DataFrame:
    """One row per piece: (doc_id, start, length, ids, doc_tokens, sequence_id, offset); ids are unsigned 32-bit, little-endian."""
    schema = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    names = [part.split()[0] for part in schema.split(", ")]
    stored = materialise(tokens(docs, path, closing).withColumn("row_id", F.monotonically_increasing_id()), "tokens")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, raw, n_tokens, position in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids = np.frombuffer(raw, f"<u{len(raw) // n_tokens}").astype("<u4")
                at = 0
                while at < len(ids):
                    offset = (position + at) % length
                    n = min(length - offset, len(ids) - at)
                    out.append((doc, at, n, ids[at : at + n].tobytes(), len(ids), (position + at) // length, offset))
                    at += n
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True) if out else [[]] * 7, kinds, strict=True)], names)

    return stored.select("row_id", "doc_id", "ids", "n_tokens").join(positions(stored), "row_id").select("doc_id", "ids", "n_tokens", "position").mapInArrow(run, schema)


def crc32(ids: DataFrame) -> DataFrame:
    """The pieces with the CRC-32 of their ids in place of the ids."""
    return ids.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return crc32(pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")))


QUERIES = {"op6_packing": op6_packing}
ORACLE_SQL: dict[str, str] = {}
