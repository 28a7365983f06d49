"""Byte-level BPE encoding and decoding with a segment tree.

A pre-token of n bytes has a tree over its n byte positions. The leaf of a live position holds
``rank * n + position`` of the pair that it forms with the next live position, so the root is the leftmost
pair of minimum rank. A merge changes three leaves (the pair itself, the neighbour before it, and the position
that dies) and recomputes their paths: O(log n). Live neighbours are kept as linked lists.

Trees of short pre-tokens lie side by side in one numpy matrix, one row each, and every round performs one merge in
each row that has one left. Longer pre-tokens get a tree of their own. Pre-tokens that are whole entries of the vocabulary are taken as they are, as in the
public library. Distinct pre-tokens are encoded once per task, within a bounded cache.

The split pattern never joins characters across a single white space between two other characters: a space there
opens the next pre-token, a line feed is one by itself. Texts with no other white space are therefore cut at spaces and
line feeds first, and the pattern runs once per distinct piece instead of over every text.

Defined results: a null or empty text has no tokens. Any text is decoded to its own bytes. Extra columns,
repeated rows and empty tables need no special rule: every row is encoded by itself.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from .common import table

NONE = np.iinfo(np.int64).max
SHORT = 64
CACHE = 400_000
CHUNK = 2_000_000
RARE_SPACES = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"]


def irregular(text: str) -> bool:
    """Whether there is other white space than single spaces and line feeds between two other characters."""
    return not text or text[0] in " \n" or text[-1] in " \n" or any(p in text for p in ("  ", " \n", "\n ", "\n\n")) or any(c in text for c in RARE_SPACES)


class BytePairEncoder:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.bytes_of = {v: k for k, v in ranks.items()}
        self.find = regex.compile(pattern.replace(r"\s", r"\p{White_Space}")).findall
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = {}
        for token, rank in ranks.items():
            for k in range(1, len(token)):
                a, b = ranks.get(token[:k]), ranks.get(token[k:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = rank
        self.pairs = pairs
        self.keys = np.array(sorted(pairs), np.int64)
        self.values = np.array([pairs[k] for k in self.keys.tolist()], np.int64)
        self.cache: dict[str, bytes] = {}
        self.spaced: dict[str, bytes] = {}
        self.plain: dict[str, bytes] = {}

    def pair_ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ranks of the merged pairs; NONE where there is no such entry."""
        want = a << 32 | b
        at = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
        return np.where(self.keys[at] == want, self.values[at], NONE)

    def _forest(self, words: list[bytes], width: int) -> list[bytes]:
        """Encode words of 2 to ``width`` bytes, ``width`` a power of two, in rounds of one merge a word."""
        count = len(words)
        lengths = np.array([len(w) for w in words])
        column = np.arange(width)
        inside = column < lengths[:, None]
        token = np.zeros((count, width), np.int64)
        token[inside] = self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        after = np.where(column + 1 < lengths[:, None], column + 1, width) * np.ones((count, 1), np.int64)
        before = np.tile(column - 1, (count, 1))
        live = inside.copy()
        tree = np.full((count, 2 * width), NONE, np.int64)
        row, col = np.nonzero(column + 1 < lengths[:, None])
        rank = self.pair_ranks(token[row, col], token[row, col + 1])
        tree[row, width + col] = np.where(rank == NONE, NONE, rank * width + col)
        level = width
        while level > 1:
            tree[:, level // 2 : level] = np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2])
            level //= 2
        at = np.flatnonzero(tree[:, 1] != NONE)
        while len(at):
            root = tree[at, 1]
            i, new = root % width, root // width
            j = after[at, i]
            k = after[at, j]
            token[at, i] = new
            live[at, j] = False
            after[at, i] = k
            more = k < width
            before[at[more], k[more]] = i[more]
            tree[at, width + j] = NONE
            rank = np.full(len(at), NONE, np.int64)
            rank[more] = self.pair_ranks(new[more], token[at[more], k[more]])
            tree[at, width + i] = np.where(rank == NONE, NONE, rank * width + i)
            p = before[at, i]
            has = p >= 0
            rows, prior = at[has], p[has]
            rank = self.pair_ranks(token[rows, prior], new[has])
            tree[rows, width + prior] = np.where(rank == NONE, NONE, rank * width + prior)
            rows = np.concatenate([at, at, rows])
            node = np.concatenate([i, j, prior]) + width
            for _ in range(width.bit_length() - 1):
                node >>= 1
                tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])
            at = at[tree[at, 1] != NONE]
        ids = token[live].astype("<u4").tobytes()
        ends = np.cumsum(live.sum(axis=1)) * 4
        return [ids[e - 4 * n : e] for e, n in zip(ends.tolist(), live.sum(axis=1).tolist(), strict=True)]

    def _alone(self, word: bytes) -> bytes:
        """One long word, by the same tree in plain lists: O(n log n)."""
        n = len(word)
        width = 1 << (n - 1).bit_length()
        token = self.byte_ids[np.frombuffer(word, np.uint8)].tolist()
        after, before = [*range(1, n), width], list(range(-1, n - 1))
        get = self.pairs.get
        tree = [NONE] * (2 * width)
        for i in range(n - 1):
            if (rank := get(token[i] << 32 | token[i + 1])) is not None:
                tree[width + i] = rank * width + i
        for node in range(width - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])

        def put(i: int, key: int) -> None:
            node = width + i
            tree[node] = key
            while node > 1:
                node >>= 1
                a, b = tree[2 * node], tree[2 * node + 1]
                best = a if a < b else b
                if tree[node] == best:
                    return
                tree[node] = best

        while (root := tree[1]) != NONE:
            new, i = divmod(root, width)
            j = after[i]
            k = after[j]
            token[i], after[i], token[j] = new, k, -1
            put(j, NONE)
            rank = get(new << 32 | token[k]) if k < n else None
            put(i, NONE if rank is None else rank * width + i)
            if k < n:
                before[k] = i
            p = before[i]
            if p >= 0:
                rank = get(token[p] << 32 | new)
                put(p, NONE if rank is None else rank * width + p)
        return np.array([t for t in token if t >= 0], "<u4").tobytes()

    def learn(self, words: set[str]) -> None:
        """Put the ids of ``words`` into the cache."""
        groups: dict[int, tuple[list[str], list[bytes]]] = {}
        for w in words:
            b = w.encode()
            if (rank := self.ranks.get(b)) is not None:
                self.cache[w] = rank.to_bytes(4, "little")
            elif len(b) > SHORT:
                self.cache[w] = self._alone(b)
            else:
                names, data = groups.setdefault(max(2, 1 << (len(b) - 1).bit_length()), ([], []))
                names.append(w)
                data.append(b)
        for width, (names, data) in groups.items():
            for at in range(0, len(names), 1 << 14):
                self.cache.update(zip(names[at : at + (1 << 14)], self._forest(data[at : at + (1 << 14)], width), strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        for held in (self.cache, self.spaced, self.plain):
            if len(held) > CACHE:
                held.clear()
        cut = [None if irregular(t) else [line.split(" ") for line in t.split("\n")] for t in texts]
        firsts = {line[0] for lines in cut if lines for line in lines} - self.plain.keys()
        others = set().union(*(line[1:] for lines in cut if lines for line in lines)) - self.spaced.keys()
        whole = [self.find(t) if lines is None else None for t, lines in zip(texts, cut, strict=True)]
        split = {p: self.find(p) for p in firsts}, {p: self.find(" " + p) for p in others}
        words = [w for pieces in split for ws in pieces.values() for w in ws] + [w for ws in whole if ws for w in ws]
        self.learn({*words, "\n"} - self.cache.keys())
        get, spaced, plain = self.cache.__getitem__, self.spaced.__getitem__, self.plain.__getitem__
        for held, pieces in zip((self.plain, self.spaced), split, strict=True):
            held.update((p, b"".join(map(get, ws))) for p, ws in pieces.items())
        feed, out = get("\n"), []
        for ws, lines in zip(whole, cut, strict=True):
            out.append(b"".join(map(get, ws)) if lines is None else feed.join([plain(x[0]) + b"".join(map(spaced, x[1:])) for x in lines]))
        return out

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def chunks(texts: list[str | None], size: int = CHUNK) -> Iterator[list[str]]:
    """The texts in order, in lists of about ``size`` characters at most, or of one longer text."""
    out, total = [], 0
    for t in texts:
        t = t or ""
        if out and total + len(t) > size:
            yield out
            out, total = [], 0
        out.append(t)
        total += len(t)
    if out:
        yield out


def encoded(docs: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """(doc_id, ids binary, decoded binary) of each row; ids are little-endian unsigned 32-bit integers."""
    return _per_row(docs, vocabulary, pattern, "doc_id long, ids binary, decoded binary", lambda ids, back: [ids, back], [pa.binary(), pa.binary()])


def digests(docs: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): the same rows as ``encoded``, without the bytes."""
    sha = lambda x: hashlib.sha256(x).hexdigest()
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return _per_row(docs, vocabulary, pattern, schema, lambda ids, back: [len(ids) // 4, sha(ids), sha(back)], [pa.int64(), pa.string(), pa.string()])


def _per_row(docs: DataFrame, vocabulary: str, pattern: str, schema: str, make, kinds: list[pa.DataType]) -> DataFrame:
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = BytePairEncoder(load_ranks(vocabulary), pattern)
        for batch in batches:
            keys, texts, at = batch.column(0), batch.column(1).to_pylist(), 0
            for part in chunks(texts):
                rows = [make(ids, bpe.decode(ids)) for ids in bpe.encode(part)]
                columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([keys.slice(at, len(part)), *columns], names)
                at += len(part)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


QUERIES = {"op10_byte_bpe": op10_byte_bpe}
ORACLE_SQL: dict[str, str] = {}
