"""Conversation prefix trie by vertical bitmaps.

Conversations lie in order of their ids in range partitions and are worked off in shards of ``SHARD`` conversations, or of more than ``TURNS`` turns. In a shard, a posting (position, turn) is a bitset of its
conversations. A depth-first walk intersects the bitset of a node with the postings of the next position: that gives the children, popcounts, the smallest member and the list of
conversations that end there. Nodes of all shards are merged by the digest of their prefix, a chain over the digests of turns.

What hangs on a subtree (leaves, saved tokens) is known only after merging. Each node then goes back to the one shard that holds its smallest member, where subtrees are stretches of the walk's order and sums
are differences of a running sum; the shards' sums are added up by prefix. So the number of jobs doesn't grow with the depth.

Hot keys: a node that many conversations share, the root for one, is one row a shard. Its ends come as one text a shard, in order, and a task feeds them one by one to SHA-256, which must read them in
order; it holds no more than a batch of them. Joins to a hot parent are split by adaptive execution. Texts are hashed in the first scan and never shuffled. A conversation is put together
in one task, from 16 bytes and a length a turn.

Defined results: a null role or text is empty; null turns come first; turns that tie go by the digest of role and text, so repeated rows stay as repeated turns. Rows without
conv_id belong to no conversation and are left out. A conversation may have no turn. Long texts are hashed whole. An empty table gives no nodes, not even a root. Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialise, table

SHARD, TURNS = 1024, 100_000
ROOT = bytes(16)
FAMILY, MOST_SHARED = 5, 9
LOCAL = "shard long, no int, span int, depth int, prefix binary, parent binary, n long, least long, last_bytes long, ends string"
LOCAL_TYPES = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.string()]


def digested(conversations: DataFrame) -> DataFrame:
    """(conv_id, p, digest, bytes): the p-th turn of each conversation of (conv_id, turn, role, text, ...), from 1."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.unhex(F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 32))
    rows = conversations.filter(F.col("conv_id").isNotNull()).select("conv_id", "turn", digest.alias("digest"), F.octet_length(text).cast("long").alias("bytes"))
    return rows.withColumn("p", F.row_number().over(Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "digest"))).drop("turn")


def shared_turns(conv_id: Column) -> Column:
    """How many turns a conversation takes from the first of its family."""
    return (F.crc32(conv_id.cast("string").cast("binary")) % MOST_SHARED).cast("int")


def rebuilt(turns: DataFrame) -> DataFrame:
    """(conv_id, p, digest, bytes) with each conversation's first turns taken from the first of its family; p = 0 is a row of the conversation itself."""
    h = shared_turns(F.col("conv_id"))
    own = turns.filter(F.col("p") > h)
    first = turns.filter((F.col("conv_id") % FAMILY == 0) & (F.col("p") < MOST_SHARED))
    near = F.explode(F.sequence(F.col("conv_id") - (FAMILY - 1), F.col("conv_id") + (FAMILY - 1)))
    lent = first.select(near.alias("near"), "conv_id", "p", "digest", "bytes").withColumnsRenamed({"conv_id": "head", "near": "conv_id"})
    lent = lent.filter((F.col("conv_id") - F.col("conv_id") % FAMILY == F.col("head")) & (F.col("p") <= h)).drop("head")
    there = turns.filter("p = 1").select("conv_id")
    names = ["conv_id", "p", "digest", "bytes"]
    marks = there.select("conv_id", F.lit(0).alias("p"), F.lit(None).cast("binary").alias("digest"), F.lit(0).cast("long").alias("bytes"))
    return own.select(names).unionByName(lent.join(there, "conv_id", "left_semi").select(names)).unionByName(marks)


def walk(ids: list[int], paths: list[list[bytes]], sizes: list[list[int]]) -> list[list]:
    """The columns of ``LOCAL`` of one shard: ``ids`` ascend, ``paths`` hold the digests of turns, ``sizes`` their bytes."""
    postings: dict[tuple[int, bytes], int] = {}
    longer = [0] * (max(map(len, paths)) + 1)
    for i, path in enumerate(paths):
        bit = 1 << i
        for d, turn in enumerate(path):
            postings[d, turn] = postings.get((d, turn), 0) | bit
            longer[d] |= bit
    depths, prefixes, parents, above, counts, least, last, ends = [], [], [], [], [], [], [], []
    stack = [((1 << len(ids)) - 1, 0, ROOT, None, -1)]
    while stack:
        members, depth, prefix, parent, parent_no = stack.pop()
        no, low = len(depths), (members & -members).bit_length() - 1
        depths.append(depth)
        prefixes.append(prefix)
        parents.append(parent)
        above.append(parent_no)
        counts.append(members.bit_count())
        least.append(ids[low])
        last.append(sizes[low][depth - 1] if depth else 0)
        rest = members & longer[depth]
        over, done = members ^ rest, []
        while over:
            bit = over & -over
            done.append(str(ids[bit.bit_length() - 1]))
            over ^= bit
        ends.append(",".join(done) or None)
        while rest:
            turn = paths[(rest & -rest).bit_length() - 1][depth]
            child = members & postings[depth, turn]
            stack.append((child, depth + 1, hashlib.blake2b(prefix + turn, digest_size=16).digest(), prefix, no))
            rest &= ~child
    spans = [1] * len(depths)
    for no in range(len(depths) - 1, 0, -1):
        spans[above[no]] += spans[no]
    return [[ids[0]] * len(depths), list(range(len(depths))), spans, depths, prefixes, parents, counts, least, last, ends]


def _batch(columns: list, types: list, names: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], [c.split()[0] for c in names.split(", ")])


def local_nodes(paths: DataFrame) -> DataFrame:
    """The nodes of each shard (``LOCAL``): no counts the walk's order, ``span`` the nodes of a subtree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, turns, sizes, held = [], [], [], 0
        for batch in batches:
            for conv, digest, size in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if not ids or ids[-1] != conv:
                    if len(ids) >= SHARD or held > TURNS:
                        yield _batch(walk(ids, turns, sizes), LOCAL_TYPES, LOCAL)
                        ids, turns, sizes, held = [], [], [], 0
                    ids.append(conv)
                    turns.append([])
                    sizes.append([])
                if digest is not None:
                    turns[-1].append(digest)
                    sizes[-1].append(size)
                    held += 1
        if ids:
            yield _batch(walk(ids, turns, sizes), LOCAL_TYPES, LOCAL)

    return paths.repartitionByRange("conv_id").sortWithinPartitions("conv_id", "p").select("conv_id", "digest", "bytes").mapInArrow(run, LOCAL)


def subtree_sums(placed: DataFrame) -> DataFrame:
    """(prefix, n_leaves, saved_tokens) summed over the subtrees of each shard, from (shard, no, span, prefix, leaf, saved)."""
    schema, types = "prefix binary, n_leaves long, saved_tokens long", [pa.binary(), pa.int64(), pa.int64()]

    def summed(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(parts)
        no, span = rows["no"].to_numpy().astype(np.int64), rows["span"].to_numpy()
        sums = []
        for name in ("leaf", "saved"):
            so_far = np.append(0, np.cumsum(rows[name].to_numpy()))
            sums.append(so_far[no + span] - so_far[no])
        return pa.RecordBatch.from_arrays([rows["prefix"].combine_chunks(), *map(pa.array, sums)], ["prefix", "n_leaves", "saved_tokens"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = []
        for batch in batches:
            starts = np.flatnonzero(batch.column("no").to_numpy() == 0).tolist()
            for at, to in zip([0, *starts], [*starts, batch.num_rows], strict=True):
                if at in starts and parts:
                    yield summed(parts)
                    parts = []
                if to > at:
                    parts.append(batch.slice(at, to - at))
        if parts:
            yield summed(parts)

    return placed.repartition("shard").sortWithinPartitions("shard", "no").select("no", "span", "prefix", "leaf", "saved").mapInArrow(run, schema)


def ends_digests(ends: DataFrame) -> DataFrame:
    """(prefix, ends_sha256) of (prefix, shard, ends): the SHA-256 of the lists of all shards in order, joined by commas."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            out = []
            for prefix, part in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if prefix == now:
                    state.update(b",")
                else:
                    if now is not None:
                        out.append((now, state.hexdigest()))
                    now, state = prefix, hashlib.sha256()
                state.update(part.encode())
            if out:
                yield _batch(list(zip(*out, strict=True)), [pa.binary(), pa.string()], "prefix binary, ends_sha256 string")
        if now is not None:
            yield _batch([[now], [state.hexdigest()]], [pa.binary(), pa.string()], "prefix binary, ends_sha256 string")

    return ends.repartition("prefix").sortWithinPartitions("prefix", "shard").select("prefix", "ends").mapInArrow(run, "prefix binary, ends_sha256 string")


def trie(paths: DataFrame) -> DataFrame:
    """The nodes of the trie of ``paths`` (conv_id, p, digest, bytes), turns in order of p; a row without digest is a conversation that may have no turns."""
    local = materialise(local_nodes(paths), "local")
    merged = local.groupBy("prefix", "parent", "depth", "last_bytes").agg(F.sum("n").alias("n_convs"), F.min("least").alias("conv_id"))
    merged = materialise(merged, "merged")
    below = merged.groupBy(F.col("parent").alias("prefix")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = materialise(merged.join(below, "prefix", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))), "nodes", replaces=merged)
    leaf, saved = (F.col("n_children") == 0).cast("long"), (F.col("n_convs") - 1) * F.col("last_bytes")
    own = nodes.select("prefix", F.col("conv_id").alias("least"), leaf.alias("leaf"), saved.alias("saved"))
    zero = F.lit(0).cast("long")
    placed = local.select("shard", "no", "span", "prefix", "least").join(own, ["prefix", "least"], "left").withColumns({"leaf": F.coalesce("leaf", zero), "saved": F.coalesce("saved", zero)})
    sums = subtree_sums(placed).groupBy("prefix").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    ends = ends_digests(local.filter(F.col("ends").isNotNull()).select("prefix", "shard", "ends"))
    above = nodes.select(F.col("prefix").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    out = nodes.join(sums, "prefix").join(ends, "prefix", "left").join(above, "parent", "left")
    sha = F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest()))
    return out.select("conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", sha.alias("ends_sha256"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(rebuilt(materialise(digested(table(spark, sf_dir, "conversations")), "turns")))


QUERIES = {"op12_prefix_trie": op12_prefix_trie}
ORACLE_SQL = {
    "op12_prefix_trie": """
        WITH RECURSIVE crc(c, s, i, v) AS (
          SELECT conv_id, conv_id::VARCHAR, 0, 4294967295::BIGINT FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL)
          UNION ALL
          SELECT c, s, i + 1, CASE WHEN b % 2 = 1 THEN xor(b // 2, 3988292384) ELSE b // 2 END
          FROM (SELECT c, s, i, CASE WHEN i % 8 = 0 THEN xor(v, ascii(s[i // 8 + 1])::BIGINT) ELSE v END AS b FROM crc WHERE i < 8 * length(s))),
        heads AS (SELECT c, xor(v, 4294967295) % 9 AS h FROM crc WHERE i = 8 * length(s)),
        turns AS (SELECT conv_id, strlen(coalesce("text", '')) AS bytes, sha256(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce("text", '')) AS t, turn FROM conversations),
        numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, t) AS p FROM turns),
        rebuilt AS (SELECT c, p, t FROM heads JOIN numbered ON conv_id = c AND p > h UNION ALL SELECT c, p, t FROM heads JOIN numbered ON conv_id = c - c % 5 AND p <= h),
        paths AS (SELECT heads.c, coalesce(list(t ORDER BY p) FILTER (t IS NOT NULL), []) AS path FROM heads LEFT JOIN rebuilt USING (c) GROUP BY heads.c),
        nodes AS (SELECT path[:d] AS pre, d, min(c) AS conv_id, count(*) AS n_convs, coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (len(path) = d), '') AS ends
          FROM (SELECT c, path, unnest(range(0, len(path) + 1)) AS d FROM paths) GROUP BY path[:d], d),
        children AS (SELECT pre[:d - 1] AS pre, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1),
        sizes AS (SELECT t, max(bytes) AS bytes FROM turns GROUP BY t),
        owned AS (SELECT nodes.pre, nodes.d, (children.n IS NULL)::BIGINT AS leaf, (n_convs - 1) * coalesce(bytes, 0) AS saved FROM nodes LEFT JOIN children USING (pre) LEFT JOIN sizes ON d > 0 AND t = nodes.pre[d]),
        sums AS (SELECT pre[:k] AS pre, sum(leaf) AS n_leaves, sum(saved) AS saved FROM (SELECT *, unnest(range(0, d + 1)) AS k FROM owned) GROUP BY 1)
        SELECT nodes.conv_id, nodes.d::BIGINT AS depth, above.conv_id AS parent_conv_id, nodes.n_convs, coalesce(children.n, 0) AS n_children, sums.n_leaves::BIGINT AS n_leaves, sums.saved::BIGINT AS saved_tokens, sha256(nodes.ends) AS ends_sha256
        FROM nodes JOIN sums USING (pre) LEFT JOIN children USING (pre) LEFT JOIN nodes above ON nodes.d > 0 AND above.pre = nodes.pre[:nodes.d - 1]""",
}
