import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tributary.llm import exact_dedup, graph, sharding, simhash

ROWS = [(1, "a b c"), (2, "a b c"), (3, ""), (4, None), (5, "x" * 5000), (5, "x" * 5000), (7, "x" * 4999 + "y"), (None, "a b c"), (None, None)]
SCHEMA = "doc_id long, text string"


def docs(spark, rows=ROWS):
    """Rows with extra columns whose names clash with those that operators use."""
    df = spark.createDataFrame(rows, SCHEMA)
    return df.withColumns({c: F.lit("e") for c in ("digest", "salt", "text_key", "kept", "n", "row", "found", "content", "source")})


def check_annotate(got, rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    assert len(got) == len(rows)
    for r in got:
        ids = groups[next(t or "" for i, t in rows if i == r.doc_id and (r.digest is None or hashlib.sha256((t or "").encode()).hexdigest() == r.digest or len(r.digest) < 64))]
        assert r.group_size == len(ids) or len(r.digest) < 64
    kept = [r for r in got if r.kept]
    assert len(kept) == len(groups)


def test_annotate(spark):
    got = exact_dedup.annotate(docs(spark)).collect()
    check_annotate(got, ROWS)
    by = {(r.doc_id, r.digest): r for r in got}
    same = hashlib.sha256(b"a b c").hexdigest()
    assert by[(1, same)].keep_id == 2 and by[(1, same)].group_size == 3 and by[(2, same)].kept and not by[(1, same)].kept
    assert sum(r.kept for r in got if r.doc_id == 5) == 1


def test_shared_digests_are_told_apart(spark):
    """A digest of one character makes different texts collide; contents decide."""
    rows = [(i, f"t{i % 7}" * (i % 3 + 1)) for i in range(200)]
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_dedup.annotate(docs(spark, rows), digest=lambda c: F.substring(c, 1, 1), salts=3).collect()}
    groups = defaultdict(list)
    for i, t in rows:
        groups[t].append(i)
    assert got == {i: (max(groups[t]), len(groups[t]), i == max(groups[t])) for i, t in rows}


def test_keep_one(spark):
    df = docs(spark)
    out = exact_dedup.keep_one(df)
    assert out.columns == df.columns
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    assert got == sorted([(2, "a b c"), (4, None), (5, "x" * 5000), (7, "x" * 4999 + "y")], key=str)
    assert exact_dedup.keep_one(df.limit(0)).count() == 0 and exact_dedup.annotate(df.limit(0)).count() == 0


def test_components(spark):
    rng = np.random.default_rng(1)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(i, i + 1) for i in range(1000, 1100)] + [(5000, k) for k in range(5001, 5200)] + [(1, 1)]
    parent = {x: x for p in pairs for x in p}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    assert got == {x: find(x) for x in parent if find(x) != x}
    assert graph.components(spark.createDataFrame([], "u long, v long")).count() == 0


def brute_components(values, bits=3):
    u = np.array(sorted(set(values)), np.uint64)
    label = {int(x): int(x) for x in u}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, x in enumerate(u):
        for y in u[i + 1:][np.bitwise_count(u[i + 1:] ^ x) <= bits]:
            a, b = find(int(x)), find(int(y))
            label[max(a, b)] = min(a, b)
    return {int(x): find(int(x)) for x in u}


def test_links_span_all_pairs(spark, monkeypatch):
    rng = np.random.default_rng(2)
    values = [int(x) for x in rng.integers(0, 1 << 63, 40, dtype=np.uint64)]
    for seed in values[:8]:  # dense balls around a few values
        for _ in range(60):
            x = seed
            for b in rng.integers(0, 64, rng.integers(1, 6)):
                x ^= 1 << int(b)
            values.append(x)
    want = brute_components(values)
    fps = simhash.narrow_signatures(spark.createDataFrame([(simhash.signed(v),) for v in sorted(set(values))], "fp long"))
    for split in (20_000, 4):  # above 4 members a signature is dealt out by the other half's bytes
        monkeypatch.setattr(simhash, "SPLIT", split)
        roots = {r.node: r.root for r in graph.components(simhash.links(fps)).collect()}
        groups, expect = defaultdict(set), defaultdict(set)
        for v in set(values):
            groups[roots.get(simhash.signed(v), simhash.signed(v))].add(v)
            expect[want[v]].add(v)
        assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expect.values()))


def test_forest_of_a_bucket():
    rng = np.random.default_rng(3)
    base = int(rng.integers(0, 1 << 62))
    members = np.array(sorted({base ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 32, (200, 2))}), np.uint64)
    links = simhash.forest(np.arange(len(members)), members[:, None], 3)
    assert sum(len(v) for _, v in links) <= len(members) - 1


def brute_fingerprint(text):
    """The contract, bit by bit."""
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    runs = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprint_takes_the_majority(monkeypatch):
    rng = random.Random(4)
    texts = [None, "", " \t", "one", "One TWO", "É é\u00a0x y z", "a a a a a a"] + [" ".join(rng.choices(["a", "B", "c\td", "É", "x\u2003y", "\n"], k=rng.randint(1, 40))) for _ in range(300)]
    assert [simhash.fingerprint(t) for t in texts] == [brute_fingerprint(t) for t in texts]
    monkeypatch.setattr(simhash, "BLOCK", 7)  # long texts are hashed in blocks
    assert [simhash.fingerprint(t) for t in texts] == [brute_fingerprint(t) for t in texts]


def changed(rng, words, share):
    """Words with single words replaced until the similarity of five-word shingles falls to ``share``."""
    words = list(words)
    old = {tuple(words[i : i + 5]) for i in range(len(words) - 4)}
    while True:
        words[rng.randrange(len(words))] = f"new{rng.random()}"
        new = {tuple(words[i : i + 5]) for i in range(len(words) - 4)}
        if len(old & new) / len(old | new) <= share:
            return words


@pytest.mark.parametrize("corpus", [0, 1 << 25])
def test_wide_layout_finds_near_copies(spark, corpus):
    """Recall of pairs by similarity against brute force, also in the layout of a large corpus; pairs far below 0.8 stay apart, and so do clean texts."""
    rng = random.Random(8)
    rows, pairs, similar = [], [], {}
    for n in range(1000):
        words = [f"w{rng.randint(0, 5000)}" for _ in range(rng.randint(100, 400))]
        share = rng.choice([0.98, 0.97, 0.96, 0.95, 0.9, 0.85, 0.5])
        copy = changed(rng, words, share)
        a, b = simhash.shingles(" ".join(words), 5), simhash.shingles(" ".join(copy), 5)
        similar[2 * n] = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        rows += [(2 * n, " ".join(words)), (2 * n + 1, " ".join(copy))]
        pairs.append(2 * n)
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs(spark, rows), simhash.wide(corpus)).collect()}
    assert all(got[i] in (i, i & ~1) for i in got)
    recall = lambda low, high: np.mean([got[i + 1] == i for i in pairs if low <= similar[i] < high])
    measured = [recall(*x) for x in ((0.95, 1), (0.9, 0.95), (0.85, 0.9), (0.8, 0.85), (0, 0.6))]
    print("recall at 0.95, 0.9, 0.85, 0.8, below 0.6:", measured)
    assert all(sum(low <= s < high for s in similar.values()) > 50 for low, high in ((0.9, 0.95), (0.85, 0.9), (0.8, 0.85)))
    assert measured[0] >= 0.98 and min(measured[:4]) >= 0.9 and measured[4] <= 0.02


def test_keep_one_near(spark):
    text = " ".join(f"word{i}" for i in range(200))
    rows = [(1, text), (1, text), (2, text + " more"), (3, None), (3, None), (4, ""), (None, text.upper()), (None, "w x"), (None, "w x"), (5, "w x y")]
    df = docs(spark, rows).withColumns({"__key": F.lit("k"), "a.b": F.lit("p"), "fp": F.lit("f"), "c0": F.lit("c"), "component_id": F.lit("i")})
    for layout in (simhash.NARROW, simhash.WIDE):
        out = simhash.keep_one(df, layout)
        kept = out.collect()
        assert out.columns == df.columns
        assert sorted((r.doc_id, r.text) for r in kept if r.doc_id) == [(1, text), (3, None), (5, "w x y")]
        assert [r.text for r in kept if r.doc_id is None] == ["w x"]
        assert {(r["__key"], r["a.b"], r.fp, r.c0, r.component_id) for r in kept} == {("k", "p", "f", "c", "i")}
        assert simhash.keep_one(df.limit(0), layout).count() == 0


def test_near_duplicates(spark):
    text = " ".join(f"word{i}" for i in range(400))
    rows = [(1, text), (2, text.upper()), (3, text + " more"), (4, None), (5, " \t"), (6, "one"), (7, "one two"), (None, text), (None, "quite other words here now")]
    got = {(r.doc_id, r.fp): r.component_id for r in simhash.near_duplicates(docs(spark, rows)).collect()}
    prints = {i: simhash.signed(simhash.fingerprint(t)) for i, t in rows if i}
    assert prints[4] == prints[5] == 0 and got[(4, 0)] == got[(5, 0)] == 4
    assert got[(1, prints[1])] == got[(2, prints[2])] == 1
    assert simhash.near_duplicates(docs(spark, rows).limit(0)).count() == 0


def test_sharding_of_repeated_rows(spark):
    """Half of all rows under one id, a quarter of them null ids, with equal and with different texts: shards stay near equal."""
    rows = [(7, f"text {i % 900}") for i in range(2000)] + [(8, "same text")] * 1000 + [(None, None)] * 500 + [(None, "x")] * 500
    placed = sharding.slotted(docs(spark, rows), 512)
    weights = sharding.slot_weights(placed)
    load = defaultdict(int)
    for slot, s in sharding.plan(weights, 10).items():
        load[s] += dict((k, b) for k, b, _ in weights)[slot]
    assert sum(n for _, _, n in weights) == len(rows) and max(load.values()) <= 1.05 * min(load.values()) and max(n for _, _, n in weights) < 40


def test_sharding(spark, tmp_path):
    rows = [(i, "x" * (i * 37 % 900)) for i in range(3000)] + [(5, "x"), (5, "x"), (None, "y"), (None, None)]
    rows_df = sharding.slotted(docs(spark, rows), 512)
    weights = sharding.slot_weights(rows_df)
    to = sharding.plan(weights, 10)
    path = str(tmp_path / "maps")
    sharding.store_map(spark, path, 1, to, weights)
    got = sharding.place(rows_df, sharding.load_map(spark, path)).collect()
    load, places = defaultdict(int), defaultdict(list)
    for r in got:
        load[r.shard] += r.size
        places[r.shard].append(r.slot)
    assert len(got) == len(rows) and all(sorted(p) == list(range(len(p))) for p in places.values())
    assert max(load.values()) / (sum(load.values()) / 10) < 1.05
    grown = sharding.rebalance(to, weights, 11)
    assert sum(grown[s] != to[s] for s in to) <= 0.2 * len(to) and set(grown.values()) == set(range(11))
    sharding.store_map(spark, path, 2, grown, weights)
    assert sharding.load_map(spark, path).first().version == 2 and sharding.load_map(spark, path, 1).count() == len(to)
    assert sharding.slot_weights(rows_df.limit(0)) == []
