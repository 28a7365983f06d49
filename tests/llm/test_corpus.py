"""Collocations, prefix trie and decontamination against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.llm.test_dedup import docs
from tributary.llm import collocations, decontamination, prefix_trie

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
NONE = hashlib.sha256().hexdigest()


# collocations


def brute_collocations(rows, longest=5, least=100, absorb=100, top=2000):
    """(lang, rank, phrase, a, l, r, n, score) of (lang, text)."""
    n, f = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            f.update((lang, *w[i : i + k]) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    many = {g: c for g, c in f.items() if len(g) > 2 and c >= least}
    most = Counter()
    for (lang, *w), c in many.items():
        for k in range(2, len(w)):
            for i in range(len(w) - k + 1):
                most[(lang, *w[i : i + k])] = max(most[(lang, *w[i : i + k])], c)
    out = defaultdict(list)
    for (lang, *w), a in many.items():
        if 100 * most[(lang, *w)] >= absorb * a:
            continue
        cuts = [(1000 * a * n[lang] // (f[(lang, *w[:k])] * f[(lang, *w[k:])]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        out[lang].append((-score, -a, " ".join(w).encode(), f[(lang, *w[:k])], f[(lang, *w[k:])]))
    return {(lang, i, p.decode(), -a, l, r, n[lang], -s) for lang, found in out.items() for i, (s, a, p, l, r) in enumerate(sorted(found)[:top], 1)}


def phrases(seed, count, vocabulary):
    rng = random.Random(seed)
    return [(rng.choice(["de", "en", None]), "".join(w + rng.choice([" ", " ", " ", "  ", "\t", ". ", ", ", "\n", "?", "\x0b"]) for w in rng.choices(vocabulary, k=rng.randint(0, 30)))) for _ in range(count)]


@pytest.mark.parametrize(("seed", "words", "least", "absorb", "top"), [(1, 6, 5, 100, 2000), (2, 40, 3, 100, 30), (3, 12, 2, 60, 2000)])
def test_collocations(spark, monkeypatch, seed, words, least, absorb, top):
    """Small limits, so that filters are merged and written several times and keys take more than one word."""
    monkeypatch.setattr(collocations, "CHUNK", 2000)
    monkeypatch.setattr(collocations, "ENTRIES", 50)
    rows = phrases(seed, 300, [f"w{i}" for i in range(words)] + ["ÄÖ", "É", "Ab", "ab", "don't", "x" * 300]) + [("en", None), (None, ""), ("fr", " . "), ("fr", "a b " * 3000)]
    got = collocations.collocations(docs(spark, [(i, t) for i, (_, t) in enumerate(rows)]).join(spark.createDataFrame([(i, lang) for i, (lang, _) in enumerate(rows)], "doc_id long, lang string"), "doc_id").repartition(7), min_count=least, absorb=absorb, top=top).collect()
    want = brute_collocations(rows, 5, least, absorb, top)
    assert len(got) == len(want) and {(r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in got} == want and len({w[0] for w in want}) > 2


@pytest.mark.parametrize(("n", "bits"), [(2, 3), (2, 32), (3, 21), (3, 25), (5, 13), (5, 17), (5, 31)])
def test_filters_lose_nothing(n, bits):
    rng = np.random.default_rng(n * bits)
    ids = [rng.integers(1, 1 << bits, 4000, dtype=np.uint64) for _ in range(n)]
    ids = [np.concatenate([x, x[:300], np.repeat(x[:1], 1000)]) for x in ids]
    packed = collocations.packed(ids, bits)
    keys = collocations.permuted(packed)
    assert all((a == b).all() for a, b in zip(collocations.restored_words(keys), packed, strict=True))
    assert all((a == b).all() for a, b in zip(collocations.unpacked(packed, n, bits), ids, strict=True))
    half = [collocations.counted([k[i::2] for k in keys]) for i in (0, 1)]
    blocks = defaultdict(list)
    for f in half:
        for b in collocations.to_blocks(*f, 7):
            blocks[b[0]].append(collocations.from_block(*b, 7))
    got = Counter()
    for parts in blocks.values():
        whole, counts = collocations.merged(parts)
        back = collocations.unpacked(collocations.restored_words(whole), n, bits)
        got.update(dict(zip(zip(*(x.tolist() for x in back), strict=True), counts.tolist(), strict=True)))
    assert got == Counter(zip(*(x.tolist() for x in ids), strict=True))


# prefix trie


def brute_trie(rows):
    """Rows of the trie of (conv_id, turn, role, text)."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append((turn is not None, turn or 0, hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest(), (role, text)))
    own = {c: [x[3] for x in sorted(t)] for c, t in own.items()}
    paths = {}
    for c, t in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        paths[c] = tuple(own.get(c - c % 5, [])[:h] + t[h:])
    nodes = defaultdict(list)
    for c in sorted(paths):
        for d in range(len(paths[c]) + 1):
            nodes[paths[c][:d]].append(c)
    children = Counter(p[:-1] for p in nodes if p)
    leaves, saved = Counter(), Counter()
    for p, members in nodes.items():
        own_saved = (len(members) - 1) * (len(p[-1][1].encode()) if p else 0)
        for d in range(len(p) + 1):
            leaves[p[:d]] += children[p] == 0
            saved[p[:d]] += own_saved
    ends = {p: hashlib.sha256(",".join(str(c) for c in m if len(paths[c]) == len(p)).encode()).hexdigest() for p, m in nodes.items()}
    return Counter((m[0], len(p), nodes[p[:-1]][0] if p else None, len(m), children[p], leaves[p], saved[p], ends[p]) for p, m in nodes.items())


def talks(count=400, seed=5):
    rng = random.Random(seed)
    rows = [(c, turn, rng.choice(["user", "assistant", "", None]), rng.choice(["hi", "é", "ok " * 40, "", None, "hi"])) for c in rng.sample(range(2 * count), count) for turn in range(rng.choice([1, 1, 2, 3, 5, 9, 12]))]
    rows += [(c, turn, "user", "same") for c in range(5000, 5300) for turn in range(12)]  # copies, long enough to keep turns of their own
    rows += [(7001, None, "user", "null first"), (7001, 0, "user", "then this"), (None, 0, "user", "x"), (7003, 1, "a", "b"), (7003, 1, "a", "b")]
    rows += [(8000, t, "user", f"long {t}") for t in range(3000)]
    rng.shuffle(rows)
    return rows


NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def test_trie(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "SHARD", 16)
    rows = [r for r in talks() if r[0] != 8000]  # brute force is quadratic in turns
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").selectExpr("*", "1 AS digest", "2 AS p", "3 AS prefix", "4 AS shard")
    got = prefix_trie.trie(prefix_trie.rebuilt(prefix_trie.digested(df))).collect()
    want = brute_trie(rows)
    assert Counter(tuple(r[c] for c in NODE) for r in got) == want and any(k[1] == 0 and k[3] > 300 for k in want) and any(k[7] != NONE and k[1] == 0 for k in want)


def test_a_long_conversation(spark):
    rows = [(1, t, "user", f"turn {t}") for t in range(20_000)] + [(2, t, "user", f"turn {t}") for t in range(10_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    got = {(r.depth, r.n_convs, r.n_children): r for r in prefix_trie.trie(prefix_trie.digested(df)).filter("depth IN (0, 10000, 20000)").collect()}
    assert got[0, 2, 1].n_leaves == 1 and got[10_000, 2, 1].ends_sha256 == hashlib.sha256(b"2").hexdigest() and got[20_000, 1, 0].n_leaves == 1
    assert got[0, 2, 1].saved_tokens == sum(len(f"turn {t}") for t in range(10_000))


# decontamination


def words_of(text):
    return re.findall("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+", (text or "").translate(LOWER))


def brute_hits(texts, items, window=10):
    """Per text: (n_words, n_hit, sorted item ids)."""
    wins = defaultdict(set)
    for i, t in items:
        w = words_of(t)
        for at in range(max(len(w) - window, 0) + 1) if w else ():
            wins[tuple(w[at : at + window])].add("" if i is None else str(i))
    lengths = {len(w) for w in wins}
    out = []
    for t in texts:
        w, hit, found = words_of(t), set(), set()
        for k in lengths:
            for at in range(len(w) - k + 1):
                if (key := tuple(w[at : at + k])) in wins:
                    hit.update(range(at, at + k))
                    found |= wins[key]
        out.append((len(w), len(hit), sorted(found)))
    return out


def passages(seed=9):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(40)] + ["É", "ÀB", "Σ", "x1", "é😀", "İ"]
    some = lambda k: " ".join(rng.choices(vocabulary, k=k))
    items = [(i, some(rng.choice([10, 11, 14, 25]))) for i in range(40)] + [(50, "alone"), (51, "two words"), (52, "a b c d e f g h i"), (53, ""), (54, None), (55, " .,-"), (None, some(12)), (3, some(12)), (60, "w1 " * 30)]
    items.append((61, items[0][1]))  # one text under two ids
    texts = [None, "", "...", "alone", "say Two\tWORDS!", some(5000), "a b c d e f g h", "x a-b_c,d e f g h I j", "w1 w1 w1 " * 5]
    for i in range(200):
        t = some(rng.randint(0, 40))
        for _ in range(rng.choice([0, 0, 1, 2])):
            w = words_of(rng.choice(items[:40])[1])
            at = rng.randrange(len(w))
            t += rng.choice([" ", ", ", "\n"]) + " ".join(x.upper() if x.isascii() else x for x in w[at : at + rng.choice([5, 9, 10, 12, 30])]) + " " + some(3)
        texts.append(t)
    return texts + texts[20:30] * 5, items


@pytest.mark.parametrize("small", [True, False])
def test_decontamination(spark, monkeypatch, small):
    if not small:
        monkeypatch.setattr(decontamination, "BROADCAST", 0)
        monkeypatch.setattr(decontamination, "BROADCAST_TEXTS", 0)
    texts, items = passages()
    table = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS win", "2 AS h")
    got = decontamination.decontaminated(docs(spark, list(enumerate(texts))), table).collect()
    want = Counter((i, n, hit, tuple(ids)) for i, (n, hit, ids) in enumerate(brute_hits(texts, items)))
    assert Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in got) == want and sum(w[2] > 0 for w in want) > 20


def test_windows_that_differ_in_a_word(spark):
    """At a share of 0.6 a window of ten words, eight shingles, may have one word other than at its middle places."""
    item = [f"w{i}" for i in range(10)]
    texts = {0: item, 1: ["x", *item[1:]], 2: [*item[:2], "x", *item[3:]], 3: [*item[:4], "x", "y", "z", *item[7:]]}
    table = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    rows = docs(spark, [(i, "some text " + " ".join(w) + " and more") for i, w in texts.items()])
    assert {r.doc_id: r.n_hit for r in decontamination.decontaminated(rows, table, share=0.6).collect()} == {0: 10, 1: 10, 2: 10, 3: 0}


def test_no_items(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    got = decontamination.decontaminated(docs(spark, [(1, "a b"), (2, None)]), none).collect()
    assert {(r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in got} == {(1, 2, 0, ()), (2, 0, 0, ())}
