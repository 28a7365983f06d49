import hashlib
import random
import re
import time
from collections import Counter

import numpy as np
import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

from tests.llm.test_dedup import docs
from tributary.llm import byte_bpe, language_id, license_scan, packing, pii, quality

WEIRD = "ab \t\n\x0b\x0c\r\x1c\x85\xa0 　'sé漢字😀0১!<|endoftext|>​﻿́ΣİA."


def random_texts(n, size, seed=0, alphabet=WEIRD):
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, size))) for _ in range(n)]


def test_byte_bpe_equals_the_library():
    ranks = byte_bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    own = byte_bpe.BytePairEncoder(ranks, public_tokenizers.PATTERN)
    texts = random_texts(600, 200) + ["", "a" * 3000, "ab" * 700, "é" * 100, "x" * 65, "the quick brown fox\njumps over", " lead", "trail ", "a  b"]
    for t, ids in zip(texts, own.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(t)
        assert own.decode(ids).decode() == t


def joined(texts):
    data = [t.encode() for t in texts]
    return np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)])[:-1]


def test_word_tokenizer_equals_the_library(monkeypatch):
    own = packing.WordTokenizer(public_tokenizers.path("word_bpe_49k.json"))
    texts = random_texts(600, 150, 1) + random_texts(400, 100, 3, "abÀé !?., \n_-7") + random_texts(600, 60, 5, WEIRD + "àÀ×÷ßĀāįĮİŁ²½'sT12") + ["", "don't 'tis \"it's\" (x), dogs' ...", "ñandú, À… ª º µ", "q" * 200, ""]
    for some in (texts, texts[::-1], [""], [" "]):  # the second time from the cache
        ids, counts = own.encode(*joined(some))
        for t, got in zip(some, np.split(ids, np.cumsum(counts)[:-1]), strict=True):
            assert got.tolist() == own.tokenizer.encode(t, add_special_tokens=False).ids
    monkeypatch.setattr(packing, "CHUNK", 100)  # a long text is worked off in pieces
    for t in [" ".join(random_texts(50, 30, 7)), "q" * 300 + " end", " " * 250]:
        ids, counts = packing.encoded(own, *joined([t]))
        assert ids.tolist() == own.tokenizer.encode(t, add_special_tokens=False).ids and counts.tolist() == [len(ids)]


def test_hilbert_visits_neighbours():
    grid = np.array([[a, b, c] for a in range(4) for b in range(4) for c in range(4)])
    key = packing.hilbert(grid, 2)
    path = grid[np.argsort(key)]
    assert sorted(key.tolist()) == list(range(64)) and (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_packing(spark):
    texts = ["", None, "one two three", "word " * 5000, "one two three"] + [f"some words {i} and more" for i in range(300)]
    rows = list(enumerate(texts)) + [(3, "repeated id"), (None, "no id")]
    path = public_tokenizers.path("word_bpe_49k.json")
    pieces = packing.pack(docs(spark, rows), path, length=64).collect()
    tok = packing.WordTokenizer(path).tokenizer
    want = Counter(tuple(tok.encode(t or "", add_special_tokens=False).ids + [1]) for _, t in rows)
    by, at = {}, {}
    for p in pieces:
        by.setdefault(p.sequence_id, []).append((p.offset, p.length))
        at[p.sequence_id * 64 + p.offset] = p
    for s, parts in by.items():
        end = 0
        for offset, n in sorted(parts):
            assert offset == end
            end += n
        assert end == 64 or s == max(by)
    got, run = Counter(), []
    for k in sorted(at):
        p = at[k]
        assert p.start == sum(len(r) for r in run)
        run.append(np.frombuffer(p.ids, "<u4").tolist())
        if sum(map(len, run)) == p.doc_tokens:
            got[tuple(x for r in run for x in r)] += 1
            run = []
    assert got == want and not run
    assert packing.pack(docs(spark, rows).limit(0), path).count() == 0


def brute_counts(t):
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    n = len(words)
    seen = Counter(tuple(words[i : i + 8]) for i in range(n - 7))
    again = {k for i in range(n - 7) if seen[tuple(words[i : i + 8])] > 1 for k in range(i, i + 8)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(again)


def test_quality_counts():
    texts = random_texts(200, 300, 2) + ["", "a b c d e f g h " * 9, "x\nx\n\n x\nx", "one two three four five six seven eight nine"]
    for t in texts:
        assert quality.measure(t)[:5] == brute_counts(t)
    assert quality.measure(None)[:5] == (0, 0, 0, 0, 0)


def normal(line):
    return re.sub("[0-9]", "0", re.sub("[A-Z]", lambda m: m[0].lower(), " ".join(re.findall(r"[^\x20\x09-\x0D]+", line))))


def brute_quality(rows, max_docs, min_left):
    """{(doc_id, text, host): (words_left, kept, text without frequent lines)} by plain counting over distinct texts."""
    held = Counter()
    for t, h in {(t or "", h or "") for _, t, h in rows}:
        held.update((h, line) for line in {normal(x) for x in t.split("\n")} - {""})
    out = {}
    for i, t, h in rows:
        lines = [x for x in (t or "").split("\n") if held[h or "", normal(x)] <= max_docs or not normal(x)]
        n, *_, again = brute_counts(t or "")
        left = sum(len(normal(x).split()) for x in lines)
        out[i, t, h] = (left, n >= 20 and 100 * again <= 30 * n and left >= min_left * n, "\n".join(lines))
    return out


def words(i, n):
    return " ".join(hashlib.md5(f"{i}-{k}".encode()).hexdigest()[:8] for k in range(n))


def check_quality(spark, rows, max_docs=quality.MAX_DOCS, min_left=quality.MIN_LEFT):
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns({c: F.lit("e") for c in ("host", "removed_lines", "v_host", "c0", "a.b", "text_key")})
    want = brute_quality(rows, max_docs, min_left)
    got = quality.judge(df, "source", max_docs, min_left).collect()
    assert Counter((r.doc_id, r.host, r.words_left, r.kept) for r in got) == Counter((i, h or "", *want[i, t, h][:2]) for i, t, h in rows)
    out = quality.cleaned(df, "source", max_docs, min_left)
    assert out.columns == df.columns
    kept = out.collect()
    assert Counter((r.doc_id, r.text, r.source) for r in kept) == Counter((i, want[i, t, h][2], h) for i, t, h in rows if want[i, t, h][1])
    assert all(r.host == r.v_host == r["a.b"] == r.c0 == "e" for r in kept)
    return {r.doc_id: r for r in got}


def test_line_frequency_equals_plain_counting(spark):
    rng = random.Random(6)
    lines = [words(f"line{k}", rng.randint(1, 12)) for k in range(12)] + ["", " ", "A  b\tC", "a b c", "page 12", "Page 77 "]
    rows = [(rng.randint(0, 300), "\n".join([words(rng.randint(0, 60), rng.randint(0, 30)), *rng.choices(lines, k=rng.randint(0, 6))]), rng.choice(["h1", "h2", "", None])) for _ in range(500)]
    rows += rows[:40] + [(900, None, "h1"), (901, "", None), (None, rows[3][1], "h1"), (902, "\n".join(words(k, 3) for k in range(20_000)), "h1")]
    for max_docs, min_left in ((5, 0.2), (20, 0.5), (0, 0.1)):
        check_quality(spark, rows, max_docs, min_left)
    empty = spark.createDataFrame([], "doc_id long, text string, source string")
    assert quality.judge(empty).count() == 0 and quality.cleaned(empty).count() == 0


def test_pages_of_shared_lines_are_depleted(spark):
    """Pages of two shared lines with 4 to 30 words of their own, a line shared by one large group of copies and by many pages, and a line at the limit."""
    rows = [(1000 * n + i, "\n".join([words(f"menu{n}", shared), words(f"{n}-{i}", n), words(f"foot{n}", shared)]), f"t{n}") for n, shared in ((4, 30), (6, 60), (10, 40), (30, 30)) for i in range(200)]
    shared = words("shared", 15)
    rows += [(50_000 + i, f"{shared}\n{words(i, 30)}", "big") for i in range(60)] + [(60_000 + i, f"{shared}\n{words('copied', 30)}", "big") for i in range(900)]
    rows += [(70_000 + i, f"{shared}\n{words(i, 30)}", "few") for i in range(quality.MAX_DOCS)]
    got = check_quality(spark, rows)
    for n in (4, 6, 10, 30):
        assert all(got[1000 * n + i].words_left == n and got[1000 * n + i].kept == (n == 30) for i in range(200))
    assert all(got[i].words_left == 30 for i in (*range(50_000, 50_060), *range(60_000, 60_900))) and all(got[70_000 + i].words_left == 45 for i in range(quality.MAX_DOCS))


BASE = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def valid(kind, m):
    d = re.sub(r"\D", "", m)
    if kind == "ip":
        return all(int(x) <= 255 for x in m.split("."))
    if kind == "phone":
        return 8 <= len(d) <= 15
    if kind == "card":
        total = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d)))
        return 16 <= len(d) <= 19 and total % 10 == 0
    return True


def test_base_spans(spark):
    rng = random.Random(5)
    parts = ["1", "2", "55", "4111111111111111", "a", "b.c", "@", "@x.y", ".", "-", " ", "+1", "+", "é", "😀", "\n", "(", ")", "1.2.3.4", "300.1.1.1", "_", "%", "00001.2.3.4", "+1 (555) 010-9999"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 50))) for _ in range(600)] + ["", None, "a@b.c_d@e.f@g.h", "9" * 3000, "a." * 3000 + "@", "x@" + "a." * 3000 + "b"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: [(s.kind, s.start, s.end) for s in r.found if s.kind in pii.PATTERNS] for r in pii.spans(df).collect()}
    for i, t in enumerate(texts):
        assert got[i] == [(k, m.start(), m.end()) for k, p in BASE for m in re.finditer(p, t or "") if valid(k, m[0])]


def test_disclosing_terms(spark):
    rows = [(i, f"reach contactaddr at user{i}@host{i}.org today") for i in range(30)] + [(100 + i, f"today we reach word{chr(97 + i % 26)}x at noon") for i in range(200)] + [(500, None), (501, "")]
    df = docs(spark, rows)
    found = {r.doc_id: r for r in pii.spans(df).collect()}
    assert [(s.start, s.end) for s in found[3].terms] == [(6, 17)] and not found[100].terms
    out = {r.doc_id: r for r in pii.sanitised(df).collect()}
    assert out[3].text == "reach <term> at <email> today" and out[100].text == rows[30][1] and out[500].text is None and out[3].found == "e" and out[3].content == "e"
    copies = [(i, "rareword at one@host.org") for i in range(50)] + rows[30:]
    assert not any(r.terms for r in pii.spans(docs(spark, copies)).collect())
    assert pii.spans(df.limit(0)).count() == 0


def test_language(spark):
    rng = random.Random(1)
    words = {"xx": ["kala", "maka", "nupi", "tola"], "yy": ["grün", "straße", "schön", "über"], "zz": ["año", "niño", "señor", "mañana"]}
    rows = [(i, " ".join(rng.choices(words[l], k=20)), l) for i, l in enumerate(rng.choices(list(words), k=400))] + [(900, None, "xx"), (901, "1234 !!", "yy"), (902, "maka nupi", None)]
    df = language_id.held_out(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    model = language_id.train(df.filter("not held_out"))
    got = {r.doc_id: r for r in language_id.predicted(df.withColumn("score", F.lit(1)), model).collect()}
    assert all(got[i].lang_pred == l and 0 <= got[i].score <= 1 for i, _, l in rows[:400])
    assert got[900].lang_pred == got[901].lang_pred == "und" and got[902].lang_pred == "xx"
    assert (model.weights == 0).mean() > 0.5
    empty = language_id.train(df.limit(0))
    assert {r.lang_pred for r in language_id.predicted(df, empty).collect()} == {"und"}


def test_license_scan(spark):
    scanner = license_scan.Scanner(license_scan.TEMPLATES)
    rng = random.Random(4)
    filler = "lorem ipsum dolor sit amet under the license of and this work all rights".split()
    for _ in range(150):
        name = rng.choice(list(license_scan.TEMPLATES))
        words = license_scan.words_of(license_scan.TEMPLATES[name])[0]
        text = " ".join(rng.choices(filler, k=rng.randint(0, 300)) + words + rng.choices(filler, k=rng.randint(0, 300)))
        assert name in {m[0] for m in scanner.scan(text)}
    text = "Hello.\nReleased under the MIT License.\nBye"
    rows = [(1, text), (2, None), (3, ""), (4, "Licensed under"), (1, text)]
    got = license_scan.scan(docs(spark, rows)).collect()
    assert [(r.doc_id, text[r.start : r.end]) for r in got] == [(1, "Released under the MIT License")] * 2
    assert license_scan.scan(docs(spark, rows).limit(0)).count() == 0


def test_odd_and_many_templates(spark):
    """Null, empty and wordless templates, two texts under one name, none at all, and more than the bitmap tells apart."""
    rows = [(1, "zz red green blue black white zz"), (2, "zz one two three four five six zz"), (3, None)]
    table = lambda *r: spark.createDataFrame(list(r), "name string, text string")
    assert license_scan.scan(docs(spark, rows), table()).count() == 0 and license_scan.scan(docs(spark, rows), table(("a", None), ("b", ""), ("c", " .- "))).count() == 0
    got = license_scan.scan(docs(spark, rows), table(("L", "red green blue black white"), ("L", "one two three four five six"), ("M", None), (None, "green blue"))).collect()
    assert {(r.doc_id, r.license, r.start, r.end) for r in got} == {(1, "L", 3, 29), (2, "L", 3, 30), (1, "", 7, 17)}
    rng = random.Random(2)
    many = [(f"t{i}", " ".join(f"v{rng.randrange(400)}" for _ in range(12))) for i in range(3000)]
    scanner = license_scan.Scanner(many)
    text = " ".join(f"v{rng.randrange(400)}" for _ in range(3000)) + " " + many[77][1] + " tail " + many[2500][1]
    began = time.perf_counter()
    assert {m[0] for m in scanner.scan(text)} == {"t77", "t2500"} and time.perf_counter() - began < 5


def test_url_filter(spark):
    from tributary.llm import url_filter

    lab = spark.createDataFrame([(f"http://www.bad-site.example.com/fr/{i}", True) for i in range(30)] + [(f"http://www.good.example.com/fr/{i}", i % 5 == 0) for i in range(60)] + [("http://h.org/" + "/".join(f"s{chr(97 + k)}" for k in range(26)), False)] * 40, "url string, bad boolean")
    rows = [(1, "http://x.bad-site.example.com/fr/99"), (2, None), (3, "HTTP://A.COM/en/1?x#y"), (4, "nothing"), (5, "http://example.com/en/77"), (6, "http://notcom/en/1"), (7, "http://a.net/de/8"), (8, "http://example.net/de/81")]
    pages = spark.createDataFrame(rows + rows[:1], "page_id long, url string").withColumn("host", F.lit("e"))
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(pages, lab).collect()}
    assert got == {1: ("x.bad-site.example.com", "/fr/99", None, "block"), 2: ("", "", None, "allow"), 3: ("a.com", "/en/1", "com/en/", "block"), 4: ("", "", None, "allow"), 5: ("example.com", "/en/77", "example.com/en/7", "allow"),
                   6: ("notcom", "/en/1", None, "allow"), 7: ("a.net", "/de/8", "net/de/", "allow"), 8: ("example.net", "/de/81", "example.net/de/8", "block")}
    assert url_filter.judge(pages, lab.limit(0)).count() == 9 and url_filter.judge(pages.limit(0), lab).count() == 0


def test_mined_rules_equal_counting_all_subsets(spark):
    """All sets of tokens, by plain counting; tokens of just the same rows count as one."""
    from itertools import combinations

    from tributary.llm import url_filter

    rng = random.Random(9)
    urls = [(f"http://{rng.choice(['a', 'b'])}.{rng.choice(['shop', 'news'])}.fr/{rng.choice(['x', 'y', 'x/twin'])}/{i}?{rng.choice(['buy', 'see'])}=1", False) for i in range(300)]
    bad = lambda u: ("shop" in u and "buy" in u and rng.random() < 0.95) or rng.random() < 0.1
    urls = [(u, bad(u)) for u, _ in urls]
    df = spark.createDataFrame(urls, "url string, bad boolean")
    rows = [(frozenset(r.t), r.bad) for r in df.select(url_filter.tokens(F.col("url")).alias("t"), "bad").collect()]
    share = sum(b for _, b in rows) / len(rows)
    for confidence, min_rows in ((0.7, 20), (0.5, 40)):
        where = {}
        for i, (t, _) in enumerate(rows):
            for x in t:
                where.setdefault(x, set()).add(i)
        classes = {}
        for x in sorted(where):
            if len(where[x]) >= min_rows:
                classes.setdefault(frozenset(where[x]), x)
        items = {x: set(w) for w, x in classes.items()}
        want = {}
        for k in range(1, len(items) + 1):
            for some in combinations(sorted(items), k):
                both = set.intersection(*(items[x] for x in some))
                hits = sum(rows[i][1] for i in both)
                if hits >= min_rows and hits / len(both) >= confidence and hits / len(both) / share >= 1.5 and not any(rule < set(some) for rule in want):
                    want[frozenset(some)] = (round(hits / len(both), 9), hits)  # shorter sets come first, so only minimal ones stay
        rules, index = url_filter.mine(df, confidence, 0.0, min_rows)
        assert {frozenset(r.needs): (round(r.confidence, 9), r.rows) for r in rules.collect()} == want and want
        held = {r.token: r.item for r in index.collect()}
        fits = {u for (u, _), (t, _) in zip(urls, rows, strict=True) if any(rule <= {held[x] for x in t if x in held} for rule in want)}
        assert {r.url for r in url_filter.matched(df.select("url"), rules, index).collect()} == fits and fits


def test_tokens_that_nearly_always_come_together(spark):
    """Forty path tokens, each missing from one of the bad URLs, and sets of two tokens that only together are bad."""
    from tributary.llm import url_filter

    parts = [f"part{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(40)]
    rows = [("http://long.fr/" + "/".join(p for p in parts if p != gone), True) for gone in [*parts, None, None]]
    rows += [(f"http://plain.fr/{a}/{b}", a == "left" and b == "right") for a in ("left", "other") for b in ("right", "else") for _ in range(30)] + [("http://clean.fr/x", False)] * 100
    df = spark.createDataFrame(rows, "url string, bad boolean")
    began = time.perf_counter()
    rules, index = url_filter.mine(df, 0.8, 0.0, 8)
    found = {frozenset(r.needs) for r in rules.collect()}
    assert time.perf_counter() - began < 60 and {"path:left", "path:right"} in found and {f"path:{parts[3]}"} in found
    assert {r.url for r in url_filter.matched(df.select("url"), rules, index).collect()} == {u for u, bad in rows if bad}


def test_listed_rules_equal_plain_matching(spark):
    from tributary.llm import url_filter

    rng = random.Random(10)
    parts = ["http://", "HTTPS://", "ftp:", "://", "example", "EXAMPLE", ".", "com", "net", "org", "/", "en", "de", "es", "7", "8", "?", "#", "a", "@", ":80"]
    urls = ["".join(rng.choices(parts, k=rng.randint(0, 9))) for _ in range(1500)] + [f"{rng.choice(['http', 'HTTPS'])}://{rng.choice(['', 'x.', 'x', 'A.'])}{rng.choice(['example.', 'EXAMPLE.', ''])}{rng.choice(['com', 'net', 'org', 'NET'])}{rng.choice(['/en/', '/de/', '/es/', '/en', '?/en/'])}{rng.choice(['7', '8', '71', ''])}" for _ in range(1500)] + [None, ""]
    rules = [("block", "com", "/en/"), ("allow", "example.com", "/en/7"), ("allow", "net", "/de/"), ("block", "example.net", "/de/8"), ("block", "org", "/es/")]

    def want(u):
        if u is None or "://" not in u:
            return "", "", None, "allow"
        rest = u.split("://", 1)[1]
        host = re.split("[/?#]", rest)[0]
        path = re.split("[?#]", rest[len(host):])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
        fits = [(len(h + p), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return (host, path, *(max(fits)[1:] if fits else (None, "allow")))

    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(df, spark.createDataFrame([], "url string, bad boolean")).collect()}
    assert got == {i: want(u) for i, u in enumerate(urls)}


def public_texts():
    """Longer templates of several paragraphs: invented wording, 60 to 900 words."""
    rng = random.Random(12)
    stem = "permission is hereby granted to use copy modify merge publish distribute sublicense the software provided that the above notice and this list of conditions appear in all copies without warranty of any kind express or implied".split()
    return {f"T{n}": "\n\n".join(" ".join(rng.choice(stem) + rng.choice(["", "", f"{k % 17}"]) for k in range(n // 3)) for _ in range(3)) for n in (60, 150, 400, 900)}


def test_license_recall_and_false_hits(spark):
    """Passages with 1.0, 0.9 and 0.8 of a template's shingles against a plain scan of every stretch as long as the template."""
    rng = random.Random(13)
    templates = public_texts() | license_scan.TEMPLATES
    rows, truth = [], {}
    shingles = {k: (license_scan.Template.of(k, t).size, license_scan.Template.of(k, t).shingles) for k, t in templates.items()}
    filler = sorted({w for t in templates.values() for w in license_scan.words_of(t)[0]}) + [f"w{i}" for i in range(300)]
    for i in range(240):
        name = rng.choice(list(templates))
        ws = license_scan.words_of(templates[name])[0]
        size, wanted = shingles[name]
        share = rng.choice([1.0, 0.9, 0.8, 0.6])
        cut = list(ws)
        while len({tuple(cut[k : k + size]) for k in range(len(cut) - size + 1)} & wanted) > share * len(wanted):
            cut[rng.randrange(len(cut))] = f"z{rng.randint(0, 9)}"
        rows.append((i, " ".join(rng.choices(filler, k=rng.randint(0, 700)) + cut + rng.choices(filler, k=rng.randint(0, 700)))))
    table = spark.createDataFrame(list(templates.items()), "name string, text string")
    got = {}
    for r in license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string"), table).collect():
        got.setdefault((r.doc_id, r.license), []).append((r.start, r.end, r.containment))
    found = must = 0
    for i, text in rows:
        ws = license_scan.words_of(text)[0]
        for name, (size, wanted) in shingles.items():
            here = [tuple(ws[k : k + size]) for k in range(len(ws) - size + 1)]
            length = len(license_scan.words_of(templates[name])[0]) - size + 1
            hits = [k for k, x in enumerate(here) if x in wanted]
            whole = bool(hits) and any(len({here[k] for k in hits if a <= k < a + length}) >= 0.8 * len(wanted) for a in hits)
            must += whole
            found += whole and (i, name) in got
            for start, end, containment in got.get((i, name), []):  # no false hit: the span holds what is said
                inside = license_scan.words_of(text[start:end])[0]
                seen = {tuple(inside[k : k + size]) for k in range(len(inside) - size + 1)} & wanted
                assert len(seen) >= 0.8 * len(wanted) and containment >= 0.8
    print("passages", must, "found", found)
    assert must > 100 and found >= 0.995 * must
    assert not any(k[0] == -1 for k in got)


def test_language_counts_and_steps():
    """n-grams of a text by plain slices, and the learning steps coordinate by coordinate."""
    import math

    def plain(text, buckets):
        chars = [c if c.isalpha() else " " for c in text.lower()]
        joined = " " + re.sub(" +", " ", "".join(chars)).strip(" ") + " " if any(c != " " for c in chars) else ""
        seen = Counter()
        for k in range(language_id.N):
            for i in range(len(joined) - k):
                h = 0
                for c in joined[i : i + k + 1]:
                    h = (h * 0x110001 + ord(c)) % 2**64
                seen[((h + k) * int(language_id.PRIME) % 2**64) >> (64 - buckets.bit_length() + 1)] += 1
        return seen

    for t in ["", "x", "Ab, ab?", "Straße naïve 漢字 1a", " lead and trail "] + random_texts(60, 80, 3, "aBé, 1ß漢"):
        at, n = language_id.counts(t, 1 << 10)
        assert dict(zip(at.tolist(), n.tolist(), strict=True)) == dict(plain(t, 1 << 10)), t
    rng = np.random.default_rng(3)
    sample = [(["a", "b", "c"][i % 3], np.sort(rng.choice(16, 4, replace=False)), rng.integers(1, 5, 4)) for i in range(11)]
    idf = rng.random(16) + 0.5
    model = language_id.fit(sample, idf, epochs=2)
    z, g2 = [[[0.0] * 3 for _ in range(17)] for _ in range(2)]

    def weight(i, k):
        if abs(z[i][k]) <= language_id.L1:
            return 0.0
        return -(z[i][k] - math.copysign(language_id.L1, z[i][k])) / ((language_id.BETA + math.sqrt(g2[i][k])) / language_id.ALPHA + language_id.L2)

    rows = []
    for lang, at, n in sample:
        x = [(1 + math.log(c)) * idf[a] for a, c in zip(at, n, strict=True)]
        norm = math.sqrt(sum(v * v for v in x))
        rows.append(("abc".index(lang), [*at.tolist(), 16], [v / norm for v in x] + [1.0]))
    learn = [r for i, r in enumerate(rows) if i % 5]
    order = np.random.default_rng(0)
    for _ in range(2):
        for j in order.permutation(len(learn)).tolist():
            y, at, x = learn[j]
            w = {(i, k): weight(i, k) for i in at for k in range(3)}
            score = [math.exp(sum(v * w[i, k] for i, v in zip(at, x, strict=True))) for k in range(3)]
            for i, v in zip(at, x, strict=True):
                for k in range(3):
                    g = v * (score[k] / sum(score) - (k == y))
                    z[i][k] += g - (math.sqrt(g2[i][k] + g * g) - math.sqrt(g2[i][k])) / language_id.ALPHA * w[i, k]
                    g2[i][k] += g * g
    assert np.allclose(model.weights, [[weight(i, k) for k in range(3)] for i in range(17)])


def test_language_held_out_accuracy(spark):
    """Of the given documents that weren't learned from and have a language, nearly all get it."""
    import os

    if not os.path.isdir("/root/testdata/sf0.01"):
        return
    got = language_id.op1_language_id(spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang", "text"), "doc_id")
    rows = got.filter("held_out AND lang IS NOT NULL AND lang_pred != 'und'").collect()
    right = sum(r.lang == r.lang_pred for r in rows) / len(rows)
    print("held-out accuracy", right, "of", len(rows))
    assert right >= 0.95


def brute_spans(rows):
    """The text of all spans of each row: entities by pattern, disclosing terms by plain counting over all lines."""
    import math

    entities, terms, lines = {}, {}, []
    for number, (_, text) in enumerate(rows):
        at = 0
        for line in (text or "").split("\n"):
            found = [(k, m.start(), m.end(), m[0]) for k, p in BASE for m in re.finditer(p, line) if valid(k, m[0])]
            for m in re.finditer(pii.SECRETS["secret"], line):
                if not any(a < m.end() and m.start() < b for k, a, b, _ in found if k != "secret"):
                    found.append(("secret", m.start(), m.end(), m[0]))
            words = [(m[0].lower(), m.start(), m.end()) for m in re.finditer(r"[^\W\d_]{3,}", line)]
            entities.setdefault(number, []).extend((k, at + a, at + b) for k, a, b, _ in found)
            free = [(w, a, b) for w, a, b in words if found and not any(x < b and a < y for _, x, y, _ in found)]
            lines.append((number, at, line, found, {w for w, *_ in words}, free))
            at += len(line) + 1
    total = sum(bool(x[2]) for x in lines)
    held, both, seen, n = Counter(), Counter(), {}, Counter()
    for _, _, line, found, words, free in lines:
        n.update(words)
        for kind in {k for k, *_ in found}:
            held[kind] += 1
            for w in {w for w, *_ in free}:
                both[w, kind] += 1
                seen.setdefault((w, kind), set()).add(min(m for k, _, _, m in found if k == kind))
    told = {(w, k) for (w, k), c in both.items() if len(seen[w, k]) >= pii.SUPPORT and held[k] < total and math.log(c / n[w]) - math.log(held[k] / total) >= pii.DISCLOSURE * -math.log(held[k] / total)}
    for number, at, _, found, _, free in lines:
        terms.setdefault(number, []).extend((at + a, at + b) for w, a, b in free if any((w, k) in told for k, *_ in found))
    order = {k: i for i, k in enumerate(pii.KINDS)}
    text = [",".join([f"{k}:{a}:{b}" for k, a, b in sorted(entities[i], key=lambda s: (order[s[0]], s[1:]))] + [f"term:{a}:{b}" for a, b in sorted(set(terms[i]))]) for i in range(len(rows))]
    return text, told


def test_terms_equal_plain_counting(spark):
    rng = random.Random(14)
    plain = [f"wort{chr(97 + k)}" for k in range(20)]
    entity = {"email": lambda: f"u{rng.randint(0, 40)}@host.org", "ip": lambda: f"10.0.0.{rng.randint(0, 60)}", "phone": lambda: f"+1 555 010-{rng.randint(1000, 1040)}", "secret": lambda: f"password: abcdefghijkl{rng.randint(0, 30)}", "card": lambda: "4111 1111 1111 1111"}
    hint = {"email": "Mailbox", "ip": "server", "phone": "callme", "secret": "login", "card": "visa"}
    rows = []
    for i in range(260):
        lines = []
        for _ in range(rng.randint(0, 5)):
            words = rng.choices(plain, k=rng.randint(0, 7))
            for kind in rng.choices(list(entity), k=rng.choice([0, 0, 1, 1, 2, 6])):
                words.insert(rng.randint(0, len(words)), f"{hint[kind]} {entity[kind]()}" if rng.random() < 0.9 else entity[kind]())
            lines.append(" ".join(words))
        rows.append((i, "\n".join(lines)))
    rows += [(900, None), (901, ""), rows[3]]
    want, told = brute_spans(rows)
    df = docs(spark, rows)
    got = pii.spans(df).select("doc_id", pii.written(F.concat("found", "terms")).alias("spans"))
    assert Counter((r.doc_id, r.spans) for r in got.collect()) == Counter((i, w) for (i, _), w in zip(rows, want, strict=True))
    assert told and {k for _, k in told} >= {"email", "ip", "phone", "secret"}
    for r in pii.sanitised(df).collect():  # marks of merged spans from the right
        i = next(k for k, (d, _) in enumerate(rows) if d == r.doc_id)
        text, islands = rows[i][1], []
        for k, a, b in sorted(((s.split(":")[0], int(s.split(":")[1]), int(s.split(":")[2])) for s in want[i].split(",") if s), key=lambda s: (s[1], s[2], s[0])):
            if islands and a < islands[-1][2]:
                islands[-1][2] = max(b, islands[-1][2])
            else:
                islands.append([k, a, b])
        for k, a, b in reversed(islands):
            text = f"{text[:a]}<{k}>{text[b:]}"
        assert r.text == text
