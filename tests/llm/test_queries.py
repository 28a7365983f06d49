"""Every query on small tables with nulls, empty and long texts, ties and repeated rows, against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.llm.test_corpus import NODE, brute_collocations, brute_hits, brute_trie, passages, talks
from tests.llm.test_dedup import brute_components, brute_fingerprint
from tests.llm.test_text import BASE, brute_counts, brute_quality, valid, words

SPACE = r"[^\x20\x09-\x0D]+"


def texts():
    rng = random.Random(11)
    vocabulary = [f"wort{k}" for k in range(60)] + ["é", "😀", "don't", "7", "mail a.b@host.org", "10.0.0.1", "4111 1111 1111 1111", "+1 (555) 010-9999", "password: abcdefghijklmnop"]
    some = [" ".join(rng.choices(vocabulary, k=rng.randint(0, 60))) for _ in range(120)]
    some += ["\n".join([words("menu", 12), words(i, 3), words("foot", 30)]) for i in range(80)] + [words("long", 30_000), "Released under the MIT License\nand more", "Red fox runs. the red hen. " * 120, "", " \n\t", "x"]
    return some + some[:20] + [some[5]] * 30


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("small"))
    rows = [(i * 3 % 1000, t, ["de", "en", None][i % 3], ["h1", "h1", "h2", None][i % 4]) for i, t in enumerate(texts())]
    rows += [(900_000, None, "de", None), (900_001, None, None, "h1"), (None, "x y z", "en", "h1"), (None, None, None, None), rows[7], rows[7]]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumns({"n_chars": F.length("text"), **{c: F.lit("e") for c in ("id", "digest", "fp", "row", "host", "kept", "a.b", "c0", "sig", "rid", "n")}})
    df.repartition(5).write.parquet(f"{d}/documents.parquet")
    urls = [f"http://{h}/{p}/{i}" for i in range(40) for h, p in (("www.bad-site.example.fr", "x"), ("good.fr", "y"), ("a.com", "en"), ("example.net", "de/8"))] + [None, "nothing", "HTTP://A.Org/es/?q#f"]
    spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("html", F.lit("<p>")).write.parquet(f"{d}/pages.parquet")
    spark.createDataFrame([(i, i % 2, 0) for i in range(40)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([*passages()[1], (70, " ".join(f"wort{k}" for k in range(3))), (71, texts()[3][:120]), (72, words("long", 30)), (73, "x")], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    spark.createDataFrame([t for t in talks() if t[0] != 8000], "conv_id long, turn int, role string, text string").write.parquet(f"{d}/conversations.parquet")
    return d, [r[:4] for r in rows]


def run(spark, small, name):
    found = [f for k, f in entry.queries().items() if k.startswith(name)]
    return found[0](spark, small[0]).collect()


def test_op1(spark, small):
    got = run(spark, small, "op1_")
    want = Counter((i, zlib.crc32(str(i).encode()) % 5 == 0) for i, *_ in small[1] if i is not None)
    assert Counter((r.doc_id, r.held_out) for r in got if r.doc_id is not None) == want and len(got) == len(small[1])
    letter = {i: bool(t and any(c.isalpha() for c in t)) for i, t, *_ in small[1] if i is not None}
    assert all((r.lang_pred == "und") != letter[r.doc_id] and 0 <= r.score <= 1 for r in got if r.doc_id is not None)


def test_op2(spark, small):
    """The labels of the small table don't depend on the URL, so the listed rules decide alone."""
    rules = [("block", "com", "/en/"), ("allow", "example.com", "/en/7"), ("allow", "net", "/de/"), ("block", "example.net", "/de/8"), ("block", "org", "/es/")]
    rows = spark.read.parquet(f"{small[0]}/pages.parquet").select("page_id", "url").collect()
    want = {}
    for i, u in rows:
        rest = u.split("://", 1)[1] if u and "://" in u else None
        host = re.split("[/?#]", rest)[0] if rest is not None else ""
        path = re.split("[?#]", rest[len(host):])[0] if rest is not None else ""
        fits = [(len(h + p), h + p, v) for v, h, p in rules if (host.lower() == h or host.lower().endswith("." + h)) and path.startswith(p)]
        want[i] = (host.lower(), path, *(max(fits)[1:] if fits else (None, "allow")))
    assert {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in run(spark, small, "op2_")} == want and len({w[2] for w in want.values()}) > 2


def test_op3(spark, small):
    got = run(spark, small, "op3_")
    notice = "Released under the MIT License"
    assert Counter((r.doc_id, r.start, r.end) for r in got if r.license == "MIT") == Counter((i, t.index(notice), t.index(notice) + len(notice)) for i, t, *_ in small[1] if t and notice in t)


def test_op4(spark, small):
    groups = defaultdict(list)
    for i, t, *_ in small[1]:
        groups[t or ""].append(i)
    best = {t: max((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    got = run(spark, small, "op4_")
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == Counter((i, best[t], len(ids), sha(t)) for t, ids in groups.items() for i in ids)
    assert Counter(r.text_sha256 for r in got if r.kept) == Counter(map(sha, groups)) and all(r.doc_id == r.keep_id for r in got if r.kept)


def test_op5(spark, small):
    got = run(spark, small, "op5_")
    size = lambda t: len((t or "").encode()) + 16
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == Counter((i, size(t), zlib.crc32((t or "").encode())) for i, t, *_ in small[1])
    places = defaultdict(list)
    for r in got:
        places[r.shard].append(r.slot)
    assert set(places) <= set(range(40)) and all(sorted(p) == list(range(len(p))) for p in places.values()) and {r.law for r in got} == {"bytes"}


def test_op6(spark, small):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    library.encode_special_tokens = True
    ids = lambda t: np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
    got = sorted(run(spark, small, "op6_"), key=lambda r: (r.sequence_id, r.offset))
    at, docs, open_doc = 0, Counter(), None
    for r in got:
        assert r.sequence_id * 2048 + r.offset == at and r.length <= 2048 - r.offset  # no gap before the end of all
        at += r.length
        open_doc = [] if r.start == 0 else open_doc
        open_doc.append((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens))
        if r.start + r.length == r.doc_tokens:
            docs[tuple(open_doc)] += 1
    want = defaultdict(list)
    for i, t, *_ in small[1]:
        want[i].append(ids(t))
    for pieces, n in docs.items():
        fits = [x for x in want[pieces[0][0]] if len(x) == pieces[0][4] and all(zlib.crc32(x[s : s + k].tobytes()) == c for _, s, k, c, _ in pieces)]
        assert len(fits) >= n
    assert sum(docs.values()) == len(small[1])


def test_op7(spark, small):
    prints = {t: brute_fingerprint(t) for t in {t for _, t, *_ in small[1] if t is None or len(t) < 50_000}}
    prints |= {t: __import__("tributary.llm.simhash", fromlist=["x"]).fingerprint(t) for _, t, *_ in small[1] if t not in prints}
    of = brute_components(prints.values())
    least = defaultdict(list)
    for i, t, *_ in small[1]:
        least[of[prints[t]]].append(i)
    want = Counter((i, f"{prints[t]:016x}", min((x for x in least[of[prints[t]]] if x is not None), default=None)) for i, t, *_ in small[1])
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in run(spark, small, "op7_")) == want


def test_op8(spark, small):
    rows = [(i, t, h) for i, t, _, h in small[1]]
    verdict = brute_quality(rows, 20, 0.2)
    base = {t: brute_counts(t or "") for _, t, _ in rows}
    want = Counter((i, *base[t], base[t][0] < 20 or 100 * base[t][4] > 30 * base[t][0], verdict[i, t, h][1]) for i, t, h in rows)
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept) for r in run(spark, small, "op8_")) == want
    assert any(not kept and not failed for *_, failed, kept in want)


def test_op9(spark, small):
    got = run(spark, small, "op9_")
    want = Counter()
    for i, t, *_ in small[1]:
        found = [(k, m.start(), m.end()) for k, p in BASE for m in re.finditer(p, t or "") if valid(k, m[0])]
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in found)
        want[(i, *[sum(k == x for x, *_ in found) for k, _ in BASE], hashlib.sha256(text.encode()).hexdigest())] += 1
    assert Counter((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in got) == want
    for r in got:  # base spans come first in the text of all spans
        base = ",".join(s for s in r.spans.split(",") if s.split(":")[0] in dict(BASE))
        assert hashlib.sha256(base.encode()).hexdigest() == r.base_sha256


def test_op10(spark, small):
    from tributary.llm import byte_bpe

    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), special_tokens={})
    sha = lambda b: hashlib.sha256(b).hexdigest()
    coded = {t: np.array(library.encode_ordinary(t or ""), "<u4") for _, t, *_ in small[1]}
    want = Counter((i, len(coded[t]), sha(coded[t].tobytes()), sha((t or "").encode())) for i, t, *_ in small[1])
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in run(spark, small, "op10_")) == want


def test_op11(spark, small):
    got = run(spark, small, "op11_")
    want = brute_collocations([(lang, t) for _, t, lang, _ in small[1]])
    assert len(got) == len(want) and {(r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in got} == want and want


def test_op12(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small[0]}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert Counter(tuple(r[c] for c in NODE) for r in run(spark, small, "op12_")) == brute_trie(rows)


def test_op13(spark, small):
    items = [tuple(r) for r in spark.read.parquet(f"{small[0]}/benchmark.parquet").collect()]
    want = Counter((i, n, hit, len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), hit > 0) for (i, *_), (n, hit, ids) in zip(small[1], brute_hits([t for _, t, *_ in small[1]], items), strict=True))
    assert Counter((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in run(spark, small, "op13_")) == want and any(w[2] for w in want)


@pytest.mark.parametrize("name", [k for k in entry.queries() if re.match(r"op\d+_", k)])
def test_empty_tables(spark, small, tmp_path, name):
    for t in ("documents", "pages", "labels", "conversations", "benchmark"):
        spark.read.parquet(f"{small[0]}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert entry.queries()[name](spark, str(tmp_path)).count() == 0


def test_pipeline(spark, small, tmp_path):
    import corpus_pipeline

    out = corpus_pipeline.run(spark, small[0]).collect()
    assert out and all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in out)
    spark.read.parquet(f"{small[0]}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    names = spark.read.parquet(f"{small[0]}/documents.parquet").columns
    empty = spark.read.parquet(f"{small[0]}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, empty, small[0]).columns == names and stage(spark, empty, small[0]).count() == 0
