"""Personal data: patterns, and information-theoretic sanitisation of the terms around them. DataFrame functions only.

Protected entities are the matches of the patterns below. Over all lines of the corpus the operator counts how often each
term (a run of three or more letters) stands in a line, and in a line beside an entity of each kind. With p(c) the share of lines that hold kind c, the information of
a kind is IC(c) = -log p(c), and what a term tells about it is PMI(t; c) = log(p(t, c) / (p(t) p(c))). A term discloses the kind where
``PMI >= disclosure * IC``, that is where seeing the term gives away nearly all of what the redaction hides; it also must stand beside ``support`` different entities, so
copies of one line prove nothing; a line counts by the least of its entities of the kind. Disclosing terms are generalised, or removed, in the lines that hold such an entity.

No pattern crosses a line, so texts are cut into lines first. Positions are in code points: those of a match are running sums of the lengths of the pieces
between matches, those of a line running sums of the lengths of lines, both in windows, so the work grows with the text and not with its square. The patterns use possessive
quantifiers and start only where a run starts or the last match ended, so they find what their plain forms find, in linear time. Only terms that
stand beside ``support`` entities are counted over all lines.

Defined results: a null text counts as empty and stays null when sanitised. Rows with equal id and text have equal spans. Ties: spans that overlap are one mark, of the kind
that starts first, then ends first. A long text is one row, its lines and spans are rows of their own until they are put together. An empty
table gives an empty result. Extra columns are ignored by ``spans`` and carried along by ``sanitised``, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialise, numbered, restored, table

LOCAL = "A-Za-z0-9._%+-"
PATTERNS = {
    "email": rf"(?:(?<![{LOCAL}])|\G)[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
SECRETS = {"secret": r"\b(?i:password|passwd|token|secret|api[_-]?key)\b[\"']?[\x20\t]{0,4}[=:][\x20\t]{0,4}[\"']?[A-Za-z0-9+/_.-]{12,}+[\"']?|\bAKIA[0-9A-Z]{16}\b"}
KINDS = [*PATTERNS, *SECRETS]
TERM = r"\p{L}{3,}+"
DISCLOSURE, SUPPORT = 0.8, 5
SPAN = "array<struct<kind: string, start: int, end: int>>"
BLOCK = 4096
BROADCAST_TERMS = 100_000


def _valid(kind: str, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "ip":
        return F.forall(F.split(match, r"\."), lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3) & (F.coalesce(F.ltrim(p, F.lit("0")).try_cast("int"), F.lit(0)) <= 255))
    if kind == "phone":
        return F.length(digits).between(8, 15)
    if kind == "card":
        def value(i: Column) -> Column:
            d = F.ascii(F.substring(digits, i, F.lit(1))) - 48

            twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
            return F.when((F.length(digits) - i) % 2 == 1, twice).otherwise(d)

        total = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda acc, i: acc + value(i))
        return F.when(F.length(digits).between(16, 19), total % 10 == 0).otherwise(F.lit(False))
    return F.lit(True)


def _possible(text: Column) -> dict[str, Column]:
    """Per kind, whether ``text`` holds the signs without which its pattern can't match."""
    digit = text.rlike("[0-9]")
    secret = F.contains(text, F.lit("=")) | F.contains(text, F.lit(":")) | F.contains(text, F.lit("AKIA"))
    return {"email": F.contains(text, F.lit("@")), "ip": digit & F.contains(text, F.lit(".")), "card": digit, "phone": digit & F.contains(text, F.lit("+")), "secret": secret}


KEY = ["doc_id", "text_key", "text_bytes"]
LINE = ["rid", "line_no"]


def _keys(doc_id: Column, text: Column) -> list[Column]:
    text = F.coalesce(text, F.lit(""))
    return [doc_id.alias("doc_id"), F.xxhash64(text).alias("text_key"), F.octet_length(text).alias("text_bytes")]


def _places(pieces: DataFrame) -> DataFrame:
    """Add (start, end) in the line to (rid, line_no, kind, pos, gap, match): ``gap`` code points stand between a match and the one before it."""
    so_far = Window.partitionBy(*LINE, "kind").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.length("match")).over(so_far).cast("int")
    return pieces.withColumn("end", end).withColumn("start", F.col("end") - F.length("match")).drop("pos", "gap")


def _pieces(line: Column, matches: Column, pattern: str) -> Column:
    """Array of (gap, match): the matches of a line and the code points before each."""
    gaps = F.transform(F.slice(F.split(line, pattern, -1), F.lit(1), F.size(matches)), lambda g: F.length(g))
    return F.arrays_zip(gaps.alias("gap"), matches.alias("match"))


def _free(rows: DataFrame, taken: Column) -> DataFrame:
    """The rows (rid, line_no, start, end, ...) that ``taken`` holds for, and those that overlap none of them."""
    at = F.when(taken, F.col("start")).otherwise(F.col("end") - 1)  # a taken row that starts before another's end comes before it
    before = Window.partitionBy(*LINE).orderBy(at, F.when(taken, 0).otherwise(1)).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("reach", F.max(F.when(taken, F.col("end"))).over(before)).filter(taken | (F.coalesce("reach", F.lit(0)) <= F.col("start"))).drop("reach")


def marked_lines(docs: DataFrame) -> DataFrame:
    """(key..., rid, line_no, at, line, m_<kind>...) of the lines with a match of a pattern; the line starts at code point ``at``."""
    every = PATTERNS | SECRETS
    content = F.coalesce("text", F.lit(""))
    rows = docs.select(*_keys(F.col("doc_id"), F.col("text")), content.alias("content"), F.monotonically_increasing_id().alias("rid"))
    any_of = lambda parts: F.array_max(F.array(*parts))
    lines = rows.filter(any_of(_possible(F.col("content")).values())).select(*KEY, "rid", F.posexplode(F.split("content", "\n", -1)).alias("line_no", "line"))
    none = F.array().cast("array<string>")
    possible = _possible(F.col("line"))
    lines = lines.withColumns({f"m_{k}": F.when(possible[k], F.regexp_extract_all("line", F.lit(p), F.lit(0))).otherwise(none) for k, p in every.items()})
    some = any_of([F.size(f"m_{k}") > 0 for k in every])
    lines = lines.withColumn("width", F.length("line") + 1).withColumn("line", F.when(some, F.col("line")))
    so_far = Window.partitionBy("rid").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    return lines.withColumn("at", F.sum("width").over(so_far).cast("int") - F.col("width")).drop("width").filter(F.col("line").isNotNull())


def entities(marked: DataFrame) -> DataFrame:
    """(key..., rid, line_no, at, kind, start, end, match) of the entities: valid matches of the patterns, and secrets that overlap none of them; places in the line."""
    every = PATTERNS | SECRETS
    none = F.array().cast("array<struct<gap: int, match: string>>")

    def named(kind: str) -> Column:
        found = F.when(F.size(f"m_{kind}") > 0, _pieces(F.col("line"), F.col(f"m_{kind}"), every[kind])).otherwise(none)
        return F.transform(found, lambda x, i: F.struct(F.lit(kind).alias("kind"), i.alias("pos"), x["gap"].alias("gap"), x["match"].alias("match")))

    parts = F.flatten(F.array(*map(named, every)))
    placed = _places(marked.select(*KEY, *LINE, "at", F.explode(parts).alias("p")).select(*KEY, *LINE, "at", "p.*"))
    valid = F.lit(False)
    for k in every:
        valid = F.when(F.col("kind") == k, _valid(k, F.col("match"))).otherwise(valid)
    return _free(placed.filter(valid), F.col("kind") != "secret")


def terms_beside(marked: DataFrame, found: DataFrame) -> DataFrame:
    """(key..., rid, line_no, term, start, end) of the terms in lines with an entity that overlap none; places in the text."""
    with_entity = marked.join(found.select(*LINE).distinct(), LINE, "left_semi")
    parts = _pieces(F.col("line"), F.regexp_extract_all("line", F.lit(TERM), F.lit(0)), TERM)
    terms = _places(with_entity.select(*KEY, *LINE, "at", F.lit("term").alias("kind"), F.posexplode(parts).alias("pos", "p")).select(*KEY, *LINE, "at", "kind", "pos", "p.gap", "p.match"))
    both = terms.unionByName(found.select(terms.columns))
    free = _free(both, F.col("kind") != "term").filter("kind = 'term'")
    return free.select(*KEY, *LINE, F.lower("match").alias("term"), (F.col("at") + F.col("start")).alias("start"), (F.col("at") + F.col("end")).alias("end"))


def line_counts(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, n): the lines of ``docs`` in which each of ``terms`` (term, distinct) stands; the term '' stands in every line that isn't empty."""
    wanted = terms.select("term").unionByName(terms.sparkSession.createDataFrame([("",)], "term string"))
    lines = docs.select(F.explode(F.split(F.coalesce("text", F.lit("")), "\n", -1)).alias("line")).filter("line != ''")
    each = lines.select(F.explode(F.array_distinct(F.concat(F.array(F.lit("")), F.regexp_extract_all(F.lower("line"), F.lit(TERM), F.lit(0))))).alias("term"))
    if terms.limit(BROADCAST_TERMS + 1).count() <= BROADCAST_TERMS:  # a checked size; beyond it counts are made first and joined then
        return each.join(F.broadcast(wanted), "term", "left_semi").groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    return each.groupBy("term").agg(F.count(F.lit(1)).alias("n")).join(wanted, "term", "left_semi")


def disclosing(docs: DataFrame, found: DataFrame, beside: DataFrame, disclosure: float = DISCLOSURE, support: int = SUPPORT) -> DataFrame:
    """(term, kind) of the terms that disclose a kind; ``found`` from ``entities``, ``beside`` from ``terms_beside``."""
    kinds = materialise(found.groupBy(*LINE, "kind").agg(F.min("match").alias("entity")), "kinds")
    pairs = beside.select(*LINE, "term").distinct().join(kinds, LINE)
    seen = pairs.groupBy("term", "kind").agg(F.count(F.lit(1)).alias("both"), F.count_distinct("entity").alias("entities")).filter(F.col("entities") >= support)
    seen = materialise(seen.select("term", "kind", "both"), "seen")
    counts = materialise(line_counts(docs, seen.select("term").distinct()), "counts")
    total = counts.filter("term = ''").select("n").first()
    held = {r["kind"]: r["n"] for r in kinds.groupBy("kind").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row a kind
    share = {k: n / total["n"] for k, n in held.items() if total and n < total["n"]}
    told = F.lit(False)
    for k, p in share.items():
        told = F.when(F.col("kind") == k, F.log(F.col("both") / F.col("n")) - math.log(p) >= disclosure * -math.log(p)).otherwise(told)
    return seen.join(counts, "term").filter(told).select("term", "kind")


def span_rows(docs: DataFrame, disclosure: float = DISCLOSURE, support: int = SUPPORT) -> DataFrame:
    """(key..., rid, kind, start, end) of the entities and disclosing terms (kind ``term``) of ``docs`` (doc_id, text, ...); repeated rows have a rid each."""
    narrow = docs.select("doc_id", "text")
    marked = materialise(marked_lines(narrow), "marked")
    found = materialise(entities(marked), "entities")
    beside = materialise(terms_beside(marked, found), "beside")
    told = disclosing(narrow, found, beside, disclosure, support)
    kinds = found.select(*LINE, "kind").distinct()
    hits = beside.join(told, "term").join(kinds, [*LINE, "kind"]).select(*KEY, "rid", F.lit("term").alias("kind"), "start", "end").distinct()
    return found.select(*KEY, "rid", "kind", (F.col("at") + F.col("start")).alias("start"), (F.col("at") + F.col("end")).alias("end")).unionByName(hits)


def _with(keyed: DataFrame, extra: DataFrame) -> DataFrame:
    """``keyed`` (key..., ...) with the other columns of ``extra`` (key..., ...), null where it has no row."""
    right = extra.select(*[F.col(c).alias(f"r_{c}" if c in KEY else c) for c in extra.columns])
    same = F.lit(True)
    for k in KEY:
        same &= F.col(k).eqNullSafe(F.col(f"r_{k}"))
    return keyed.join(right, same, "left").drop(*[f"r_{k}" for k in KEY])


def spans(docs: DataFrame, disclosure: float = DISCLOSURE, support: int = SUPPORT) -> DataFrame:
    """(doc_id, found, terms) of each row of ``docs`` (doc_id, text, ...): entities by kind and start, disclosing terms by start."""
    order = F.lit(0)
    for i, k in enumerate(KINDS):
        order = F.when(F.col("kind") == k, i).otherwise(order)
    rows = span_rows(docs, disclosure, support)
    listed = lambda test: F.array_sort(F.collect_list(F.when(test, F.struct(order.alias("nth"), "start", "end", "kind"))))
    each = rows.groupBy(*KEY, "rid").agg(listed(F.col("kind") != "term").alias("found"), listed(F.col("kind") == "term").alias("terms")).drop("rid").dropDuplicates(KEY)
    plain = lambda c: F.coalesce(F.transform(c, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))), F.array().cast(SPAN)).alias(c)
    return _with(docs.select(*_keys(F.col("doc_id"), F.col("text"))), each).select("doc_id", plain("found"), plain("terms"))


def written(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _cut(blocks: Column, start: Column, end: Column) -> Column:
    """The code points from ``start`` to ``end`` of a text that lies in blocks of ``BLOCK``."""
    first, last = F.floor(start / BLOCK).cast("int"), F.floor((end - 1) / BLOCK).cast("int")
    head = F.substring(F.get(blocks, first), start - first * BLOCK + 1, F.least(end - start, F.lit(BLOCK)))
    whole = F.concat(head, F.array_join(F.slice(blocks, first + 2, F.greatest(last - first - 1, F.lit(0))), ""), F.substring(F.get(blocks, last), F.lit(1), end - last * BLOCK))
    return F.when(end <= start, F.lit("")).when(first == last, head).otherwise(whole)


def sanitised(docs: DataFrame, disclosure: float = DISCLOSURE, support: int = SUPPORT, generalise: bool = True) -> DataFrame:
    """``docs`` with entities replaced by their kind, and disclosing terms by ``<term>``, or by nothing."""
    rows = span_rows(docs, disclosure, support)
    order = Window.partitionBy("rid").orderBy("start", "end", "kind")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    starts = rows.withColumn("fresh", (F.col("start") >= F.coalesce(reach, F.lit(0))).cast("int"))
    islands = starts.withColumn("island", F.sum("fresh").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    merged = islands.groupBy(*KEY, "rid", "island").agg(F.min(F.struct("start", "end", "kind"))["kind"].alias("kind"), F.min("start").alias("start"), F.max("end").alias("end"))
    marks = merged.groupBy(*KEY, "rid").agg(F.array_sort(F.collect_list(F.struct("start", "end", "kind"))).alias("marks")).drop("rid").dropDuplicates(KEY)
    inner = numbered(docs)
    doc_id, text = (F.col(f"c{docs.columns.index(c)}") for c in ("doc_id", "text"))
    joined = _with(inner.select("*", *_keys(doc_id, text)), marks).withColumn("blocks", F.when(F.col("marks").isNotNull(), F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))))
    blocks, found = F.col("blocks"), F.col("marks")

    def piece(s: Column, i: Column) -> Column:
        name = F.concat(F.lit("<"), s["kind"], F.lit(">"))
        mark = name if generalise else F.when(s["kind"] == "term", F.lit("")).otherwise(name)
        return F.concat(_cut(blocks, F.when(i > 0, F.get(found, i - 1)["end"]).otherwise(F.lit(0)), s["start"]), mark)

    last = F.element_at(found, -1)["end"]
    tail = _cut(blocks, last, F.length(text))
    new = F.when(found.isNotNull(), F.concat(F.array_join(F.transform(found, piece), ""), tail)).otherwise(text)
    return restored(joined.select(*[new.alias(c) if i == docs.columns.index("text") else F.col(c) for i, c in enumerate(inner.columns)]), docs)


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spans(table(spark, sf_dir, "documents"))
    of_kind = lambda *kinds: F.filter("found", lambda s: s["kind"].isin(*kinds))
    counts = [F.size(of_kind(k)).cast("long").alias(f"n_{k}") for k in PATTERNS]
    return rows.select("doc_id", *counts, F.sha2(written(of_kind(*PATTERNS)), 256).alias("base_sha256"), written(F.concat("found", "terms")).alias("spans"))


QUERIES = {"op9_pii": op9_pii}
ORACLE_SQL: dict[str, str] = {}
