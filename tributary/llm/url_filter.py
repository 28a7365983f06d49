"""URL filtering by a rule list and by mined association rules. DataFrame functions and Spark ML's FP-growth only.

A listed rule fits its host, all subdomains, and paths that start with the rule's; the longest one decides. Other URLs
are judged by rules "these tokens together -> bad" that FP-growth mines from labelled URLs, pruned by support, by confidence and by
lift, the confidence above the share of bad URLs. Only minimal rules are kept, as a longer one matches nothing more. Before mining, what can't be part of a minimal rule of several tokens goes: tokens that are a
rule alone, and tokens that stand beside bad too seldom. Tokens that occur in just the same labelled URLs are one item; any token of an item stands for it. So long bad URLs whose
tokens nearly always come together aren't mined for all subsets of them. Every mined rule is filed under its rarest item (an inverted index);
distinct URLs meet the rules by an equi-join on items and are then compared with the whole rule.

Defined results: a null URL or one without ``://`` has an empty host and path, no rule, and is allowed. Repeated rows are
judged alike. Ties: of listed rules of equal length the one with the longer host decides; a mined rule at a limit holds. Long URLs are read whole, their tokens are one array.
Without labels nothing is mined and all unlisted URLs are allowed. An empty table gives an empty result. Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, table


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str


#: The rule list of the query's contract.
RULES = (
    Rule("block", "com", "/en/"),
    Rule("allow", "example.com", "/en/7"),
    Rule("allow", "net", "/de/"),
    Rule("block", "example.net", "/de/8"),
    Rule("block", "org", "/es/"),
)
CONFIDENCE, SUPPORT, MIN_ROWS, LIFT = 0.8, 0.001, 8, 1.5
BROADCAST_RULES = 20_000  # rows of the index, or of its tokens, that are broadcast; beyond them both sides are shuffled
BAD = "bad"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, "://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def listed(host: Column, path: Column, rules: tuple[Rule, ...]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest listed rule that fits, or nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.host + r.path), len(r.host), r.host + r.path)):
        fits = ((host == r.host) | host.endswith(f".{r.host}")) & path.startswith(r.path)
        rule = F.when(fits, r.host + r.path).otherwise(rule)
        verdict = F.when(fits, r.verdict).otherwise(verdict)
    return rule, verdict


def tokens(url: Column) -> Column:
    """Distinct tokens of a URL: host labels, path segments with digits as #, names of parameters, fragment."""
    said = lambda kind, parts: F.transform(F.filter(parts, lambda p: p != ""), lambda p: F.concat(F.lit(kind), p))
    plain = F.regexp_replace(path_of(url), "[0-9]+", "#")
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    names = F.transform(F.split(query, "&"), lambda p: F.substring_index(p, "=", 1))
    fragment = F.array(F.regexp_extract(url, "#(.*)", 1))
    every = F.concat(said("host:", F.split(host_of(url), r"\.")), said("path:", F.split(plain, "[/.]")), said("name:", names), said("part:", fragment))
    return F.coalesce(F.array_distinct(every), F.array().cast("array<string>"))


def mine(labelled: DataFrame, confidence: float = CONFIDENCE, support: float = SUPPORT, min_rows: int = MIN_ROWS, lift: float = LIFT) -> tuple[DataFrame, DataFrame]:
    """(rules, items) from (url, bad boolean): the minimal rules (needs array of items, key, confidence, lift, rows), key being the rarest item, and (token, item) of the tokens used."""
    rows = materialise(labelled.select(F.monotonically_increasing_id().alias("row"), tokens(F.col("url")).alias("tokens"), F.coalesce("bad", F.lit(False)).alias("bad")), "labelled")
    n, n_bad = rows.agg(F.count(F.lit(1)), F.count_if("bad")).first()
    least = max(min_rows, support * n)
    each = rows.select("row", "bad", F.explode("tokens").alias("token"))
    same = each.groupBy("token").agg(F.count(F.lit(1)).alias("uses"), F.count_if("bad").alias("hits"), F.sum(F.xxhash64("row").cast("decimal(38,0)")).alias("mark"), F.sum(F.xxhash64("row", F.lit(1)).cast("decimal(38,0)")).alias("mark2")).filter(F.col("uses") >= least)
    same = materialise(same, "tokens")
    first = same.groupBy("uses", "mark", "mark2").agg(F.min("token").alias("item"))
    items = materialise(same.join(first, ["uses", "mark", "mark2"]).select("token", "item", "uses", "hits"), "items")
    share = n_bad / n if n_bad else 1.0
    lone = items.filter("token = item").withColumns({"confidence": F.col("hits") / F.col("uses"), "lift": F.col("hits") / F.col("uses") / share})
    holds = (F.col("hits") >= least) & (F.col("confidence") >= confidence) & (F.col("lift") >= lift)
    single = lone.filter(holds).select(F.array("item").alias("needs"), "confidence", "lift", F.col("hits").alias("rows"))
    part = materialise(lone.filter((F.col("hits") >= least) & ~holds).select(F.col("item").alias("token")), "parts")
    if n_bad == 0 or part.isEmpty():
        mined = single
    else:
        used = each.join(part, "token").groupBy("row").agg(F.collect_set("token").alias("items"), F.first("bad").alias("bad"))
        baskets = materialise(used.select(F.when(F.col("bad"), F.concat("items", F.array(F.lit(BAD)))).otherwise(F.col("items")).alias("items")), "baskets")
        held = baskets.count()
        model = FPGrowth(itemsCol="items", minSupport=min(1.0, least / held), minConfidence=confidence).fit(baskets)
        rules = model.associationRules.filter((F.size("consequent") == 1) & (F.col("consequent")[0] == BAD))
        several = rules.select(F.col("antecedent").alias("needs"), "confidence", (F.col("confidence") / share).alias("lift"), F.round(F.col("support") * held).cast("long").alias("rows")).filter(F.col("lift") >= lift)
        mined = single.unionByName(several)
    keyed = materialise(mined.withColumn("rule", F.monotonically_increasing_id()), "rules")
    rarest = keyed.select("rule", F.explode("needs").alias("item")).join(lone.select("item", "uses"), "item").groupBy("rule").agg(F.min_by("item", F.struct("uses", "item")).alias("key"))
    index = materialise(keyed.join(rarest, "rule"), "index")
    return materialise(minimal(index), "minimal"), items.select("token", "item")


def minimal(rules: DataFrame) -> DataFrame:
    """The rules (rule, needs, key, ...) without those that hold all items of a shorter one."""
    short = rules.select(F.col("key").alias("item"), F.col("needs").alias("part"))
    holds = rules.select("rule", "needs", F.explode("needs").alias("item")).join(short, "item")
    more = holds.filter((F.size("part") < F.size("needs")) & (F.size(F.array_except("part", "needs")) == 0)).select("rule").distinct()
    return rules.join(more, "rule", "left_anti").select("needs", "key", "confidence", "lift", "rows")


def matched(urls: DataFrame, rules: DataFrame, items: DataFrame) -> DataFrame:
    """The distinct URLs of ``urls`` (url) that hold all items of a rule."""
    small = lambda df: F.broadcast(df) if df.limit(BROADCAST_RULES + 1).count() <= BROADCAST_RULES else df
    used = materialise(items.join(rules.select(F.explode("needs").alias("item")).distinct(), "item", "left_semi"), "used")
    each = urls.filter(F.col("url").isNotNull()).select("url").distinct().select("url", F.explode(tokens(F.col("url"))).alias("token")).join(small(used), "token")
    held = each.groupBy("url").agg(F.collect_set("item").alias("items")).select("url", "items", F.explode("items").alias("key"))
    index = small(rules.select("key", "needs"))
    return held.join(index, "key").filter(F.size(F.array_except("needs", "items")) == 0).select("url").distinct()


def judge(pages: DataFrame, labelled: DataFrame, rules: tuple[Rule, ...] = RULES, confidence: float = CONFIDENCE, support: float = SUPPORT, min_rows: int = MIN_ROWS, lift: float = LIFT) -> DataFrame:
    """(page_id, host, path, rule, verdict, mined) of each row of ``pages`` (page_id, url, ...)."""
    bad = matched(pages.select("url"), *mine(labelled, confidence, support, min_rows, lift)).withColumn("mined", F.lit(True))
    rows = pages.select("page_id", "url").join(bad, "url", "left").withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url")), "mined": F.coalesce("mined", F.lit(False))})
    rule, verdict = listed(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": rule, "said": verdict})
    return rows.select("page_id", "host", "path", "rule", F.coalesce("said", F.when(F.col("mined"), "block").otherwise("allow")).alias("verdict"), "mined")


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page shows the document whose number follows the language in its path, so it has that document's labels; bad: low quality or toxic."""
    pages = table(spark, sf_dir, "pages")
    labels = table(spark, sf_dir, "labels").select("doc_id", ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
    numbered = pages.select("url", F.regexp_extract(path_of(F.col("url")), "^/[a-z]+/([0-9]{1,18})", 1).try_cast("long").alias("doc_id"))
    return judge(pages, numbered.join(labels, "doc_id").select("url", F.coalesce("bad", F.lit(False)).alias("bad")))


QUERIES = {"op2_url_filter": op2_url_filter}
ORACLE_SQL: dict[str, str] = {}
