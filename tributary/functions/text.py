"""Column expressions over names, numbers, dates, identifiers and secrets."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Level prefixes of unit names, the phrase for a partial merger, and truth words.
UNIT_PREFIX = "(?iu)^(xã|phường|thị trấn) "
PARTIAL_MERGER = "một phần"
FALSE_WORDS = ("", "0", "false", "no", "none")
FALSE_EVIDENCE = ("", "0", "False", "false", "None", "none", "null")
SENSITIVE = "secret|token|password|authorization|apikey|signature|credential"
#: Patterns that define what is a secret.
SENSITIVE_TEXT = r"(?i)\b(?:secret|token|password|authorization|api[-_ ]?key|signature|credential)\b\s*[:=]"
BEARER = r"(?i)\bbearer\s+[^\s<,;]+"
USER_INFO = r"(?i)(https?://)[^/\s@]+@"


@F.pandas_udf(StringType())
def _nfc(values: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Unicode NFC has no built-in; ASCII and composed texts return unchanged."""
    for s in values:
        yield s.map(lambda v: v if v is None or v.isascii() else unicodedata.normalize("NFC", v))


def nfc(col: Column) -> Column:
    return _nfc(col)


def collapse(col: Column) -> Column:
    return F.regexp_replace(F.trim(F.regexp_replace(col, r"(?U)\s+", " ")), " +", " ")


def normalize_unit_name(col: Column, composed: bool = False) -> Column:
    """NFC (unless ``composed``), collapsed, folded, without its level prefix."""
    text = F.lower(collapse(col if composed else nfc(col)))
    return collapse(F.regexp_replace(text, UNIT_PREFIX, ""))


def strip_unit_prefix(col: Column, composed: bool = False) -> Column:
    """The name without its level prefix, in its own case."""
    return collapse(F.regexp_replace(collapse(col if composed else nfc(col)), UNIT_PREFIX, ""))


def unit_prefix(col: Column) -> Column:
    """The level prefix as written, or an empty text."""
    return F.regexp_extract(collapse(col), UNIT_PREFIX, 1)


def normalize_label(col: Column) -> Column:
    return F.lower(collapse(col))


def classify_unit(col: Column) -> Column:
    """ward or commune by the prefix; null for anything else."""
    return F.when(col.startswith("Phường "), "ward").when(col.startswith("Xã "), "commune")


def explode_predecessors(df: DataFrame, text: str, composed: bool = False) -> tuple[DataFrame, DataFrame]:
    """(rows, rejected): one row per predecessor with position, written, unit_type, normalized.

    Blank texts, texts with an empty item and texts that claim a partial merger are rejected whole.
    """
    value = F.coalesce(F.col(text) if composed else nfc(F.col(text)), F.lit(""))
    items = F.transform(F.split(value, ","), collapse)
    bad = F.exists(items, lambda x: x == "") | F.lower(value).contains(PARTIAL_MERGER)
    marked = df.withColumns({"__items": items, "__bad": bad})
    rows = marked.filter(~F.col("__bad")).select(*df.columns, F.posexplode("__items").alias("position", "written"))
    rows = rows.withColumns({"unit_type": unit_prefix(F.col("written")), "normalized": normalize_unit_name(F.col("written"), True)})
    return rows, marked.filter("__bad").select(*df.columns)


def parse_local_number(col: Column) -> Column:
    """One comma and no dot: a decimal comma; otherwise commas group thousands. Null if it is no number."""
    text = F.replace(F.trim(col), F.lit(" "), F.lit(""))
    commas = F.length(text) - F.length(F.replace(text, F.lit(","), F.lit("")))
    plain = F.when((commas == 1) & ~text.contains("."), F.replace(text, F.lit(","), F.lit("."))).otherwise(F.replace(text, F.lit(","), F.lit("")))
    return plain.try_cast("double")


def parse_event_dates(col: Column) -> tuple[Column, Column]:
    """(start, end) of d/m/yyyy, d-d/m/yyyy and d/m-d/m/yyyy; both null where either is no date."""
    sides = F.transform(F.split(collapse(col), "-", -1), lambda t: F.split(F.trim(t), "/", -1))
    last = F.element_at(sides, -1)
    first = F.element_at(sides, 1)
    written = F.forall(F.flatten(sides), lambda t: t.rlike("^[0-9]{1,2}$|^[0-9]{4}$")) & (F.size(sides) <= 2) & (F.size(last) == 3) & ((F.size(sides) == 1) | F.size(first).between(1, 2))
    short = F.forall(F.concat(F.slice(last, 1, 2), F.when(F.size(sides) == 2, first).otherwise(F.array().cast("array<string>"))), lambda t: F.length(t) <= 2) & (F.length(F.get(last, 2)) == 4)

    def day(d: Column, m: Column) -> Column:
        return F.when(written & short, F.try_to_date(F.concat_ws("-", F.get(last, 2), F.lpad(m, 2, "0"), F.lpad(d, 2, "0")), "yyyy-MM-dd"))

    start, end = day(F.get(first, 0), F.coalesce(F.get(first, 1), F.get(last, 1))), day(F.get(last, 0), F.get(last, 1))
    both = start.isNotNull() & end.isNotNull()
    return F.when(both, start), F.when(both, end)


def integral_or_null(col: Column) -> Column:
    """The number as bigint where it is whole and finite."""
    return F.when((col == F.floor(col)) & ~F.isnan(col) & (F.abs(col) < 9.2e18), col.cast("bigint"))


def zfill5(col: Column) -> Column:
    text = col.cast("string")
    return F.when(F.length(text) < 5, F.lpad(text, 5, "0")).otherwise(text)


def pfaf_text(col: Column) -> Column:
    return F.regexp_replace(col.cast("string"), r"\.0$", "")


def depth_limits(col: Column) -> tuple[Column, Column]:
    pattern = r"^(\d+)-(\d+)cm$"
    return tuple(F.nullif(F.regexp_extract(col, pattern, g), F.lit("")).try_cast("int") for g in (1, 2))


def truthy_tag(col: Column) -> Column:
    return F.coalesce(~F.lower(F.trim(col)).isin(*FALSE_WORDS), F.lit(False))


def osm_identity(identity: Column, kind: Column, way_id: Column, default_type: str) -> Column:
    """``type/id``. Typed ids stay; a null id falls back to the way id; null where both are missing or blank."""
    fallback = identity.isNull()
    text = F.nullif(F.trim(F.coalesce(identity, way_id)), F.lit(""))
    named = F.when(fallback, F.lit("way")).otherwise(F.coalesce(F.nullif(kind, F.lit("")), F.lit(default_type)))
    return F.when(text.rlike(r"^(node|way|relation)/[^/]+$"), text).otherwise(F.concat(named, F.lit("/"), text))


def osm_tags(tags: list[str], other: str) -> Column:
    """Map of all non-null tag columns and of ``other``, a JSON object; other text is kept under its own name."""
    own = F.map_filter(F.create_map(*[x for t in tags for x in (F.lit(t), F.col(t).cast("string"))]), lambda _, v: v.isNotNull())
    parsed = F.from_json(F.col(other), "map<string,string>")
    is_object = parsed.isNotNull() & F.col(other).rlike(r"^\s*\{")
    raw = F.when(F.col(other).isNull() | (F.col(other) == ""), F.create_map().cast("map<string,string>")).otherwise(F.create_map(F.lit(other), F.col(other)))
    extra = F.when(is_object, F.map_filter(parsed, lambda _, v: v.isNotNull())).otherwise(raw)
    kept = F.map_filter(own, lambda k, _: ~F.map_contains_key(extra, k))
    return F.map_from_entries(F.array_sort(F.map_entries(F.map_concat(kept, extra))))


def evidence_truthy(col: Column) -> Column:
    """Whether a JSON flag value warns: some leaf is neither zero, empty nor a word for nothing. Unparsable text warns."""
    text = F.trim(col)
    empty = text.isin("", "{}", "[]", "null", "None", "nan")
    variant = F.try_parse_json(text)
    leaves = F.regexp_extract_all(F.regexp_replace(text, r'"(?:[^"\\]|\\.)*"\s*:', ""), F.lit(r'"((?:[^"\\]|\\.)*)"|(-?[0-9][0-9.eE+-]*)|(true|false|null)'), F.lit(0))
    real = F.exists(leaves, lambda v: F.when(v.startswith('"'), ~F.trim(F.replace(v, F.lit('"'), F.lit(""))).isin(*FALSE_EVIDENCE)).when(v.isin("true", "false", "null"), v == "true").otherwise(F.coalesce(v.try_cast("double") != 0, F.lit(True))))
    return F.coalesce(~empty & F.when(variant.isNull(), True).otherwise(real), F.lit(False))


def asset_key(*identity: Column) -> Column:
    return F.concat(F.lit("existing-"), F.substring(F.sha2(F.concat_ws("\0", *[F.coalesce(c.cast("string"), F.lit("")) for c in identity]), 256), 1, 24))


def redact(col: Column) -> Column:
    """Bearer tokens, user info in URLs and sensitive query values replaced."""
    text = F.regexp_replace(col.cast("string"), BEARER, "Bearer [REDACTED]")
    text = F.regexp_replace(text, USER_INFO, "$1[REDACTED]@")
    spread = "|".join("[^a-zA-Z0-9=&#\\s]*".join(w) for w in SENSITIVE.split("|"))
    return F.regexp_replace(text, rf"(?i)([?&][^=&#\s]*(?:{spread})[^=&#\s]*)=[^&#\s]*", "$1=[REDACTED]")


def sensitive_key(col: Column) -> Column:
    plain = F.regexp_replace(F.lower(col), "[^a-z0-9]", "")
    return plain.rlike(SENSITIVE + "|privatekey") & (plain != "tokenurl")


def flag_credentials(df: DataFrame, url: str, text: str) -> DataFrame:
    """Rows with a secret, with ``reason``: user info or a sensitive parameter in the URL, or an assignment in the text."""
    address, query = F.col(url), F.regexp_extract(F.col(url), r"\?([^#]*)", 1)
    names = F.filter(F.split(query, "&"), lambda p: p != "")
    has_key = F.exists(names, lambda p: sensitive_key(F.substring_index(p, "=", 1)))
    reason = F.when(address.rlike("^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*@"), "userinfo").when(has_key, "parameter").when(F.col(text).rlike(SENSITIVE_TEXT), "text")
    return df.withColumn("reason", reason).filter(F.col("reason").isNotNull())
