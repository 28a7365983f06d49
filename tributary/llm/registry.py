"""The queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

from . import byte_bpe, collocations, decontamination, exact_dedup, language_id, license_scan, packing, pii, prefix_trie, quality, sharding, simhash, url_filter

MODULES = (language_id, url_filter, license_scan, exact_dedup, sharding, packing, simhash, quality, pii, byte_bpe, collocations, prefix_trie, decontamination)


def queries() -> dict:
    return {k: f for m in MODULES for k, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: q for m in MODULES for k, q in m.ORACLE_SQL.items()}
