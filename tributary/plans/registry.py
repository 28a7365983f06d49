"""All queries outside the subpackage for training data."""

from __future__ import annotations

from . import rasters, records, spatial

MODULES = (rasters, spatial, records)


def queries() -> dict:
    return {k: f for m in MODULES for k, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: q for m in MODULES for k, q in m.ORACLE_SQL.items()}
