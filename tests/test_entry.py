import decimal
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry

DATA = "/root/testdata/sf0.001"


def test_names_agree():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")
def test_entry(spark):
    assert entry.entry(spark).count() > 0


def plain(value):
    """A value by which two engines are compared: numbers to nine digits, lists as tuples."""
    if isinstance(value, (list, tuple)):
        return tuple(map(plain, value))
    if isinstance(value, (float, decimal.Decimal)):
        return None if value != value else round(float(value), 9) + 0.0
    return value


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")
@pytest.mark.parametrize("name", ["join_points_zones", "overlay_area", "overlay_length_wkt", "terrain_features", "mark_duplicates", "read_event_rows", "stream_gradient", "build_crosswalk", "lineage_closure", "gate_rasters", "gate_mappings", "run_gates"])
def test_against_sql(spark, name):
    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.execute(f"create view {f.removesuffix('.parquet')} as select * from '{DATA}/{f}'")
    found = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in found.description]
    got = entry.queries()[name](spark, DATA)
    assert sorted(got.columns) == sorted(names)
    assert Counter(tuple(plain(r[c]) for c in names) for r in got.collect()) == Counter(tuple(map(plain, r)) for r in found.fetchall())
