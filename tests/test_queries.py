"""Every query with SQL against DuckDB over the smallest tables."""

import math
import os
from decimal import Decimal

import pytest

import __spark_entry__ as entry
from chronofold import registry

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables here")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    c = duckdb.connect()
    for name in os.listdir(DATA):
        c.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{DATA}/{name}'")
    return c


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    return round(float(v), 9) if isinstance(v, Decimal) else v


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    df = registry.queries()[name](spark, DATA)
    cursor = duck.execute(registry.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(names)
    want = sorted((tuple(plain(r[names.index(c)]) for c in sorted(names)) for r in cursor.fetchall()), key=repr)
    got = sorted((tuple(plain(r[c]) for c in sorted(names)) for r in df.collect()), key=repr)
    assert got == want


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_other_queries_run(spark, name):
    assert registry.queries()[name](spark, DATA).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
