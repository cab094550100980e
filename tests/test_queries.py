"""Every query of the core against its SQL in DuckDB, on the smallest tables."""

from __future__ import annotations

import os
from collections import Counter
from pathlib import Path

import pytest

from stenograph.plans import registry

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables are missing")


def normal(value):
    if isinstance(value, float):
        return float(f"{value:.7g}")
    if isinstance(value, (list, tuple)):
        return tuple(map(normal, value))
    return value


@pytest.fixture(scope="module")
def duck():
    import duckdb

    c = duckdb.connect()
    for p in Path(FOLDER).iterdir():
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return c


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, duck, name):
    df = registry.queries()[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = Counter(repr([normal(r[c]) for c in columns]) for r in df.collect())
    sql = registry.oracle_sql().get(name)
    if sql:
        cursor = duck.execute(sql)
        names = [d[0] for d in cursor.description]
        assert sorted(names) == columns
        want = Counter(repr([normal(r[names.index(c)]) for c in columns]) for r in cursor.fetchall())
        assert got == want
