"""Every query with SQL gives what DuckDB gives on the same tables."""

from __future__ import annotations

import os
from decimal import Decimal

import duckdb
import pytest

from tidemark.plans import catalog

SF = os.environ.get("TIDEMARK_SF", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    return round(v, 6) if isinstance(v, float) else str(v) if isinstance(v, Decimal) else v


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(repr([plain(r[c]) for c in columns]) for r in df.collect())
    rel = duck.sql(catalog.ORACLES[name])
    assert sorted(rel.columns) == columns
    at = [rel.columns.index(c) for c in columns]
    assert got == sorted(repr([plain(r[i]) for i in at]) for r in rel.fetchall())
