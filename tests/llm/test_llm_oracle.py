"""Queries with SQL counterparts equal them, value by value."""

from collections import Counter

import duckdb
import pytest

from fundlens.llm.oracle import ORACLE
from fundlens.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(ORACLE))
def test_matches_duckdb(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    cursor = con.execute(ORACLE[name])
    columns = [c[0] for c in cursor.description]
    order = sorted(columns)
    want = Counter(tuple(repr(r[columns.index(c)]) for c in order) for r in cursor.fetchall())
    df = QUERIES[name](spark, SF)
    assert sorted(df.columns) == order
    got = Counter(tuple(repr(r[c]) for c in order) for r in df.collect())
    assert got == want
