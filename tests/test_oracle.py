"""Every query equals its DuckDB counterpart: names, types, rows and values."""

import os
from collections import Counter
from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from fundlens.plans.catalog import QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")

# Spark type of a report column -> DuckDB type.
TYPES = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def canonical(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(repr(row[i]) for i in order) for row in rows)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(queries()) and set(QUERIES) <= set(oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_matches_duckdb(spark, duck, name):
    df = queries()[name](spark, SF_DIR)
    expected = duck.execute(oracle_sql()[name])
    columns = [(c[0], str(c[1])) for c in expected.description]
    assert sorted((n, TYPES[t]) for n, t in df.dtypes) == sorted(columns)
    got = canonical([tuple(r) for r in df.collect()], df.columns)
    want = canonical(expected.fetchall(), [c[0] for c in columns])
    assert got
    missing, extra = want - got, got - want
    assert not missing and not extra, f"{len(missing)} missing {list(missing)[:3]}, {len(extra)} extra {list(extra)[:3]}"
