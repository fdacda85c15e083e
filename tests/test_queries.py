"""Each query with SQL of its own against DuckDB, over the smallest tables."""

import math
import os

import duckdb
import pytest

from tallyforge.plans import queries

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def other():
    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{f}'")
    return con


def _plain(rows, columns):
    def value(v):
        if isinstance(v, float):
            return None if math.isnan(v) else f"{v:.5g}"
        return str(v) if v is not None else None

    return sorted(tuple(str(value(r[c])) for c in sorted(columns)) for r in rows)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="the driver's tables aren't here")
@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query(spark, other, name):
    df = queries.QUERIES[name](spark, DATA)
    theirs = other.sql(queries.SQL[name])
    columns = theirs.columns
    assert sorted(df.columns) == sorted(columns)
    assert _plain([r.asDict() for r in df.collect()], columns) == _plain([dict(zip(columns, r)) for r in theirs.fetchall()], columns)
