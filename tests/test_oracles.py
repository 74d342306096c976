"""Every registered query with SQL gives the rows that DuckDB gives."""

import math
import os

import duckdb
import pytest

from tessera import catalog

QUERIES, SQL = catalog.queries(), catalog.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    con = duckdb.connect()
    con.execute("set TimeZone='UTC'")
    for f in os.listdir(sf_dir):
        if f.endswith(".parquet"):
            con.execute(f"create view {f[:-8]} as select * from '{sf_dir}/{f}'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9) + 0.0
    if hasattr(v, "asDict") or isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    ours = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=str)
    if name not in SQL:
        assert ours
        return
    result = con.execute(SQL[name])
    names = [x[0] for x in result.description]
    assert sorted(names) == columns
    theirs = sorted((tuple(plain(row[names.index(c)]) for c in columns) for row in result.fetchall()), key=str)
    assert ours == theirs
