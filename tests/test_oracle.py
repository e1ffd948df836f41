"""Every registered query of the engine on the smallest tables, against its SQL in DuckDB."""

import datetime
import os

import duckdb
import pytest

from tidemark.plans import registry

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="tables are not here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in os.listdir(DATA):
        connection.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{name}'")
    return connection


def plain(v):
    if isinstance(v, float):
        return "nan" if v != v else repr(round(v, 6) + 0.0)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return None if v is None else str(v)


@pytest.mark.parametrize("name", registry.QUERIES)
def test_query(spark, duck, name):
    df = registry.QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    if name not in registry.ORACLE:
        assert got
        return
    answer = duck.execute(registry.ORACLE[name])
    names = [d[0] for d in answer.description]
    assert sorted(names) == columns
    want = sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in answer.fetchall()), key=repr)
    assert got == want


def test_flagship(spark):
    rows = registry.flagship(spark, DATA).collect()
    assert len(rows) == 8 and any(r.n_flags for r in rows)
