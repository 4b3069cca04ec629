"""Every query with SQL of its own gives what DuckDB gives on the same tables."""

import glob
import os

import pytest

import __spark_entry__ as entry
from quillfold.plans import more, rest  # noqa: F401
from quillfold.plans.queries import query

SF = "/root/testdata/sf0.001"
duckdb = pytest.importorskip("duckdb")


def plain(v):
    if isinstance(v, float):
        return round(v, 6) + 0.0
    return tuple(map(plain, v)) if isinstance(v, list) else v


def table(rows, columns):
    return sorted((tuple(plain(r[c]) for c in columns) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"create view {os.path.basename(p)[:-8]} as select * from read_parquet('{p}')")
    return c


@pytest.mark.parametrize("name", sorted(query.queries))
def test_query(spark, duck, name):
    df = query.queries[name](spark, SF)
    columns = sorted(df.columns)
    rows = [r.asDict() for r in df.collect()]
    if name not in query.sql:
        assert rows
        return
    cursor = duck.execute(query.sql[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    assert table(rows, columns) == table([dict(zip(names, r, strict=True)) for r in cursor.fetchall()], columns)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(query.queries) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
