import os

import pytest

import __spark_entry__ as entry

duckdb = pytest.importorskip("duckdb")


def plain(v):
    if isinstance(v, float):
        return round(v, 5) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return v if v is None or isinstance(v, (int, str, bool)) else str(v)


@pytest.fixture(scope="module")
def db(data):
    c = duckdb.connect()
    for f in os.listdir(data):
        c.sql(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{data}/{f}'")
    return c


def test_entry_has_rows_and_names_match(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, data, db, name):
    df = entry.queries()[name](spark, data)
    cols = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=str)
    rel = db.sql(entry.oracle_sql()[name])
    at = [rel.columns.index(c) for c in cols]
    want = sorted((tuple(plain(r[i]) for i in at) for r in rel.fetchall()), key=str)
    assert sorted(rel.columns) == cols and got == want
