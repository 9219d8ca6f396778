"""Every registered query against its SQL twin on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry_point
from tests.conftest import SF

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def canonical(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(repr(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("key", sorted(entry_point.queries()))
def test_query(spark, sf, duck, key):
    df = entry_point.queries()[key](spark, sf)
    rows = [tuple(r) for r in df.collect()]
    sql = entry_point.oracle_sql().get(key)
    if sql is None:
        assert rows
        return
    cur = duck.execute(sql)
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    assert canonical(rows, df.columns) == canonical(cur.fetchall(), names)


def test_entry(spark):
    assert entry_point.entry(spark).count() == 10
