"""Every query against its SQL in DuckDB at the smallest scale."""

import math
import os

import pytest

import __spark_entry__ as entry
from tidemark.catalogue import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, (bool, str)):
        return str(v)
    if hasattr(v, "isoformat"):
        return v.isoformat()[:10]
    return float(v) if isinstance(v, (int, float)) or hasattr(v, "as_tuple") else str(v)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted([tuple(plain(r[i]) for i in order) for r in rows], key=repr)


def compare(spark, duck, f, sql):
    made = f(spark, SF)
    want = duck.execute(sql)
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(made.columns)
    assert rows_of(made.columns, made.collect()) == rows_of(names, want.fetchall())


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    compare(spark, duck, QUERIES[name], ORACLE_SQL[name])


def test_entry(spark):
    assert entry.entry(spark).count() == 10
