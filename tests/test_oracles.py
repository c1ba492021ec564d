"""Every registered query with SQL against DuckDB at the smallest scale."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SQL = {k: v for k, v in entry.oracle_sql().items() if not k.startswith("op")}
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, (bool, int, float)):
        return v
    return str(v)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    cursor = duck.execute(SQL[name])
    theirs = [d[0] for d in cursor.description]
    assert sorted(theirs) == cols
    key = lambda r: tuple((x is None, str(x)) for x in r)
    ours = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=key)
    expected = sorted((tuple(plain(r[theirs.index(c)]) for c in cols) for r in cursor.fetchall()), key=key)
    assert ours == expected


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql()) - {n for n in entry.queries() if n.startswith("op") or n == "pipeline"}))
def test_rows_only_queries_run(spark, name):
    assert entry.queries()[name](spark, SF).count() > 0


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
