"""Core queries equal their SQL on the smallest tables."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import compare
from codexloom import queries


@pytest.fixture(scope="module")
def duck(tiny):
    con = duckdb.connect()
    for name in sorted(x[:-8] for x in os.listdir(tiny) if x.endswith(".parquet")):
        con.execute(f"create view {name} as select * from '{tiny}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, duck, tiny, name):
    df = queries.queries()[name](spark, tiny)
    cols = sorted(df.columns)
    cursor = duck.execute(queries.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == cols
    order = [names.index(c) for c in cols]
    mine = sorted(repr(tuple(compare.plain(r[c]) for c in cols)) for r in df.collect())
    assert mine == sorted(repr(tuple(compare.plain(r[i]) for i in order)) for r in cursor.fetchall())


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns == ["document_id", "stage"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
