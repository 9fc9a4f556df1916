"""Registered queries: DuckDB where SQL can say it, on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as E
from mensura.llm import queries

SF = "/root/testdata/sf0.001"
TABLES = "documents benchmark labels conversations pages".split()


def test_every_operator_is_registered_once():
    names = list(E.queries())
    assert "pipeline" in names
    assert [sum(x.startswith(f"op{n}_") for x in names) for n in range(1, 14)] == [1] * 13


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_same_rows_as_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = E.queries()[name](spark, SF)
    cur = con.execute(E.oracle_sql()[name])
    cols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(df.columns)
    order = sorted(cols)
    want = sorted((tuple(r[cols.index(c)] for c in order) for r in cur.fetchall()), key=str)
    assert sorted((tuple(r[c] for c in order) for r in df.collect()), key=str) == want
