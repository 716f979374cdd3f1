"""Every registered query against its SQL on DuckDB, over whole tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from rollbook.registered import QUERIES, SQL

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def con(data):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    return v


def table_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return [names[i] for i in order], sorted(out, key=lambda r: [(x is None, str(x)) for x in r])


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, data, name):
    df = entry.queries()[name](spark, data)
    got = table_of(df.columns, df.collect())
    result = con.execute(entry.oracle_sql()[name])
    assert got == table_of([d[0] for d in result.description], result.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_all_queries_have_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())
