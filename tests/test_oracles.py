"""Every query of the catalog against its DuckDB oracle on the smallest data."""

import decimal
import math

import duckdb
import pytest

from newsflow.plans import catalog

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    return float(v) if isinstance(v, decimal.Decimal) else v


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query(spark, duck, name):
    df, rel = catalog.queries()[name](spark, DIR), duck.sql(catalog.oracle_sql()[name])
    columns = sorted(df.columns)
    assert columns == sorted(rel.columns)
    at = [rel.columns.index(c) for c in columns]
    want = sorted(repr([plain(r[i]) for i in at]) for r in rel.fetchall())
    assert sorted(repr([plain(r[c]) for c in columns]) for r in df.collect()) == want


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(catalog.oracle_sql())))
def test_query_without_sql(spark, name):
    df = catalog.queries()[name](spark, DIR)
    assert df.count() > 0
