"""Every registered query with SQL must give DuckDB's rows on the smallest tables; test_plain_results has the others."""

import datetime
import math

import duckdb
import pytest

from isoreach.plans.queries import REGISTRY

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(k for k, (_, sql) in REGISTRY.items() if sql))
def test_query_equals_sql(spark, duck, name):
    make, sql = REGISTRY[name]
    df = make(spark, SF)
    columns = sorted(df.columns)
    got = sorted(str(tuple(plain(r[c]) for c in columns)) for r in df.collect())
    table = duck.sql(sql).to_arrow_table()
    assert sorted(table.column_names) == columns
    assert got == sorted(str(tuple(plain(r[c]) for c in columns)) for r in table.to_pylist())


def test_entry_points():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(REGISTRY) <= set(entry.queries())
