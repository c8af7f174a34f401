"""Seconds that lie halfway between two rounded values come out as SQL rounds them."""

import duckdb

from isoreach.plans.queries import REGISTRY


def test_halves_are_rounded_as_in_sql(spark, tmp_path):
    duckdb.execute(f"copy (select i as o_orderkey, (6 * i + 3) / 1000.0::double as o_totalprice from range(200000) r(i)) to '{tmp_path}/orders.parquet'")
    make, sql = REGISTRY["c15_derived_profile"]
    con = duckdb.connect()
    con.execute(f"create view orders as select * from '{tmp_path}/orders.parquet'")
    got = {r.edge_id: r.duration for r in make(spark, str(tmp_path)).collect()}
    want = dict(con.execute(f"select edge_id, duration from ({sql})").fetchall())
    assert {k for k in want if got[k] != want[k]} == set() and len(got) == len(want)


def test_a_limit_of_zero_is_no_error(spark, tmp_path):
    duckdb.execute(f"copy (select i - 300 as o_orderkey, (i - 20) * 7.5::double as o_totalprice from range(600) r(i)) to '{tmp_path}/orders.parquet'")
    make, sql = REGISTRY["c15_derived_profile"]
    con = duckdb.connect()
    con.execute(f"create view orders as select * from '{tmp_path}/orders.parquet'")
    got = {r.edge_id: r.duration for r in make(spark, str(tmp_path)).collect()}
    want = dict(con.execute(f"select edge_id, duration from ({sql})").fetchall())
    assert {k: (got[k], want[k]) for k in want if got[k] != want[k]} == {} and len(got) == len(want)
