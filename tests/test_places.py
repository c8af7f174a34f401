"""Cells of one place share its pairs: as many rows are joined as there are places, and all cells get SQL's results."""

import math
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from isoreach.operators import sampling as P
from isoreach.operators import spatial as J
from isoreach.plans.domain import load
from isoreach.plans.queries import REGISTRY

SF = "/root/testdata/sf0.001"
QUERIES = [
    "a12_cross_modal_reach",
    "a7_cross_modal_below",
    "c10_logsum_pairs",
    "c18_network_free_cost",
    "a11_reach_classes",
    "a11_reach_median",
    "a13_people_within",
    "a14_transit_access",
    "a2_nearest_k",
    "a3_scaled_nearest_k",
    "a1_cumulative_opportunities",
    "a4_gravity",
    "a5_utility_logsum",
    "a6_cross_modal_above",
    "j13_density",
]


@pytest.fixture(scope="module")
def crowded(tmp_path_factory):
    """Each customer's place three times, and one key that has two rows."""
    out = tmp_path_factory.mktemp("crowded")
    for f in os.listdir(SF):
        os.symlink(f"{SF}/{f}", out / f) if f != "customer.parquet" else None
    many = f"select c.* replace (c_custkey + 1000 * i as c_custkey) from '{SF}/customer.parquet' c, range(3) r(i)"
    duckdb.execute(f"copy ({many} union all select * from '{SF}/customer.parquet' where c_custkey = 7) to '{out}/customer.parquet'")
    return str(out)


@pytest.mark.parametrize("name", QUERIES)
def test_pairs_are_made_once_a_place(spark, crowded, monkeypatch, name):
    joined, plain = [], J.within_radius
    monkeypatch.setattr(J, "within_radius", lambda left, *a, **k: joined.append(left.count()) or plain(left, *a, **k))
    make, sql = REGISTRY[name]
    got = make(spark, crowded)
    columns = sorted(got.columns)
    con = duckdb.connect()
    for t in ("customer", "supplier"):
        con.execute(f"create view {t} as select * from '{crowded}/{t}.parquet'")
    want = con.sql(sql).to_arrow_table().to_pylist()
    rows = [sorted((tuple(r[c] for c in columns) for r in x), key=str) for x in ([r.asDict() for r in got.collect()], want)]
    assert len(rows[0]) == len(rows[1])
    for a, b in zip(*rows, strict=True):
        assert all(x == y or math.isclose(x, y, abs_tol=2e-6) for x, y in zip(a, b, strict=True))
    assert joined and max(joined) <= duckdb.execute(f"select count(*) from '{SF}/customer.parquet'").fetchone()[0] + 2


def test_the_sample_draws_for_each_cell_of_a_place_from_shared_pairs(spark, crowded, monkeypatch):
    joined, plain = [], J.within_radius
    monkeypatch.setattr(J, "within_radius", lambda left, *a, **k: joined.append(left.count()) or plain(left, *a, **k))
    got = {(r.cell_id, r.dest_id): r.times for r in REGISTRY["x2_destination_sample"][0](spark, crowded).collect()}
    assert max(joined) <= duckdb.execute(f"select count(*) from '{SF}/customer.parquet'").fetchone()[0] + 2
    c, d = load(spark, crowded, "cells").select("cell_id", "x", "y"), load(spark, crowded, "dests").select("dest_id", "dx", "dy", "weight")
    near = plain(c, d, 300.0).withColumn("bin", F.floor(F.col("dist") / 100).cast("int"))
    alone = P.nested_sample(near, "cell_id", "dest_id", "bin", "weight", {0: 0.5, 1: 0.3, 2: 0.2}, 20, 3)
    assert got and got == {(r.cell_id, r.dest_id): r.times for r in alone.collect()}
