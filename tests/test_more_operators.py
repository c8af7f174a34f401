"""Temporal joins, unbounded searches, draws, polygons, overlays and sources, against plain Python."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from isoreach.operators import estimators as E
from isoreach.operators import graph as N
from isoreach.operators import routing as R
from isoreach.operators import sampling as P
from isoreach.operators import selection as L
from isoreach.operators import spatial as J
from isoreach.operators import survey as Y
from isoreach.operators import temporal as T
from isoreach.sources import formats as S
from isoreach.sources import store


def test_the_unbounded_search_loses_no_row(spark):
    a = spark.createDataFrame([(1, 0.0, 0.0), (2, 50_001.0, 0.0), (3, None, 1.0), (4, 3.0, 0.0), (5, -2e6, 7.0)], "a long, x double, y double")
    b = spark.createDataFrame([(7, 0.0, 1.0), (8, 0.0, -1.0), (9, 5.0, 0.0)], "b long, dx double, dy double")
    got = {r.a: (r.b, r.dist) for r in J.nearest_unbounded(a, "a", b, "b", 1.0).collect()}
    assert got[1] == (7, 1.0) and got[2] == (9, 49_996.0) and got[3] == (None, None) and got[4] == (9, 2.0) and got[5][0] == 7
    assert [r.b for r in J.nearest_unbounded(a, "a", b.limit(0), "b", 1.0).collect()] == [None] * 5
    assert J.nearest_unbounded(a.limit(0), "a", b, "b", 1.0).collect() == []


def test_the_unbounded_search_equals_brute_force(spark):
    r = np.random.default_rng(2)
    left = [(k, float(x), float(y)) for k, (x, y) in enumerate(r.uniform(0, 1000, (60, 2)) ** 1.5)]
    right = [(k, float(x), float(y)) for k, (x, y) in enumerate(r.uniform(0, 300, (20, 2)))]
    got = {x.a: x.b for x in J.nearest_unbounded(spark.createDataFrame(left, "a long, x double, y double"), "a", spark.createDataFrame(right, "b long, dx double, dy double"), "b", 0.5).collect()}
    assert got == {a: min(right, key=lambda p: (np.hypot(p[1] - x, p[2] - y), p[0]))[0] for a, x, y in left}


def test_large_polygons_are_filed_under_few_cells(spark):
    pts = spark.range(200).select("id", (F.col("id") * 4973 % 100_000).cast("double").alias("x"), (F.col("id") * 7919 % 100_000).cast("double").alias("y"))
    country = [(0.0, 0.0), (90_000.0, 0.0), (90_000.0, 50_000.0), (0.0, 90_000.0)]
    house = [(4973.0, 7900.0), (4990.0, 7900.0), (4990.0, 7930.0), (4973.0, 7930.0)]
    rings = spark.createDataFrame([(1, country), (2, house)], "k long, ring array<struct<x:double,y:double>>")
    got = {(r.id, r.k) for r in J.points_in_polygons(pts, rings, cell=10.0).collect()}
    inside = {(p.id, 1) for p in pts.collect() if 0 <= p.x < 90_000 and 0 <= p.y < 90_000 - 40_000 * p.x / 90_000}
    assert {g for g in got if g[1] == 1} == inside and (1, 2) in got
    assert J.points_in_polygons(pts, rings.limit(0)).collect() == []


def test_draws_with_replacement_follow_the_weights(spark):
    rows = spark.createDataFrame([(k, 1.0 + (k == 3) * 300.0) for k in range(100)] + [(200, 0.0), (201, None)], "k long, w double")
    got = {r.k: r.times for r in P.weighted_with_replacement(rows, "k", "w", 20_000, 5).collect()}
    assert sum(got.values()) == 20_000 and 0.72 < got[3] / 20_000 < 0.78 and not {200, 201} & set(got)


def test_as_of_equals_brute_force(spark):
    r = random.Random(4)
    left = [(k, r.choice(["hot", "hot", "hot", "b", None]), r.choice([None, *range(0, 500_000, 997)])) for k in range(300)]
    right = [(r.choice(["hot", "b", "c", None]), r.choice([None, *range(0, 500_000, 1994)]), k) for k in range(120)]
    time = F.timestamp_seconds("t").alias("t")
    a = spark.createDataFrame(left, "id long, k string, t long").select("id", "k", time)
    b = spark.createDataFrame(right, "k string, t long, v long").select("k", time.alias("rt"), "v")
    for tolerance in (None, 40_000.0):
        got = {x.id: x.v for x in T.as_of(a, b, "k", "t", "rt", ["v"], width=3600.0 * 7, tolerance=tolerance).collect()}
        want = {}
        for i, k, t in left:
            seen = [(rt, v) for rk, rt, v in right if k is not None and t is not None and rk == k and rt is not None and rt <= t]
            best = max(seen, default=(None, None))
            want[i] = None if best[0] is None or (tolerance and t - best[0] > tolerance) else best[1]
        assert got == want


def test_intervals_equal_brute_force(spark):
    r = random.Random(5)
    points = [(k, r.choice("ab"), r.randrange(1000)) for k in range(80)]
    intervals = [(k, r.choice("ab"), s := r.randrange(1000), s + r.randrange(-5, 300)) for k in range(40)]
    ts = lambda c: F.timestamp_seconds(c).alias(c)
    p = spark.createDataFrame(points, "p long, k string, t long").select("p", "k", ts("t"))
    i = spark.createDataFrame(intervals, "i long, k string, a long, b long").select("i", "k", ts("a"), ts("b"))
    got = {(x.p, x.i) for x in T.within_intervals(p, i, "k", "t", "a", "b", 50.0).collect()}
    assert got == {(q, j) for q, k, t in points for j, kk, a, b in intervals if k == kk and a <= t < b}


def test_codes_are_dense_in_order_of_appearance(spark):
    rows = spark.createDataFrame([(k, None if k % 11 == 0 else f"v{k * 7 % 23}") for k in range(200)], "t long, v string").repartition(5)
    got = {r.t: r.code for r in Y.first_seen_codes(rows, "v", "t", "code").collect()}
    codes = {}
    for t in range(200):
        v = None if t % 11 == 0 else f"v{t * 7 % 23}"
        assert got[t] == (-1 if v is None else codes.setdefault(v, len(codes)))


def test_masks_treat_null_as_false(spark):
    df = spark.createDataFrame([(1, True, 2.0), (2, None, 2.0), (3, True, None), (4, True, float("nan"))], "k long, a boolean, v double")
    assert [r.k for r in df.where(L.calibration_mask(F.col("a"), F.col("k"), F.lit(1), [F.col("v")])).collect()] == [1]
    assert [r.k for r in df.where(L.any_of([F.col("a"), F.col("v") < 1], [F.col("k") == 2])).collect()] == [2]
    assert [r.k for r in df.where(L.cost_mask(F.lit("car"), "car", [F.col("a")], F.col("v"), F.lit(1), 1, 5)).collect()] == [1]


def test_overlays_and_shapes(spark):
    e = spark.createDataFrame([(1, 5.0), (2, None), (3, 7.0)], "k long, v double")
    layer = lambda *rows: spark.createDataFrame(list(rows), "k long, v double")
    got = {r.k: r.v for r in L.overlaid(e, "k", [layer((1, 1.0), (2, 2.0)), layer((1, 9.0), (2, None))], "v").collect()}
    assert got == {1: 9.0, 2: 2.0, 3: 7.0}
    assert L.shapes(e.withColumn("g", F.lit("x")), "k", "g", ("v",)).columns == ["k", "v", "g"]
    with pytest.raises(ValueError):
        L.shapes(e, "k", "geometry", ())
    with pytest.raises(ValueError):
        L.over_modes(e, ["k"], "v", "median")
    assert L.batches_of(list(range(7)), 3) == [[0, 1, 2], [3, 4, 5], [6]] and L.metric_name("shops", 30.0) == "shops_30" and L.metric_name("jobs", 0.25) == "jobs_0.25"


def test_bounds_of_least_squares(spark):
    r = np.random.default_rng(3)
    rows = [(float(a), float(b), float(1 + 2 * a - b + e)) for a, b, e in r.normal(size=(300, 3))]
    table = spark.createDataFrame(rows, "a double, b double, y double")
    free, bound = E.bounded_ols(table, "y", ["a", "b"]), E.bounded_ols(table, "y", ["a", "b"], lower={"b": 0.0}, upper={"a": 1.5})
    assert free["b"] == pytest.approx(E.ols(table, "y", ["a", "b"])["b"]) and bound["b"] == 0.0 and bound["a"] == 1.5 and bound["r2"] < free["r2"]


def test_paths_stop_at_the_cutoff(spark):
    edges = spark.createDataFrame([(k, k + 1, 1.0) for k in range(50)], "u long, v long, w double")
    trips = spark.createDataFrame([(1, 0, 10), (2, 0, 40), (3, 0, 0), (4, 0, 999)], "trip_id long, origin long, dest long")
    got = {r.trip_id: r.n_edges for r in R.path_metrics(R.paths(spark, edges, trips, cutoff=20.0), {}).collect()}
    assert got == {1: 10}
    with pytest.raises(ValueError):
        R.path_metrics(R.paths(spark, edges, trips), {"w": "squared"})


def test_sources(spark, tmp_path):
    path = tmp_path / "matrix.mtx"
    path.write_text("$O;D3\n* from to\n0.00 24.00\n* factor\n1.00\n* data\n1 2 3.5\n1 3 1e-3\n2 2 2E+1\n")
    assert {(r.orig, r.dest): r.value for r in S.read_matrix_text(spark, str(path)).collect()} == {(1, 2): 3.5, (1, 3): 0.001, (2, 2): 20.0}
    ways = spark.createDataFrame([(1, {"highway": "path", "name": "x", "mtb:scale": "1"}, [1, 2]), (2, {"building": "yes"}, [1, 2, 3]), (3, {"highway": "road"}, [1])], "id long, tags map<string,string>, nodes array<long>")
    routes = spark.createDataFrame([({"route": "mtb"}, [1, 9])], "tags map<string,string>, members array<long>")
    (way,) = S.highway_ways(ways, routes).collect()
    assert way.tags == {"highway": "path", "mtb:scale": "1", "mtb_route": "yes"}
    lake = spark.createDataFrame([(1, [(0.0, 0.0, 9.0), (5.0, 0.5, 9.0), (10.0, 0.0, 9.0), (10.0, 10.0, 9.0), (0.0, 0.0, 9.0)])], "k long, ring array<struct<x:double,y:double,z:double>>")
    assert [(p.x, p.y) for p in S.lakes(lake).first().ring] == [(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 0.0)]
    tiles = spark.createDataFrame([(0, 1, 1, 5.0), (1, 1, 1, 2.0), (0, 9, 9, 1.0)], "tile int, col int, row int, value double")
    assert [tuple(r) for r in S.mosaic(tiles, (0, 0, 5, 5)).collect()] == [(1, 1, 2.0)]


def test_loops_leave_no_tables_behind(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(store, "shared_dir", lambda s: f"file://{tmp_path}")
    edges = spark.createDataFrame([(k, k + 1) for k in range(12)], "u long, v long")
    assert R.relax(spark, edges.withColumn("w", F.lit(1.0)), spark.createDataFrame([(0,)], "origin long"), 5.0).count() == 6
    assert N.reachable(spark, edges, 0).count() == 13
    assert len(list(tmp_path.iterdir())) <= 5  # results, the edges and the last frontiers
