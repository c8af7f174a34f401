import pytest
from pyspark.sql import functions as F

from isoreach.operators import geometry as G
from isoreach.operators import spatial as J
from isoreach.operators import stats as V
from isoreach.operators import validation as X

LINE = "k long, p array<struct<x:double,y:double>>"


def test_areas_centroids_and_lengths(spark):
    square = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0), (0.0, 0.0)]
    df = spark.createDataFrame([(1, square), (2, [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0)]), (3, [(5.0, 6.0)])], LINE)
    c = G.centroid(F.col("p"))
    got = {r[0]: tuple(r)[1:] for r in df.select("k", c["x"], c["y"], G.area(F.col("p")), G.length(F.col("p"))).collect()}
    assert got[1] == pytest.approx((2, 2, 16, 16)) and got[2][:2] == pytest.approx((3, 1)) and got[3][:2] == (5, 6)


def test_simplification(spark):
    line = [(0.0, 0.0), (1.0, 0.05), (2.0, 0.0), (3.0, 5.0), (4.0, 0.0)]
    df = spark.createDataFrame([(1, line)], LINE)
    assert [p.x for p in G.simplify(df, "p", 0.1).first().p] == [0, 2, 3, 4]
    assert len(G.simplify_to(df, "p", 3).first().p) <= 3


def test_clipping_and_difference(spark):
    tri = [(0.0, 0.0), (4.0, 0.0), (0.0, 4.0)]
    df = spark.createDataFrame([(1, tri)], LINE)
    holes = spark.createDataFrame([(1, [(1.0, 1.0), (1.0, 9.0), (9.0, 9.0), (9.0, 1.0)])], "h long, ring array<struct<x:double,y:double>>")
    got = G.difference_area(df, "k", "p", holes.select(F.col("ring").alias("hole")), "hole", 5.0).first()
    assert got.area == pytest.approx(8 - 2)


def test_joins_ignore_null_places_and_empty_tables(spark):
    a = spark.createDataFrame([(1, 0.0, 0.0), (2, None, 0.0)], "a long, x double, y double")
    b = spark.createDataFrame([(7, 3.0, 4.0)], "b long, dx double, dy double")
    assert [(r.a, r.b, r.dist) for r in J.within_radius(a, b, 5.0).collect()] == [(1, 7, 5.0)]
    assert J.within_radius(a, b.limit(0), 5.0).collect() == []
    assert J.nearest(a, "a", b, "b", 4.0).collect() == []


def test_hexagons_tile_the_plane(spark):
    pts = spark.range(400).select((F.col("id") % 20 * 7.0).alias("x"), (F.floor(F.col("id") / 20) * 7.0).alias("y"))
    n = pts.groupBy(G.hexagon(F.col("x"), F.col("y"), 20.0).alias("h")).count()
    assert n.agg(F.sum("count")).first()[0] == 400 and 10 < n.count() < 40


def test_agreement_of_few_rows_is_null(spark):
    rows = spark.createDataFrame([("a", 1.0, 2.0), ("b", 1.0, 1.0), ("b", 3.0, 3.0), ("c", None, 1.0)], "g string, m double, p double")
    got = {r.g: r for r in V.agreement(rows, ["g"], "m", "p").collect()}
    assert got["a"].n == 1 and got["a"].bias is None and got["b"].r2 == 1.0 and got["b"].slope == 1.0 and "c" not in got


def test_savgol_keeps_a_parabola(spark):
    rows = spark.createDataFrame([("g", k, float(k * k)) for k in range(9)] + [("g", 20, 1.0), ("g", 21, 5.0)], "g string, b int, v double")
    got = {r.b: r.s for r in V.savgol5(rows, "g", "b", "v", "s").collect()}
    assert all(got[k] == pytest.approx(k * k) for k in range(9)) and got[20] == 1.0 and got[21] == 5.0


def test_snapping_and_projection(spark):
    edges = spark.createDataFrame([(1, 0.0, 0.0, 100.0, 0.0), (2, 0.0, 5.0, 0.0, 100.0)], "edge_id long, x0 double, y0 double, x1 double, y1 double")
    counters = spark.createDataFrame([(9, 3.0, 4.0, 90.0), (8, 3.0, 50.0, 90.0)], "counter_id long, x double, y double, heading double")
    assert [(r.counter_id, r.edge_id) for r in X.snap_counters(counters, edges, 10.0, 30.0).collect()] == [(9, 1)]
    points = spark.createDataFrame([(1, 2.0, 3.0), (2, 50.0, 3.0)], "k long, x double, y double")
    got = {r.k: (r.node, r.x) for r in X.project_on_edges(points, "k", edges, 10.0, 5.0).where("edge_id = 1").collect()}
    assert got == {1: ("u", 0.0), 2: ("new", 50.0)} or got == {2: ("new", 50.0)}


def test_sidepaths(spark):
    s = "way_id long, x0 double, y0 double, x1 double, y1 double"
    dropped = spark.createDataFrame([(1, 0.0, 8.0, 150.0, 8.0), (2, 0.0, 500.0, 150.0, 500.0)], s)
    kept = spark.createDataFrame([(3, 0.0, 0.0, 150.0, 0.0)], s)
    assert [r.way_id for r in X.alongside(dropped, kept).collect()] == [1]
    label = spark.createDataFrame([(1, 1), (2, 1), (3, 3)], "node_id long, component long")
    ways = spark.createDataFrame([(10, 1, 2), (11, 2, 3), (12, 3, 4)], "way_id long, u long, v long")
    assert {r.way_id for r in X.put_back(ways, label).collect()} == {11, 12}


def test_edge_calibration_finds_the_seconds_of_its_features(spark):
    e = spark.createDataFrame([(k, float(k % 7 + 1), float(k % 3)) for k in range(40)], "trip_id long, a double, b double").withColumn("w", F.col("a"))
    seen = e.select("trip_id", (3 * F.col("a") + 2 * F.col("b") + 5).alias("time"))
    fit = X.calibrate_edges(e, lambda edges: edges.select("trip_id", "a", "b"), seen, ["a", "b"])
    assert fit["a"] == pytest.approx(3) and fit["b"] == pytest.approx(2) and fit["const"] == pytest.approx(5)
