import pytest
from pyspark.sql import functions as F

from isoreach.functions import codebooks
from isoreach.operators import estimators, metrics, sampling
from isoreach.plans import orchestrate as Q
from isoreach.sources import catalog as K
from isoreach.sources import formats


@pytest.fixture
def project(spark, tmp_path):
    return K.Catalog(spark, f"file://{tmp_path}/base")


OD = "orig_id long, dest_id long, value double"


def test_matrix_round_trip(spark, project):
    project.write_od({"c2c": spark.createDataFrame([(1, 2, 1.5)], OD), "z2z": spark.createDataFrame([(7, 8, 2.5)], OD)}, "t")
    od = project.read_od("t")
    assert dict(od.dtypes)["value"] == "float" and dict(od.dtypes)["orig_id"] == "bigint"
    assert project.read_od("t", "c2z") is None and project.read_od("t", "z2z").count() == 1
    nodes = spark.createDataFrame([(1,), (7,)], "node_id long")
    project.check_od_nodes("t", nodes)
    with pytest.raises(K.CatalogError, match="isn't in the network"):
        project.check_od_nodes("t", nodes, destinations=True)
    for bad in ({}, {"c2c": spark.createDataFrame([], OD)}):
        with pytest.raises(K.CatalogError):
            project.write_od(bad, "none")


def test_keys_are_checked(spark, project):
    with pytest.raises(K.CatalogError, match="isn't unique"):
        project.write_properties(spark.createDataFrame([(1,), (1,)], "cell_id long"), "cells", "x")
    with pytest.raises(K.CatalogError, match="floating"):
        K.check_key(spark.createDataFrame([(1.0,)], "cell_id double"), "cell_id")
    with pytest.raises(K.CatalogError):
        project.source("other").write(spark.range(1), "a", "b")


def test_layers(spark, project):
    a = spark.createDataFrame([(1, 1.0, "x"), (2, 2.0, "y")], "cell_id long, v double, w string")
    b = spark.createDataFrame([(2, None), (1, 9.0)], "cell_id long, v double")
    project.write_properties(a, "cells", "a")
    project.write_properties(b, "cells", "b")
    assert {r.cell_id: (r.v, r.w) for r in project.read_properties("cells", "a", "b").collect()} == {1: (9.0, "x"), 2: (None, "y")}
    with pytest.raises(K.CatalogError):
        K.layered([a, b.where("cell_id = 1")], "cell_id")


COEFS = "param string, profile string, stat string, value double"


def test_coefficient_sources(spark, tmp_path):
    catalogs = {s: K.Catalog(spark, f"file://{tmp_path}/{s}") for s in "ab"}
    declared = {"a": {"c": Q.Calibrate(), "h": Q.HandWritten()}, "b": {"c": Q.ImportFrom("a")}}
    made = spark.createDataFrame([("const", "car", "coef", 1.23456)], COEFS)
    assert Q.resolve_coefs(catalogs, declared, "a", "c", lambda: made).first().value == 1.2346

    def never():
        raise AssertionError

    assert Q.resolve_coefs(catalogs, declared, "b", "c", never).first().value == 1.2346
    with pytest.raises(Exception):  # noqa: B017
        Q.resolve_coefs(catalogs, declared, "a", "h", never)
    with pytest.raises(Q.PlanError):
        Q.resolve_coefs(catalogs, declared, "b", "h", never)
    assert K.parse_coefs("param,car,\n,coef,p\nconst,1.5,0.01\n") == [("const", "car", "coef", 1.5), ("const", "car", "p", 0.01)]
    assert K.parse_coefs("param,car,bike\nconst,1,2\n") == [("const", "car", "coef", 1.0), ("const", "bike", "coef", 2.0)]
    assert K.parse_result_name("cells_access_time_gravity_car") == ("time", "gravity", "car")


def test_plans():
    ran = []
    plan = Q.Plan("p", [Q.Stage("a", lambda v=None: ran.append(v), ("x_${area}",)), Q.Stage("b", lambda: ran.append("b"))])
    plan.run(area="zh")
    assert ran == ["x_zh", "b"]
    assert [s.name for s in plan.select(start_from="b")] == ["b"] and [s.name for s in plan.select(skip=("a",))] == ["b"]
    for bad in (lambda: plan.run(), lambda: plan.select(only="z"), lambda: plan.select(only="a", start_from="b"), lambda: Q.Plan("p", [plan.stages[0]] * 2), lambda: Q.Plan("q", [plan.stages[1]]).run(area="zh")):
        with pytest.raises(Q.PlanError):
            bad()
    v = Q.Variants(("a", "b"))
    v.add(a=1, b=2)
    assert v.get("first")[0]["name"] == "1_2" and v.get(0) == v.get("all")
    with pytest.raises(Q.PlanError):
        v.add(a=1)
    for bad in (dict(name="g", cost="x"), dict(name="g", cost="util", bin_edges=(0, 1)), dict(name="g", cost="time_gross", bin_edges=(5, 1))):
        with pytest.raises(Q.PlanError):
            Q.Grid(**bad)
    assert Q.residual_coefs({"a", "b"}, {"a"}, set(), {"b"}) == set() and Q.stars(0.004) == "**" and Q.nearest_year([2010, 2020], 2015) == 2010


def test_formats(spark, tmp_path):
    p = tmp_path / "m.mtx"
    p.write_text("$O;D3\n* \n0 24\n* factor\n2.0\n*\n*\n*\n 1 2 10.5\n 1 9 1\n 2 1 800\n* Netzobjektnamen\n$NAMES\n1 \"A\"\n")
    zones = spark.createDataFrame([(1, "ZD1"), (2, "ZD2")], "zone_no long, zone_id string")
    got = {(r.orig_id, r.dest_id): r.value for r in formats.clean_times(formats.read_matrix_text(spark, f"file://{p}"), zones).collect()}
    assert got == {("ZD1", "ZD2"): 21 * 60, ("ZD2", "ZD1"): None}
    with pytest.raises(ValueError):
        formats.read_any(spark, "x.gpkg")
    t = formats.sum_columns(spark.createDataFrame([(1, None, 3)], "a int, b int, c int"), {"s": ["a", "b", "c", "missing"]})
    assert t.first().s == 4.0
    books = codebooks.code_table(spark)
    raw = spark.createDataFrame([(1994, 9), (2015, 9), (2021, 77), (2021, -98)], "year int, mode int")
    assert [r.mode_cat for r in codebooks.decode(raw, books, ["mode"]).orderBy("year", "mode").collect()] == [None, "train", None, None]
    assert [tuple(r) for r in codebooks.unlisted(raw, books, "mode").collect()] == [(2021, 77, 1)]


def test_metric_invariants(spark):
    rows = spark.createDataFrame([(o, d, float((o * 7 + d * 13) % 50), float(1 + (o + d) % 4)) for o in range(5) for d in range(30)], "o int, d int, cost double, weight double")
    k = metrics.nearest_k(rows, "o", "d", [1, 5, 20, 1000]).collect()
    assert all(r.w_1 <= r.w_5 <= r.w_20 and r.w_1000 is None for r in k)
    g = metrics.gravity(rows, "o", {"a": 0.01, "b": 0.1}).collect()
    assert all(r.w_a >= r.w_b for r in g)
    bins = metrics.cumulative(rows, "o", [(0.0, 10.0), (10.0, 60.0)]).collect()
    total = {r.o: r.s for r in rows.groupBy("o").agg(F.sum("weight").alias("s")).collect()}
    assert all(r.w_0_10 + r.w_10_60 == total[r.o] for r in bins)
    one = metrics.utility_logsum(rows, "o", 1.0).withColumn("mode", F.lit(1))
    two = one.unionByName(metrics.utility_logsum(rows.withColumn("cost", F.col("cost") + 1), "o", 1.0).withColumn("mode", F.lit(2)))
    above = {r.o: r.logsum_all for r in metrics.cross_modal(two, "o").collect()}
    both = rows.withColumn("cost", -F.log(F.exp(-F.col("cost")) + F.exp(-F.col("cost") - 1)))
    assert above == pytest.approx({r.o: r.logsum for r in metrics.utility_logsum(both, "o", 1.0).collect()})  # equal at a rate of one
    shuffled = rows.repartition(7).orderBy(F.rand(1))
    assert sorted(metrics.nearest_k(shuffled, "o", "d", [5]).collect()) == sorted(metrics.nearest_k(rows, "o", "d", [5]).collect())


def test_estimators_recover_their_models(spark):
    import numpy as np

    r = np.random.default_rng(6)
    x = r.uniform(0, 2, 4000)
    frame = lambda **cols: spark.createDataFrame(list(zip(*(c.tolist() for c in cols.values()), strict=True)), ", ".join(f"{k} {'double' if c.dtype.kind == 'f' else 'string'}" for k, c in cols.items()))
    y = 3 + 2 * x + r.standard_normal(4000) * 0.1
    fit = estimators.ols(frame(x=x, y=y), "y", ["x"])
    assert fit["x"] == pytest.approx(2, abs=0.02) and fit["const"] == pytest.approx(3, abs=0.02) and fit["residual_sd"] == pytest.approx(0.1, abs=0.01)
    spoiled = np.where(r.uniform(size=4000) < 0.1, y + 100, y)
    assert estimators.median_regression(frame(x=x, y=spoiled), "y", ["x"])["x"] == pytest.approx(2, abs=0.1)
    assert estimators.huber(frame(x=x, y=spoiled), "y", ["x"], scale=0.1)["x"] == pytest.approx(2, abs=0.3)
    counts = r.poisson(np.exp(0.5 + 0.7 * x)).astype(float)
    assert estimators.poisson(frame(x=x, n=counts), "n", ["x"])["x"] == pytest.approx(0.7, abs=0.05)
    assert estimators.interval_em(frame(x=x, lo=np.floor(y), hi=np.floor(y) + 1), "lo", "hi", ["x"], rounds=30)["x"] == pytest.approx(2, abs=0.05)
    bus = r.uniform(0, 2, 4000)
    choice = np.where(0.8 - 1.5 * x + r.gumbel(size=4000) > -1.5 * bus + r.gumbel(size=4000), "car", "bus")
    logit = estimators.multinomial_logit(frame(x=x, b=bus, c=choice), "c", {"car": {"asc": "1", "time": "x"}, "bus": {"time": "b"}})
    assert logit["asc"] == pytest.approx(0.8, abs=0.15) and logit["time"] == pytest.approx(-1.5, abs=0.15) and logit["ll"] > logit["ll_null"] and 0 < logit["time_se"] < 0.1


def test_samples_are_reproducible(spark):
    rows = spark.createDataFrame([(k, float(k % 5)) for k in range(100)], "k long, w double")
    assert sorted(sampling.simple_sample(rows, "k", 10, 1).collect()) == sorted(sampling.simple_sample(rows.repartition(5), "k", 10, 1).collect())
    draws = {r.k: r.times for r in sampling.weighted_with_replacement(rows, "k", "w", 2000, 3).collect()}
    assert sum(draws.values()) == 2000 and all(k % 5 for k in draws)
    assert 2.5 < sum(n for k, n in draws.items() if k % 5 == 4) / sum(n for k, n in draws.items() if k % 5 == 1) < 6


def test_streams_equal_tables(spark, tmp_path):
    from isoreach.streaming import windows

    path = "/root/testdata/sf0.001/events.parquet"
    table = spark.read.parquet(path)
    (tmp_path / "in").mkdir()
    table.coalesce(1).write.mode("overwrite").parquet(f"file://{tmp_path}/in")
    typed = spark.read.parquet(f"file://{tmp_path}/in")
    stream = windows.read_events(spark, f"file://{tmp_path}/in", typed.schema).withColumn("ts", F.col("ts").cast("timestamp"))
    q = windows.tumbling(stream, "ts", "value").writeStream.outputMode("complete").format("memory").queryName("tumbling_out").option("checkpointLocation", f"file://{tmp_path}/cp").start()
    q.processAllAvailable()
    q.stop()
    got = sorted((r.start, r.n) for r in spark.table("tumbling_out").collect())
    want = sorted((r.start, r.n) for r in windows.tumbling(table.withColumn("ts", F.col("ts").cast("timestamp")), "ts", "value").collect())
    assert got == want and got
