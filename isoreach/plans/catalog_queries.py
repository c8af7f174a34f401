"""Queries that go through stored tables, and of operators on merged edges, paths on tiers, samples and coefficients."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from isoreach.functions import survey as S
from isoreach.operators import estimators as E
from isoreach.operators import graph as N
from isoreach.operators import sampling as P
from isoreach.operators import selection as L
from isoreach.operators import survey as Y
from isoreach.operators import validation as X
from isoreach.plans.domain import ctes, load, query
from isoreach.sources.catalog import Catalog
from isoreach.sources.store import shared_dir


def catalog(spark) -> Catalog:
    """A catalog of its own in the shared folder."""
    return Catalog(spark, f"{shared_dir(spark)}/isoreach-catalog-{uuid.uuid4().hex}/own")


@query("s1_k1_properties", ctes("cells") + " select cell_id, x, population, cell_id * 2 as twice from cells_")
def properties(spark, sf):
    c, k = load(spark, sf, "cells"), catalog(spark)
    k.write_properties(c.select("cell_id", "x", F.lit(0).alias("population")), "cells", "place")
    k.write_properties(c.select("cell_id", "population", (F.col("cell_id") * 2).alias("twice")), "cells", "people")
    return k.source("own").read_properties("cells", "place", "people").select("cell_id", "x", "population", "twice")


@query("s2_k2_shapes", ctes("zones") + " select zone_id, region_id, 5 as n_points, x as first_x from zones_")
def shapes(spark, sf):
    z, k = load(spark, sf, "zones"), catalog(spark)
    at = lambda dx, dy: F.struct((F.col("x") + dx).alias("x"), (F.col("y") + dy).alias("y"))
    ring = F.array(at(0, 0), at(180, 0), at(180, 140), at(0, 140), at(0, 0))
    k.write(L.shapes(z.withColumn("ring", ring), "zone_id", "ring", ("region_id",)), "shapes", "zones")
    return k.read("shapes", "zones").select("zone_id", "region_id", F.size("ring").alias("n_points"), F.col("ring")[0]["x"].alias("first_x"))


@query("s3_k3_network", ctes("edges") + ", n as (select u as node_id from edges_ union select v from edges_) select way_id as edge_id, u, v, length, (select count(*) from n)::bigint as n_nodes from edges_")
def network(spark, sf):
    e, k = load(spark, sf, "edges"), catalog(spark)
    edges = e.select(F.col("way_id").alias("edge_id"), "u", "v", "length")
    k.write_network(e.select(F.col("u").alias("node_id")).union(e.select("v")).distinct(), edges, "car")
    nodes, edges = k.read_network("car")
    return edges.crossJoin(nodes.agg(F.count("*").alias("n_nodes")))  # one row on the right


@query("s4_k4_tiered_matrix", "with t as (select case l_linenumber % 3 when 0 then 'c2c' when 1 then 'c2z' else 'z2z' end as tier, l_orderkey as orig_id, l_linenumber as dest_id, cast(l_quantity as float) as value from lineitem) select tier, orig_id, dest_id, value from t where tier <> 'c2z' union all select 'c2z', orig_id, dest_id, value from t where tier = 'c2z' and orig_id % 2 = 0")
def matrix(spark, sf):
    li, k = spark.read.parquet(f"{sf}/lineitem.parquet"), catalog(spark)
    part = lambda m: li.where(F.col("l_linenumber") % 3 == m).select(F.col("l_orderkey").alias("orig_id"), F.col("l_linenumber").alias("dest_id"), F.col("l_quantity").alias("value"))
    k.write_od({"c2c": part(0), "c2z": part(1).where("orig_id % 2 = 0"), "z2z": part(2)}, "time")
    return k.read_od("time", "c2c").unionByName(k.read_od("time", "c2z")).unionByName(k.read_od("time", "z2z"))


@query("s5_k5_results", ctes("cells") + " select segment, count(*) as n from cells_ group by 1")
def results(spark, sf):
    k = catalog(spark)
    k.write(load(spark, sf, "cells"), "results", "cells", partition="segment")
    return k.read("results", "cells").groupBy("segment").agg(F.count("*").alias("n"))


@query("s6_k6_coefficients", "select 'b' || n_nationkey as param, 'p' || n_regionkey as profile, round(n_nationkey / 7.0::double, 4) as value from nation")
def coefficients(spark, sf):
    n, k = spark.read.parquet(f"{sf}/nation.parquet"), catalog(spark)
    k.write_coefs(n.select(F.concat(F.lit("b"), "n_nationkey").alias("param"), F.concat(F.lit("p"), "n_regionkey").alias("profile"), (F.col("n_nationkey") / 7.0).alias("value")), "road", "calibrated")
    return k.read_coefs("road", "calibrated")


@query("u4_key_differences", ctes("cells") + ", a as (select cell_id from cells_ where cell_id % 3 > 0), b as (select cell_id from cells_ where cell_id % 5 > 0) select 'left' as side, count(*) as n from a where cell_id not in (select cell_id from b) union all select 'right', count(*) from b where cell_id not in (select cell_id from a)")
def u4(spark, sf):
    c = load(spark, sf, "cells").select("cell_id")
    a, b = c.where("cell_id % 3 > 0"), c.where("cell_id % 5 > 0")
    side = lambda x, y, name: x.exceptAll(y).agg(F.count("*").alias("n")).select(F.lit(name).alias("side"), "n")
    return side(a, b, "left").unionByName(side(b, a, "right"))


@query("n7_consolidation", None)
def n7(spark, sf):
    nodes = load(spark, sf, "cells").select(F.col("cell_id").alias("node_id"), "x", "y")
    edges = nodes.select(F.col("node_id").alias("u"), (F.col("node_id") * 7 % 97).alias("v")).where("u <> v")
    return N.consolidate(spark, nodes, edges, 150.0)


@query("n8_edge_cleanup", ctes("edges") + " select way_id, (rank + rank % 3) / 2.0::double as lanes, 30.0::double + 10 * (rank % 2) as maxspeed, length from edges_")
def n8(spark, sf):
    e = load(spark, sf, "edges")
    merged = e.select("way_id", F.lit("x").alias("name"), F.array(F.col("rank").cast("string"), (F.col("rank") % 3).cast("string"), F.lit("many")).alias("lanes"), F.array((30 + 10 * (F.col("rank") % 2)).cast("string")).alias("maxspeed"), "length")
    return X.clean_edges(merged, ["lanes", "maxspeed"])


@query("r3_tiered_path_costs", ctes("matrix") + ", c as (select orig_id, dest_id, min(value) as cost from matrix_ where value > 3 group by 1, 2), o as (select case l_linenumber % 3 when 0 then 'c2c' when 1 then 'c2z' else 'z2z' end as tier, l_orderkey as orig_id, l_linenumber as dest_id from lineitem) select o.tier, o.orig_id, o.dest_id, c.cost as value from o left join c on c.orig_id = case when tier = 'z2z' then o.orig_id % 20 else o.orig_id % 25 end and c.dest_id = case when tier = 'c2c' then o.dest_id % 25 else o.dest_id % 20 end")
def r3(spark, sf):
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    costs = load(spark, sf, "matrix").where("value > 3").groupBy(F.col("orig_id").alias("origin"), F.col("dest_id").alias("node")).agg(F.min("value").alias("cost"))
    tier = F.when(F.col("l_linenumber") % 3 == 0, "c2c").when(F.col("l_linenumber") % 3 == 1, "c2z").otherwise("z2z")
    od = li.select(tier.alias("tier"), F.col("l_orderkey").alias("orig_id"), F.col("l_linenumber").cast("long").alias("dest_id"))
    ids = od.select(F.col("orig_id").alias("id")).union(od.select("dest_id")).distinct()
    nodes = ids.select(F.lit("cell").alias("kind"), "id", (F.col("id") % 25).alias("node")).union(ids.select(F.lit("zone"), "id", F.col("id") % 20))
    return X.tiered_path_costs(od, costs, nodes)


@query("c4_profile_fallback", "select 'ebike' as profile, 3.5::double as b_time union all select 'rbike', 3.5 union all select 'walk', 1.25")
def c4(spark, sf):
    coefs = {"rbike": {"b_time": 3.5}, "walk": {"b_time": 1.25}}
    rows = [(p, X.profile_or_sibling(coefs, p, siblings)["b_time"]) for p, siblings in (("ebike", ["ebike45", "rbike"]), ("rbike", []), ("walk", ["hike"]))]
    return spark.createDataFrame(rows, "profile string, b_time double")


@query("e8_edge_calibration", ctes("edges") + ", r as (select u, sum(length) as s, sum(rank) as k from edges_ group by 1) select 2.0::double as length, 5.0::double as rank, 1.0::double as r2")
def e8(spark, sf):
    """Observed times are made of 2 s a unit of length and 5 s a rank, which the fit must find again."""
    e = load(spark, sf, "edges").select(F.col("u").alias("trip_id"), "length", F.col("rank").cast("double").alias("rank")).withColumn("w", F.col("length"))
    route = lambda edges: edges.groupBy("trip_id").agg(F.sum("length").alias("length"), F.sum("rank").alias("rank"))
    seen = route(e).select("trip_id", (2 * F.col("length") + 5 * F.col("rank") + 7).alias("time"))
    fit = X.calibrate_edges(e, route, seen, ["length", "rank"])
    return spark.createDataFrame([tuple(round(float(fit[k]), d) for k, d in (("length", 4), ("rank", 4), ("r2", 6)))], "length double, rank double, r2 double")


@query("e6_pooled_fit", ctes("cells") + " select round(regr_slope(population, x), 4) as slope, round(regr_intercept(population, x), 4) as const from cells_ where cell_id % 4 in (1, 3)")
def e6(spark, sf):
    c = load(spark, sf, "cells")
    pooled = c.where("cell_id % 4 = 1").unionByName(c.where("cell_id % 4 = 3"))
    fit = E.ols(pooled, "population", ["x"])
    return spark.createDataFrame([(round(fit["x"], 4), round(fit["const"], 4))], "slope double, const double")


@query("x4_simple_sample", ctes("cells") + " select least(40, count(*))::bigint as n, least(40, count(*))::bigint as n_distinct, least(40, count(*))::bigint as n_known from cells_")
def x4(spark, sf):
    """Size, uniqueness and origin of a sample; its rows follow from hashes that SQL lacks."""
    c = load(spark, sf, "cells")
    s = P.simple_sample(c.select("cell_id"), "cell_id", 40, 11)
    known = s.join(c.select("cell_id"), "cell_id", "left_semi").agg(F.count("*").alias("n_known"))
    return s.agg(F.count("*").alias("n"), F.count_distinct("cell_id").alias("n_distinct")).crossJoin(known)


@query("x6_jitter", "select count(*) as n, count(*) as n_near, true as spread from events")
def x6(spark, sf):
    """All times stay within 150 s of what they were, on either side."""
    e = spark.read.parquet(f"{sf}/events.parquet").select("event_id", F.col("ts").cast("timestamp").cast("double").alias("t"))
    moved = e.withColumn("d", P.jitter(F.col("t"), F.col("event_id"), 5, 150.0) - F.col("t"))
    return moved.agg(F.count("*").alias("n"), F.count_if(F.abs("d") <= 150).alias("n_near"), ((F.min("d") < -100) & (F.max("d") > 100)).alias("spread"))


@query("f14_speed_sides", "with l as (select conv_id || '_' || turn as leg_id, case when turn % 2 = 1 then 'walk' else 'car' end as mode, length(text) * 20.0::double as d, (turn * 3 + length(text) % 11) * 60.0::double as t from conversations), b as (select *, t / 60 as m, t / 60 % 5 = 0 as st, case mode when 'walk' then 2.0 else 5.0 end as vmin, case mode when 'walk' then 8.0 else 130.0 end as vmax from l), i as (select *, case when st then case when m = 5 then 0 else greatest(m - 2.5, 0) * 60 end else greatest(m - 0.5, 0) * 60 end as lo, case when st then (m + 2.5) * 60 else (m + 0.5) * 60 end as hi from b) select leg_id, coalesce(case when lo > 0 then d / 1000 / (lo / 3600) < vmin end, false) as too_slow, coalesce(d / 1000 / (hi / 3600) > vmax, false) as too_fast from i")
def f14(spark, sf):
    c = spark.read.parquet(f"{sf}/conversations.parquet")
    legs = c.select(F.concat_ws("_", "conv_id", "turn").alias("leg_id"), F.when(F.col("turn") % 2 == 1, "walk").otherwise("car").alias("mode"), (F.length("text") * 20.0).alias("dist_measured"), ((F.col("turn") * 3 + F.length("text") % 11) * 60.0).alias("time_measured"))
    return Y.speed_sides(legs).select("leg_id", "too_slow", "too_fast")


@query("w1_w2_positions", "with l as (select conv_id || '_' || turn as leg_id, conv_id as trip_id, turn, case when turn % 4 = 1 then 'transit' else 'walk' end as mode from conversations), p as (select *, row_number() over (partition by trip_id order by turn) - 1 as pos from l) select leg_id, pos::int as pos, (min(case when mode = 'transit' then pos end) over (partition by trip_id))::int as first_t, (max(case when mode = 'transit' then pos end) over (partition by trip_id))::int as last_t from p")
def w1(spark, sf):
    c = spark.read.parquet(f"{sf}/conversations.parquet")
    legs = c.select(F.concat_ws("_", "conv_id", "turn").alias("leg_id"), F.col("conv_id").alias("trip_id"), F.when(F.col("turn") % 4 == 1, "transit").otherwise("walk").alias("mode"))
    return Y.positions(legs).select("leg_id", "pos", "first_t", "last_t")


@query("v8_minutes_per_utility", "select round(-1 / avg(b), 6) as minutes from (values (-0.05::double), (-0.03), (-0.04)) as t(b)")
def v8(spark, sf):
    return spark.createDataFrame([(round(X.minutes_per_utility([-0.05, -0.03, -0.04]), 6),)], "minutes double")


@query("n19_coarse_graph", ctes("dests") + ", l as (select round_even(dx, 1) || ',' || round_even(dy, 1) as a, round_even(dx + 30, 1) || ',' || round_even(dy + 20, 1) as b from dests_) select count(*)::bigint as n from (select a, b from l union all select b, a from l) where a <> b")
def n19(spark, sf):
    d = load(spark, sf, "dests").select(F.col("dx").alias("x0"), F.col("dy").alias("y0"), (F.col("dx") + 30).alias("x1"), (F.col("dy") + 20).alias("y1"))
    return X.coarse_graph(d.withColumn("line_id", F.monotonically_increasing_id())).agg(F.count("*").alias("n"))


@query("f36_density_normalised", ctes("cells") + " select cell_id, round(sqrt(population / 10000), 6) as density_norm from cells_")
def f36(spark, sf):
    return load(spark, sf, "cells").select("cell_id", F.round(S.normalised_density(F.col("population")), 6).alias("density_norm"))
