"""Queries of geometry, validation, filters, durations, surveys and raw sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from isoreach.functions import survey as S
from isoreach.operators import geometry as G
from isoreach.operators import metrics as A
from isoreach.operators import od as O
from isoreach.operators import spatial as J
from isoreach.operators import stats as V
from isoreach.operators import validation as X
from isoreach.plans.access_queries import AGREE, PAIRS, _boxes, pairs, rounded
from isoreach.plans.domain import ctes, load, query
from isoreach.sources import formats


def tab(spark, sf, name):
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query("f30_centroid_and_area", ctes("buildings") + " select building_id, round((x0 + x1) / 2, 4) as cx, round((y0 + y1) / 2, 4) as cy, round(area, 4) as area from buildings_ where area > 0")
def f30(spark, sf):
    b = load(spark, sf, "buildings").where("area > 0")
    at = lambda x, y: F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    ring = F.array(at("x0", "y0"), at("x1", "y0"), at("x1", "y1"), at("x0", "y1"), at("x0", "y0"))
    c = G.centroid(ring)
    return b.select("building_id", F.round(c["x"], 4).alias("cx"), F.round(c["y"], 4).alias("cy"), F.round(G.area(ring), 4).alias("area"))


@query("j11_difference_area", ctes("buildings", "zones") + ", bx as (select zone_id, x as zx0, y as zy0, x + 180 as zx1, y + 140 as zy1 from zones_), h as (select building_id, x0, y0, x0 + 1 as x1, y0 + 1 as y1 from buildings_), c as (select zone_id, sum((least(x1, zx1) - greatest(x0, zx0)) * (least(y1, zy1) - greatest(y0, zy0))) as cut from bx join h on least(x1, zx1) > greatest(x0, zx0) and least(y1, zy1) > greatest(y0, zy0) group by 1) select zone_id, round(180 * 140 - coalesce(cut, 0), 4)::double as area from bx left join c using (zone_id)")
def j11(spark, sf):
    holes = load(spark, sf, "buildings").withColumn("hole", G.square_ring(F.col("x0"), F.col("y0"), 1.0)).select("hole")
    out = G.difference_area(_boxes(spark, sf).select("zone_id", "ring"), "zone_id", "ring", holes, "hole", 100.0)
    return rounded(out, "area")


@query("n14_simplification", None)
def n14(spark, sf):
    li = tab(spark, sf, "lineitem")
    lines = li.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct(F.col("l_linenumber").cast("double").alias("x"), F.col("l_quantity").cast("double").alias("y")))).alias("line"))
    return G.simplify(lines, "line", 10.0).select("l_orderkey", F.size("line").alias("n"), F.round(G.length(F.col("line")), 4).alias("length"))


@query("d10_hexagons", ctes("cells") + ", c as (select *, (sqrt(3::double) / 3 * x - y / 3) / 60 as q, 2.0::double / 3 * y / 60 as r from cells_), k as (select *, round_even(q, 0) as rq, round_even(r, 0) as rr, round_even(-q - r, 0) as rs from c), o as (select *, abs(rq - q) > abs(rr - r) and abs(rq - q) > abs(rs + q + r) as by_q, abs(rr - r) > abs(rs + q + r) as by_r from k) select cast(case when by_q then -rr - rs else rq end as bigint) || ':' || cast(case when not by_q and by_r then -rq - rs else rr end as bigint) as hex, count(*) as n, round(sum(population), 4) as population from o group by 1")
def d10(spark, sf):
    return load(spark, sf, "cells").groupBy(G.hexagon(F.col("x"), F.col("y"), 60.0).alias("hex")).agg(F.count("*").alias("n"), F.round(F.sum("population"), 4).alias("population"))


@query("d7_d9_source_comparison", ctes("cells") + ", g as (select cast(floor(x / 100) as bigint) as c, cast(floor(y / 100) as bigint) as r, sum(population) as a, sum(case when cell_id % 3 > 0 then population * 1.4 else 0 end) as b from cells_ group by 1, 2) select round(avg(case when a > 0 then 1.0 else 0.0 end), 6)::double as share_a, round(avg(case when b > 0 then 1.0 else 0.0 end), 6)::double as share_b, round(corr(a, b), 6) as corr, round(avg(b - a), 4) as bias from g")
def d9(spark, sf):
    g = load(spark, sf, "cells").groupBy(J.bucket("x", 100).alias("c"), J.bucket("y", 100).alias("r")).agg(F.sum("population").alias("a"), F.sum(F.when(F.col("cell_id") % 3 > 0, F.col("population") * 1.4).otherwise(0.0)).alias("b"))
    return g.agg(F.round(F.avg((F.col("a") > 0).cast("double")), 6).alias("share_a"), F.round(F.avg((F.col("b") > 0).cast("double")), 6).alias("share_b"), F.round(F.corr("a", "b"), 6).alias("corr"), F.round(F.avg(F.col("b") - F.col("a")), 4).alias("bias"))


@query("z2_rasterised_polygons", ctes("zones") + ", bx as (select zone_id, x as bx0, y as by0, x + 180 as bx1, y + 140 as by1 from zones_), g as (select c, r, c * 40 + 20.0::double as px, r * 40 + 20.0::double as py from (select unnest(range(25)) as c) cross join (select unnest(range(25)) as r)) select c, r, min(zone_id) as zone_id from g join bx on px >= bx0 and px < bx1 and py >= by0 and py < by1 group by c, r")
def z2(spark, sf):
    g = spark.range(625).select((F.col("id") % 25).alias("c"), F.floor(F.col("id") / 25).alias("r")).withColumns({"x": F.col("c") * 40 + 20.0, "y": F.col("r") * 40 + 20.0})
    return J.points_in_polygons(g, _boxes(spark, sf).select("zone_id", "ring")).groupBy("c", "r").agg(F.min("zone_id").alias("zone_id"))


@query("z4_radius_densities", ctes("cells") + ", g as (select zone_id, sum(population) as v, count(*) / 10.0 as land, count(*) filter (where population > 3000) / 20.0 as built from cells_ group by 1) select zone_id, round(v / (pi() * 4), 2) as v_per_km2, round(v / nullif(land, 0), 2)::double as v_per_land_km2, round(v / nullif(built, 0), 2)::double as v_per_built_km2 from g")
def z4(spark, sf):
    g = load(spark, sf, "cells").groupBy("zone_id").agg(F.sum("population").alias("v"), (F.count("*") / 10.0).alias("land"), (F.count_if(F.col("population") > 3000) / 20.0).alias("built"))
    return X.radius_densities(g, "v", 2000.0, "land", "built").select("zone_id", "v_per_km2", "v_per_land_km2", "v_per_built_km2")


@query("p4_survey_gates", "select o_orderkey from orders where o_totalprice > 100000 and o_orderstatus in ('O', 'P')")
def p4(spark, sf):
    flags = {"is_valid": (F.col("o_totalprice") > 100000).cast("int"), "is_land_based": F.when(F.col("o_orderstatus") != "P", (F.col("o_orderstatus") == "O").cast("int"))}
    return X.gates(tab(spark, sf, "orders").withColumns(flags), ["is_valid", "is_land_based", "is_missing"], ("is_land_based",)).select("o_orderkey")


@query("p5_both_ends_inside", ctes("cells", "zones") + ", bx as (select x as bx0, y as by0, x + 180 as bx1, y + 140 as by1 from zones_ where region_id <> 1), t as (select cell_id, x, y, (x * 3 + 17) % 1000 as dx, (y * 7 + 5) % 1000 as dy from cells_) select cell_id from t where exists (select 1 from bx where x >= bx0 and x < bx1 and y >= by0 and y < by1) and exists (select 1 from bx where dx >= bx0 and dx < bx1 and dy >= by0 and dy < by1)")
def p5(spark, sf):
    t = load(spark, sf, "cells").select("cell_id", F.col("x").alias("ox"), F.col("y").alias("oy"), ((F.col("x") * 3 + 17) % 1000).alias("dx"), ((F.col("y") * 7 + 5) % 1000).alias("dy"))
    return X.both_ends_inside(t, "cell_id", _boxes(spark, sf).join(load(spark, sf, "zones").where("region_id <> 1").select("zone_id"), "zone_id", "left_semi").select("zone_id", "ring")).select("cell_id")


@query("p8_distance_filter", PAIRS + " select cell_id, dest_id from pairs where cost > 20 and cost <= 35")
def p8(spark, sf):
    return pairs(spark, sf, 35.0).where("cost > 20 and cost <= 35").select("cell_id", "dest_id")


@query("p10_eligible_cells", ctes("cells", "zones") + " select cell_id from cells_ c join zones_ z on z.zone_id = c.zone_id and z.region_id <> 2 where population > 0 and c.x < 500")
def p10(spark, sf):
    cells = load(spark, sf, "cells").withColumns({"node_id": F.when(F.col("population") > 0, F.col("cell_id")), "is_active": (F.col("x") < 500).cast("int")})
    zones = load(spark, sf, "zones").withColumn("node_id", F.when(F.col("region_id") != 2, F.col("zone_id")))
    return X.eligible_cells(cells, zones, origins=True).select("cell_id")


@query("p11_non_empty", ctes("cells") + " select cell_id from cells_ where population > 0 or segment = 'BUILDING'")
def p11(spark, sf):
    return X.non_empty(load(spark, sf, "cells").withColumns({"employment": F.lit(0), "n_pois": (F.col("segment") == "BUILDING").cast("int")})).select("cell_id")


@query("p15_tiny_geometry", ctes("buildings") + " select building_id from buildings_ where area >= 25")
def p15(spark, sf):
    b = load(spark, sf, "buildings")
    return b.where(G.area(G.square_ring(F.col("x0"), F.col("y0"), 1.0)) * F.col("area") >= 25).select("building_id")


EDGE_SQL = "with e as (select o_orderkey as edge_id, o_totalprice / 1000 as length, 20.0::double + o_orderkey % 60 as kph, (o_orderkey % 9)::double as f, (o_orderkey % 40) - 20.0::double as dz, o_orderkey % 11 as st from orders)"


def _edges(spark, sf):
    k = F.col("o_orderkey")
    return tab(spark, sf, "orders").select(k.alias("edge_id"), (F.col("o_totalprice") / 1000).alias("length"), (20.0 + k % 60).alias("kph"), (k % 9).cast("double").alias("f"), (k % 40 - 20.0).alias("dz"), (k % 11).alias("st"))


@query("p16_edge_exclusions", EDGE_SQL + " select edge_id, (st > 9 or abs(dz) / greatest(length, 0.1) > 0.2) as barred from e")
def p16(spark, sf):
    return _edges(spark, sf).select("edge_id", X.excluded(F.col("st") - 9, F.col("dz"), F.col("length")).alias("barred"))


@query("c14_edge_duration", EDGE_SQL + " select edge_id, round(greatest(length / (100 / 3.6::double), least(length / (5 / 3.6::double), length / (kph / 3.6::double) * (1.1::double + 0.05::double * f) + 2.0::double * f)), 4) as duration from e")
def c14(spark, sf):
    e = _edges(spark, sf)
    return e.select("edge_id", F.round(X.edge_duration(F.col("length"), F.col("kph"), 1.1, {"f": 0.05}, {"f": 2.0}, 5.0, 100.0), 4).alias("duration"))


@query("c15_derived_profile", EDGE_SQL + " select edge_id, case when st > 9 then 'Infinity'::double else round(least(greatest(length / 6, length / (least(25, kph) / 3.6::double)), length / 5), 6) end as duration from e")
def c15(spark, sf):
    length = F.col("length")
    d = X.capped_profile(length / 6, length, 25.0, F.col("kph"), length / 5, F.col("st") > 9)
    return _edges(spark, sf).select("edge_id", F.when(F.isnan(d) | (F.abs(d) == float("inf")), d).otherwise(F.round(d * 1e6) / 1e6).alias("duration"))  # SQL rounds the scaled double, not its decimal digits


@query("c16_gross_time", EDGE_SQL + " select edge_id, round(greatest(120, length * 1.3::double + f * 10 + dz), 6) as t from e")
def c16(spark, sf):
    return _edges(spark, sf).select("edge_id", F.round(X.gross_time(F.col("length"), 1.3, F.col("f") * 10, F.col("dz"), 120.0), 6).alias("t"))


@query("f35_slope_features", "with nd as (select c_custkey as node_id, greatest(c_acctbal, 0) / 100 as z from customer), e as (select o_orderkey as edge_id, o_custkey as u, (o_custkey * 3) % 1000 + 1 as v, o_totalprice / 1000 as length, o_orderkey % 10 = 0 as cov from orders), d as (select e.*, case when cov then 0 else b.z - a.z end as dz from e left join nd a on a.node_id = u left join nd b on b.node_id = v) select edge_id, round(dz, 6) as dz, round(greatest(0, dz) * greatest(0, dz) / length, 6) as climb from d")
def f35(spark, sf):
    nodes = tab(spark, sf, "customer").select(F.col("c_custkey").alias("node_id"), (F.greatest("c_acctbal", F.lit(0.0)) / 100).alias("z"))
    e = tab(spark, sf, "orders").select(F.col("o_orderkey").alias("edge_id"), F.col("o_custkey").alias("u"), ((F.col("o_custkey") * 3) % 1000 + 1).alias("v"), (F.col("o_totalprice") / 1000).alias("length"), (F.col("o_orderkey") % 10 == 0).alias("covered"))
    out = X.slope_features(e, nodes)
    return out.select("edge_id", F.round("dz", 6).alias("dz"), F.round(F.when(F.col("dz").isNull(), 0.0).otherwise(F.col("climb")), 6).alias("climb"))


@query("c7_straight_line_od", ctes("zones") + " select a.zone_id as orig_zone, b.zone_id as dest_zone, round(sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)), 4) as dist from zones_ a cross join zones_ b")
def c7(spark, sf):
    return rounded(O.zone_pairs(load(spark, sf, "zones"), 2000.0), "dist")


@query("v5_exact_baseline", PAIRS + " select cell_id, round(sum(case when cost < 100 then weight else 0 end), 4) as count_0_100, round(sum(weight * exp(-0.01 * cost)), 4) as gravity_b from pairs group by cell_id")
def v5(spark, sf):
    return rounded(X.exact_access(pairs(spark, sf), "cell_id", [(0.0, 100.0)], {"b": 0.01}), "count_0_100", "gravity_b")


@query("v4_group_comparison", PAIRS + f""", a as (select cell_id, sum(weight * exp(-0.02 * cost)) as w from pairs group by 1), b as (select cell_id, sum(weight * exp(-0.021 * cost)) as w from pairs group by 1), c as (select cell_id, sum(weight * exp(-0.03 * cost)) as w from pairs group by 1),
  r as (select 'network' as grp, a.w as m, b.w as p from a join b using (cell_id) union all select 'data', a.w, c.w from a join c using (cell_id)) select grp as "group", 'w' as "column", {AGREE} from r group by grp""")
def v4(spark, sf):
    g = lambda beta: A.gravity(pairs(spark, sf), "cell_id", {"x": beta}, name="w").withColumnRenamed("w_x", "w")
    out = X.compare_groups({"network": (g(0.02), g(0.021)), "data": (g(0.02), g(0.03))}, "cell_id", ["w"])
    return rounded(out, *[c for c in out.columns if c not in ("group", "column", "n")])


@query("r8_exact_check", PAIRS + " select count(*) as n, round(max(abs(cost - (cost + cell_id % 3))), 6)::double as worst from pairs")
def r8(spark, sf):
    p = pairs(spark, sf).select("cell_id", "dest_id", F.col("cost").alias("value"))
    out = X.worst_difference(p, p.withColumn("value", F.col("value") + F.col("cell_id") % 3), ["cell_id", "dest_id"])
    return rounded(out, "worst", digits=6)


@query("v9_road_tiers", "select case when o_orderkey % 8 >= 6 then 'highway' when o_orderkey % 8 >= 3 then 'main' else 'local' end as tier, count(*) as n from orders group by 1")
def v9(spark, sf):
    return tab(spark, sf, "orders").groupBy(X.road_tier(F.col("o_orderkey") % 8).alias("tier")).agg(F.count("*").alias("n"))


@query("j16_counters", None)
def j16(spark, sf):
    edges = load(spark, sf, "dests").select(F.col("dest_id").alias("edge_id"), F.col("dx").alias("x0"), F.col("dy").alias("y0"), (F.col("dx") + 30).alias("x1"), (F.col("dy") + 20).alias("y1"))
    counters = load(spark, sf, "cells").select(F.col("cell_id").alias("counter_id"), "x", "y", (F.col("cell_id") % 360).cast("double").alias("heading"))
    return rounded(X.snap_counters(counters, edges, 25.0, 60.0), "dist")


@query("n15_projected_nodes", None)
def n15(spark, sf):
    edges = load(spark, sf, "dests").select(F.col("dest_id").alias("edge_id"), F.col("dx").alias("x0"), F.col("dy").alias("y0"), (F.col("dx") + 30).alias("x1"), (F.col("dy") + 20).alias("y1"))
    return rounded(X.project_on_edges(load(spark, sf, "cells").select("cell_id", "x", "y"), "cell_id", edges, 25.0, 5.0), "share", "x", "y")


@query("n16_transport_centroid", ctes("cells", "zones") + ", bx as (select zone_id, x as bx0, y as by0, x + 180 as bx1, y + 140 as by1 from zones_) select b.zone_id as in_zone, quantile_cont(c.x, 0.5) as x, quantile_cont(c.y, 0.5) as y, count(*) as n from cells_ c join bx b on c.x >= bx0 and c.x < bx1 and c.y >= by0 and c.y < by1 group by 1")
def n16(spark, sf):
    return X.transport_centroids(load(spark, sf, "cells").select("cell_id", "x", "y"), _boxes(spark, sf).select(F.col("zone_id").alias("in_zone"), "ring"), "in_zone")


@query("n9_sidepaths", None)
def n9(spark, sf):
    ways = load(spark, sf, "dests").select(F.col("dest_id").alias("way_id"), "category", F.col("dx").alias("x0"), F.col("dy").alias("y0"), (F.col("dx") + 30).alias("x1"), (F.col("dy") + 5).alias("y1"))
    return X.alongside(ways.where("category = 0"), ways.where("category <> 0").withColumn("x1", F.col("x0") + 400))


@query("e10_availability", "select o_orderkey, cast(coalesce(o_totalprice / 100 < 1200, false) as int) as av_car, cast(coalesce(o_totalprice / 60 < 1200, false) and o_orderkey % 2 = 1 as int) as av_bike from orders")
def e10(spark, sf):
    o = tab(spark, sf, "orders").select("o_orderkey", (F.col("o_totalprice") / 100).alias("t_car"), (F.col("o_totalprice") / 60).alias("t_bike"), (F.col("o_orderkey") % 2).alias("has_bike"))
    return X.availability(o, {"car": "t_car", "bike": "t_bike"}, {"bike": "has_bike"}, 1200.0).select("o_orderkey", "av_car", "av_bike")


@query("e12_cross_validation", ctes("cells") + ", f as (select w, regr_slope(population, x) as b, regr_intercept(population, x) as a from cells_ join (select unnest([0, 1]) as w) on cell_id % 2 <> w group by w) select cell_id, round(a + b * x, 4) as predicted from cells_ join f on cell_id % 2 = w")
def e12(spark, sf):
    c = load(spark, sf, "cells").select("cell_id", (F.col("cell_id") % 2).alias("wave"), "x", "population")
    return rounded(X.cross_validated(c, "wave", "population", ["x"], "predicted").select("cell_id", "predicted"), "predicted")


@query("e11_trip_cost_bins", ctes("cells") + ", c as (select population, x, sum(population) over (order by x, cell_id rows between unbounded preceding and current row) as cum, sum(population) over () as tot from cells_ where population > 0) select q, min(x) as edge from c cross join (values (0.25), (0.5), (0.75)) v(q) where cum >= q * tot group by q")
def e11(spark, sf):
    c = load(spark, sf, "cells").withColumn("one", F.lit(1))
    parts = [A.weighted_quantile(c, "one", "x", "population", q, "cell_id", "edge").select(F.lit(q).cast("decimal(3,2)").alias("q"), "edge") for q in (0.25, 0.5, 0.75)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("t4_completeness", ctes("cells") + " select case when not (x > 100) then 'place' when not (population > 0) then 'people' else 'complete' end as cause, count(*) as n from cells_ group by 1")
def t4(spark, sf):
    return X.completeness(load(spark, sf, "cells"), {"place": F.col("x") > 100, "people": F.col("population") > 0})


@query("t8_audits", "select round(avg(case when l_discount <= 0.05 then 1.0 else 0.0 end), 6)::double as small_discount, round(avg(case when l_quantity >= 2 then 1.0 else 0.0 end), 6)::double as several from lineitem")
def t8(spark, sf):
    out = X.consistency_rates(tab(spark, sf, "lineitem"), {"small_discount": F.col("l_discount") <= 0.05, "several": F.col("l_quantity") >= 2})
    return rounded(out, "small_discount", "several", digits=6)


@query("w7_renumbering", "select event_id, user_id, row_number() over (partition by user_id order by ts, event_id) as leg_no from events")
def w7(spark, sf):
    return X.renumbered(load(spark, sf, "events"), ["user_id"], ["ts", "event_id"], "leg_no").select("event_id", "user_id", F.col("leg_no").cast("long").alias("leg_no"))


@query("s16_band_sums", "select p_partkey, p_size + p_retailprice as both_cols, 0::double as none from part")
def s16(spark, sf):
    return formats.sum_columns(tab(spark, sf, "part"), {"both_cols": ["p_size", "p_retailprice", "absent"], "none": ["absent"]}).select("p_partkey", "both_cols", "none")


@query("s18_cube_pivot", "select year(o_orderdate) as yr, count(*) filter (where o_orderstatus = 'F') as f, count(*) filter (where o_orderstatus = 'O') as o from orders group by 1")
def s18(spark, sf):
    p = tab(spark, sf, "orders").groupBy(F.year("o_orderdate").cast("long").alias("yr")).pivot("o_orderstatus", ["F", "O"]).count().na.fill(0)
    return p.withColumnsRenamed({"F": "f", "O": "o"})


@query("s20_sentinels", "select c_custkey, case when c_acctbal >= 0 then c_acctbal end as c_acctbal from customer")
def s20(spark, sf):
    return X.clean_sentinels(tab(spark, sf, "customer"), ["c_acctbal"]).select("c_custkey", "c_acctbal")


@query("s21_traffic_zones", "select case when n_regionkey = 0 then 'ZD' else 'ZF' end || n_nationkey as zone_id, case when n_regionkey = 0 then n_nationkey * 2.0 else n_nationkey * 1.0 end::double as x, 5.0::double as y, n_regionkey = 0 as is_domestic from nation")
def s21(spark, sf):
    z = tab(spark, sf, "nation").select("n_regionkey", F.col("n_nationkey").alias("zone_no"), (F.col("n_nationkey") * 1.0).cast("double").alias("x"), F.lit(5.0).alias("y"))
    return X.traffic_zones(z, z.where("n_regionkey = 0").withColumn("x", F.col("x") * 2))


@query("s30_counters", "select s_suppkey, case when s_suppkey % 4 >= 1 then s_suppkey % 4 else 0.9 * (s_suppkey % 5) end::double as cars from supplier where case when s_suppkey % 4 >= 1 then s_suppkey % 4 else 0.9 * (s_suppkey % 5) end > 0")
def s30(spark, sf):
    c = tab(spark, sf, "supplier").select("s_suppkey", (F.col("s_suppkey") % 4).alias("passenger"), (F.col("s_suppkey") % 5).alias("vehicles"))
    return X.counter_flows(c).select("s_suppkey", F.col("cars").cast("double").alias("cars"))


@query("s34_box_read", ctes("cells") + " select cell_id, x from cells_ where x between 100 and 200 and y between 300 and 420")
def s34(spark, sf):
    return load(spark, sf, "cells").where("x between 100 and 200 and y between 300 and 420").select("cell_id", "x")


@query("f8_dates", "select o_orderkey, try_strptime(strftime(o_orderdate, '%d.%m.%Y'), '%d.%m.%Y')::date as d from orders")
def f8(spark, sf):
    t = F.date_format("o_orderdate", "dd.MM.yyyy")
    return tab(spark, sf, "orders").select("o_orderkey", S.parsed_dates(t)[0].alias("d"))


@query("w11_interpolation", "select event_id, case when value <= 10 then 5.0 when value >= 60 then 30.0 else 5.0 + 25.0 * (value - 10) / 50 end::double as y from events")
def w11(spark, sf):
    knots = spark.createDataFrame([(10.0, 5.0), (60.0, 30.0)], "kx double, ky double")
    return V.interpolate(load(spark, sf, "events").select("event_id", "value"), "value", knots, "kx", "ky", "y").select("event_id", "y")


@query("n5_chain_collapse", None)
def n5(spark, sf):
    from isoreach.operators import graph as N
    from isoreach.plans.network_queries import edges

    e = edges(spark, sf).select("u", "v", F.col("w").alias("length"))
    return rounded(N.collapse_chains(spark, e), "length")


@query("n13_speed_fill", "select o_orderkey, coalesce(case when o_orderkey % 3 = 0 then 30.0 end, case when o_orderkey % 5 = 0 then 80.0 end, 50.0)::double as kph from orders")
def n13(spark, sf):
    k = F.col("o_orderkey")
    return tab(spark, sf, "orders").select("o_orderkey", X.filled_speed(F.when(k % 3 == 0, 30.0), F.when(k % 5 == 0, 80.0)).alias("kph"))


@query("n21_snap_flags", PAIRS + ", a as (select distinct cell_id from pairs where cost <= 20), b as (select distinct cell_id from pairs where cost <= 40 and category = 1) select c.cell_id, cast(c.x < 500 and a.cell_id is not null and b.cell_id is not null as int) as is_active from cells_ c left join a on a.cell_id = c.cell_id left join b on b.cell_id = c.cell_id")
def n21(spark, sf):
    from isoreach.operators import graph as N

    cells = load(spark, sf, "cells").withColumn("is_aoi", (F.col("x") < 500).cast("int"))
    nodes = load(spark, sf, "dests").select(F.col("dest_id").alias("node_id"), "dx", "dy", "category")
    snap = lambda n, r: J.nearest(cells.select("cell_id", "x", "y"), "cell_id", n, "node_id", r).select("cell_id", "node_id", F.col("dist").alias("snap_distance"))
    return N.snap_flags({"walk": snap(nodes, 20.0), "car": snap(nodes.where("category = 1"), 40.0)}, cells).select("cell_id", "is_active")


@query("t5_t6_leg_times", "select o_orderkey as leg_id, case when o_totalprice > 100000 then o_totalprice end as time_car, case when o_totalprice < 250000 then o_totalprice * 2 end as time_bike, a.c_acctbal as overhead_orig, b.c_acctbal as overhead_dest from orders left join customer a on a.c_custkey = o_custkey left join customer b on b.c_custkey = o_custkey + 7")
def t5(spark, sf):
    o = tab(spark, sf, "orders").select(F.col("o_orderkey").alias("leg_id"), F.col("o_custkey").alias("orig_cell"), (F.col("o_custkey") + 7).alias("dest_cell"), "o_totalprice")
    c = tab(spark, sf, "customer").select(F.col("c_custkey").alias("cell_id"), F.col("c_acctbal").alias("overhead"))
    times = X.leg_times(o, {"car": o.where("o_totalprice > 100000").select("leg_id", F.col("o_totalprice").alias("cost")), "bike": o.where("o_totalprice < 250000").select("leg_id", (F.col("o_totalprice") * 2).alias("cost"))})
    return X.leg_overheads(times, c).select("leg_id", "time_car", "time_bike", "overhead_orig", "overhead_dest")


@query("s29_postcodes", "with p as (select c_custkey % 50 as postcode, c_nationkey as municipality, c_custkey % 13 as x, c_custkey % 7 as y from customer), a as (select postcode, municipality, min(x * 1000 + y) as m from p group by 1, 2), b as (select *, row_number() over (partition by postcode order by municipality) as rn from a) select municipality, avg(floor(m / 1000)) as x, avg(m % 1000) as y from b where rn = 1 group by 1")
def s29(spark, sf):
    c = tab(spark, sf, "customer").select((F.col("c_custkey") % 50).alias("postcode"), F.col("c_nationkey").alias("municipality"), (F.col("c_custkey") % 13).alias("x"), (F.col("c_custkey") % 7).alias("y"))
    return formats.postcode_points(c)[1]


@query("s32_hectare_ids", ctes("cells") + " select cell_id, x, y from cells_")
def s32(spark, sf):
    ids = load(spark, sf, "cells").select("cell_id", F.concat_ws(":", F.col("x").cast("string"), F.col("y").cast("string")).alias("id"))
    return formats.hectare_points(ids).select("cell_id", "x", "y")


@query("s12_clipped_source", ctes("cells", "zones") + ", bx as (select x as bx0, y as by0, x + 180 as bx1, y + 140 as by1 from zones_ where region_id = 0) select distinct cell_id from cells_ c join bx b on c.x >= bx0 and c.x < bx1 and c.y >= by0 and c.y < by1")
def s12(spark, sf):
    return formats.clip(load(spark, sf, "cells").select("cell_id", "x", "y"), _boxes(spark, sf).join(load(spark, sf, "zones").where("region_id = 0").select("zone_id"), "zone_id", "left_semi").select("ring")).select("cell_id")


@query("s25_raster_points", "select (2000.0 + ((l_suppkey % 100) + 0.5) * 30)::double as x, (9000.0 - ((l_partkey % 100) + 0.5) * 30)::double as y, l_quantity as value from lineitem where l_quantity > 10 and l_quantity <> 50")
def s25(spark, sf):
    px = tab(spark, sf, "lineitem").where("l_quantity > 10").select((F.col("l_suppkey") % 100).alias("col"), (F.col("l_partkey") % 100).alias("row"), F.col("l_quantity").alias("value"))
    return formats.pixels_to_points(px, 2000.0, 9000.0, 30.0, 50.0)


@query("s27_merged_pages", "with u as (select event_id, user_id, value from events where value > 20 union all select event_id, user_id, value + 1 from events where value < 60) select event_id, min(value) as value from u group by 1")
def s27(spark, sf):
    e = load(spark, sf, "events").select("event_id", "user_id", "value")
    return formats.merge_pages([e.where("value > 20"), e.where("value < 60").withColumn("value", F.col("value") + 1)], "event_id", "value").select("event_id", "value")


@query("f17_f18_validity", ctes("cells") + " select cell_id, cast(x > 0 and x < 600 and y > 0 and y < 600 as int) as band, cast(x > 0 and x < 600 and y > 0 and y < 600 and population > 0 as int) as valid from cells_")
def f17(spark, sf):
    band = S.elevation_ok(F.col("x"), F.col("y"), 600.0)
    return load(spark, sf, "cells").select("cell_id", band.alias("band"), S.all_valid(band, (F.col("population") > 0).cast("int")).alias("valid"))


@query("g21_tier_medians", ctes("matrix") + " select case when orig_id < 5 then 'c2c' when orig_id < 12 then 'c2z' else 'z2z' end as tier, quantile_cont(value, 0.5) as median, count(*) as n from matrix_ group by 1")
def g21(spark, sf):
    tier = F.when(F.col("orig_id") < 5, "c2c").when(F.col("orig_id") < 12, "c2z").otherwise("z2z")
    return X.tier_medians(load(spark, sf, "matrix").withColumn("tier", tier).withColumn("value", F.col("value").cast("double")))


@query("e13_counter_evaluation", f"with r as (select case when o_orderkey % 8 >= 6 then 'highway' when o_orderkey % 8 >= 3 then 'main' else 'local' end as tier, o_totalprice / 1000 as m, o_totalprice / 1100 + o_orderkey % 17 as p from orders) select tier, {AGREE} from r group by tier")
def e13(spark, sf):
    o = tab(spark, sf, "orders").select(F.col("o_orderkey").alias("edge_id"), (F.col("o_totalprice") / 1000).alias("counted"), (F.col("o_orderkey") % 8).alias("rank"), (F.col("o_totalprice") / 1100 + F.col("o_orderkey") % 17).alias("flow_estimate"))
    out = X.evaluated_counters(o.drop("flow_estimate"), o.select("edge_id", "flow_estimate"))
    return rounded(out, *[c for c in out.columns if c not in ("tier", "n")])


@query("p19_prefixes", "select c_custkey, c_name from customer")
def p19(spark, sf):
    return X.with_prefixes(tab(spark, sf, "customer"), ("c_cust", "c_name"))
