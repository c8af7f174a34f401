"""Queries of masks, temporal joins, overlays, predictions and callables."""

from __future__ import annotations

from pyspark.sql import functions as F

from isoreach.operators import routing as R
from isoreach.operators import sampling as P
from isoreach.operators import selection as L
from isoreach.operators import spatial as J
from isoreach.operators import survey as Y
from isoreach.operators import temporal as T
from isoreach.plans.domain import ctes, load, query


def tab(spark, sf, name):
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query("p6_calibration_mask", ctes("cells") + " select cell_id, population from cells_ where x between 200 and 800 and cell_id % 7 <> 0 and population > 0 and segment is not null")
def p6(spark, sf):
    c = load(spark, sf, "cells")
    node = F.when(F.col("cell_id") % 7 != 0, F.col("cell_id"))
    return c.where(L.calibration_mask(F.col("x").between(200, 800), node, F.col("population"), [F.when(F.col("segment").isNotNull(), 1.0)])).select("cell_id", "population")


@query("p7_car_roads", ctes("edges") + " select way_id, length from edges_ where string_split(priority, '-')[1] in ('1', '2', '3')")
def p7(spark, sf):
    return load(spark, sf, "edges").where(L.first_in(F.split("priority", "-"), ("1", "2", "3"))).select("way_id", "length")


@query("p9_cost_filter", ctes("events") + " select event_id, value from events_ where event_type = 'click' and user_id is not null and value between 5 and 60 and event_id % 5 > 0")
def p9(spark, sf):
    e = load(spark, sf, "events")
    return e.where(L.cost_mask(F.col("event_type"), "click", [F.col("user_id").isNotNull()], F.col("value"), F.col("event_id") % 5, 5, 60)).select("event_id", "value")


@query("p17_quality_flags", "select l_orderkey, l_linenumber from lineitem where l_quantity > 10 and l_discount < 0.05 and l_tax > 0.02")
def p17(spark, sf):
    li = tab(spark, sf, "lineitem").withColumns({"q": F.col("l_quantity") > 10, "d": F.col("l_discount") < 0.05, "t": F.col("l_tax") > 0.02})
    return li.where(L.flags_hold(["q", "d", "t"])).select("l_orderkey", "l_linenumber")


@query("p20_leg_selection", ctes("legs") + " select trip_id, turn, dist from legs_ where (role = 'user' and dist between 20 and 400) or (role = 'assistant' and dist > 100 and turn > 1)")
def p20(spark, sf):
    sets = [F.col("role") == "user", F.col("dist").between(20, 400)], [F.col("role") == "assistant", F.col("dist") > 100, F.col("turn") > 1]
    return load(spark, sf, "legs").where(L.any_of(*sets)).select("trip_id", "turn", "dist")


@query("j34_as_of", "with p as (select user_id as u, ts as pts, event_id as last_id, value as last_value from events where event_type = 'purchase'), m as (select e.event_id, max(struct_pack(pts := p.pts, last_value := p.last_value, last_id := p.last_id)) as b from events e join p on p.u = e.user_id and p.pts <= e.ts group by 1) select e.event_id, b.last_value as last_value, b.last_id as last_id from events e left join m using (event_id)")
def j34(spark, sf):
    e = tab(spark, sf, "events")
    bought = e.where("event_type = 'purchase'").select("user_id", F.col("ts").alias("pts"), F.col("value").alias("last_value"), F.col("event_id").alias("last_id"))
    return T.as_of(e.select("event_id", "user_id", "ts"), bought, "user_id", "ts", "pts", ["last_value", "last_id"]).select("event_id", "last_value", "last_id")


@query("j34_within_intervals", "with i as (select event_id as interval_id, user_id as u, ts as a, ts + interval 6 hour as b from events where event_id % 10 = 0) select e.event_id, i.interval_id from events e join i on i.u = e.user_id and e.ts >= i.a and e.ts < i.b")
def j34_intervals(spark, sf):
    e = tab(spark, sf, "events")
    i = e.where("event_id % 10 = 0").select(F.col("event_id").alias("interval_id"), "user_id", F.col("ts").alias("a"), (F.col("ts") + F.expr("interval 6 hours")).alias("b"))
    return T.within_intervals(e.select("event_id", "user_id", "ts"), i, "user_id", "ts", "a", "b", 6 * 3600.0).select("event_id", "interval_id")


@query("w13_neighbours", "select event_id, lag(value) over w as before, lead(value) over w as after, ntile(4) over w::int as tile from events window w as (partition by event_type order by ts, event_id)")
def w13(spark, sf):
    return T.neighbours_in_order(tab(spark, sf, "events"), "event_type", ["ts", "event_id"], "value", 4).select("event_id", "before", "after", "tile")


@query("w13_sliding", "select event_id, count(*) over w as n_recent, round(sum(value) over w, 4) as sum_recent from events window w as (partition by user_id order by cast(floor(epoch(ts)) as bigint) range between 86400 preceding and current row)")
def w13_sliding(spark, sf):
    return T.sliding(tab(spark, sf, "events"), "user_id", "ts", "value", 86_400).select("event_id", "n_recent", F.round("sum_recent", 4).alias("sum_recent"))


@query("u7_common_columns", ctes("cells", "zones") + " select 'zone_id,x,y' as common, (select count(*) from cells_)::bigint as n_a, (select count(*) from zones_)::bigint as n_b")
def u7(spark, sf):
    a, b = load(spark, sf, "cells"), load(spark, sf, "zones")
    names = ",".join(L.common_columns(a, b))
    return a.agg(F.count("*").alias("n_a")).crossJoin(b.agg(F.count("*").alias("n_b"))).select(F.lit(names).alias("common"), "n_a", "n_b")  # one row on either side


@query("f38_tag_rewrite", ctes("buildings") + " select building_id, case when brand in ('Brand#1', 'Brand#2', 'Brand#11', 'Brand#21') and tag is not null then brand || '__' || tag else brand end as tag from buildings_")
def f38(spark, sf):
    b = load(spark, sf, "buildings")
    return b.select("building_id", L.split_tag(F.col("brand"), F.col("tag"), ("Brand#1", "Brand#2", "Brand#11", "Brand#21")).alias("tag"))


@query("s13_buffered_area", ctes("cells") + " select cell_id from cells_ where sqrt(power(greatest(300 - x, x - 600, 0), 2) + power(greatest(200 - y, y - 500, 0), 2)) <= 50")
def s13(spark, sf):
    box = [(300.0, 200.0), (600.0, 200.0), (600.0, 500.0), (300.0, 500.0)]
    area = spark.createDataFrame([(1, box)], "area_id long, ring array<struct<x:double,y:double>>")
    return J.points_near_polygons(load(spark, sf, "cells"), "cell_id", area, 50.0).select("cell_id")


@query("s23_road_filter", "select o_orderkey as road_id from orders where o_orderpriority in ('1-URGENT', '2-HIGH') and o_orderstatus not in ('P') and o_custkey % 50 <> 0")
def s23(spark, sf):
    o = tab(spark, sf, "orders")
    state = F.when(F.col("o_orderstatus") == "P", "construction")
    return o.where(L.drivable(F.col("o_orderpriority"), ("1-URGENT", "2-HIGH"), state, F.col("o_custkey") % 50 == 0)).select(F.col("o_orderkey").alias("road_id"))


@query("s24_raster_mosaic", "with t as (select (l_partkey * 7) % 40 as col, (l_suppkey * 3) % 40 as row, l_linenumber as tile, l_quantity as value, l_orderkey from lineitem), b as (select col, row, max(struct_pack(tile := tile, value := value)) as m from t where col between 5 and 30 and row between 0 and 25 group by 1, 2) select col, row, m.value as value from b")
def s24(spark, sf):
    t = tab(spark, sf, "lineitem").selectExpr("(l_partkey * 7) % 40 as col", "(l_suppkey * 3) % 40 as row", "l_linenumber as tile", "l_quantity as value")
    from isoreach.sources.formats import mosaic

    return mosaic(t, (5, 0, 30, 25))


@query("k2_shapes", ctes("zones") + " select zone_id, region_id, x, y, 1 as note from zones_")
def k2(spark, sf):
    z = load(spark, sf, "zones").withColumns({"note": F.lit(1), "scratch": F.lit("z"), "geometry": F.array(F.struct("x", "y"))})
    return L.shapes(z, "zone_id", "geometry", ("x", "y", "region_id"), ("note",)).drop("geometry")


@query("n20_lean_graph", ctes("edges") + " select u, v, case when rank > 2 then length end as length, case when rank < 2 then rank end as rank from edges_ where rank > 2 or rank < 2")
def n20(spark, sf):
    e = load(spark, sf, "edges").withColumns({"length": F.when(F.col("rank") > 2, F.col("length")), "rank": F.when(F.col("rank") < 2, F.col("rank"))})
    return L.lean(e, ("u", "v"), ["length", "rank"])


@query("n22_edge_overlay", ctes("edges") + " select way_id, case when way_id % 5 = 0 then 50.0 when way_id % 3 = 0 then 30.0 else length end as length from edges_")
def n22(spark, sf):
    e = load(spark, sf, "edges").select("way_id", "length")
    layers = [e.where(f"way_id % {m} = 0").select("way_id", F.lit(v).alias("length")) for m, v in ((3, 30.0), (5, 50.0))]
    return L.overlaid(e, "way_id", layers, "length")


_TRIPS = ", t as (select o_orderkey as trip_id, o_custkey % 25 as orig_zone, o_orderkey % 25 as dest_zone, o_custkey as orig_cell, o_orderkey % 1000 as dest_cell from orders)"


def _trips(spark, sf):
    return tab(spark, sf, "orders").selectExpr("o_orderkey as trip_id", "o_custkey % 25 as orig_zone", "o_orderkey % 25 as dest_zone", "o_custkey as orig_cell", "o_orderkey % 1000 as dest_cell")


@query("c17_transit_prediction", ctes("matrix", "cells") + _TRIPS + ", z as (select orig_id, dest_id, avg(value) as value from matrix_ group by 1, 2), ov as (select cell_id, 60 + x / 10 as overhead from cells_) select trip_id, round(0.9 * z.value + a.overhead + b.overhead, 6) as predicted from t left join z on t.orig_zone = z.orig_id and t.dest_zone = z.dest_id left join ov a on a.cell_id = t.orig_cell left join ov b on b.cell_id = t.dest_cell")
def c17(spark, sf):
    z = load(spark, sf, "matrix").groupBy("orig_id", "dest_id").agg(F.avg("value").alias("value"))
    ov = load(spark, sf, "cells").select("cell_id", (60 + F.col("x") / 10).alias("overhead"))
    return L.transit_prediction(_trips(spark, sf), z, ov, 0.9).select("trip_id", F.round("predicted", 6).alias("predicted"))


@query("v6_predictions_by_mode", ctes("legs") + " select trip_id, turn, case role when 'user' then dist * 2 when 'assistant' then dist + 5 end as predicted from legs_")
def v6(spark, sf):
    rows = load(spark, sf, "legs").withColumns({"time_walk": F.col("dist") * 2, "time_car": F.col("dist") + 5})
    return rows.select("trip_id", "turn", L.picked(rows, F.col("role"), {"user": "time_walk", "assistant": "time_car"}).alias("predicted"))


@query("a8_wide_metrics", ctes("cells", "dests") + ", m as (select segment, category, count(*) as n from cells_ join dests_ on zone_id = dest_zone group by 1, 2) select segment, max(case when category = 0 then n end) as d0_5, max(case when category = 1 then n end) as \"d1_0.5\" from m group by 1")
def a8(spark, sf):
    c, d = load(spark, sf, "cells"), load(spark, sf, "dests")
    m = c.join(d, F.col("zone_id") == F.col("dest_zone")).groupBy("segment", "category").agg(F.count("*").alias("n"))
    m = m.select("segment", F.concat(F.lit("d"), F.col("category")).alias("dest"), F.when(F.col("category") == 0, 5.0).otherwise(0.5).alias("param"), "n")
    return L.wide(m, "segment", "dest", "param", "n", [("d0", 5), ("d1", 0.5)])


@query("z5_area_attributes", ctes("cells", "zones") + " select c.cell_id, min(z.zone_id) as area_id, min(z.region_id) as region_id from cells_ c join zones_ z on c.x >= z.x and c.x < z.x + 180 and c.y >= z.y and c.y < z.y + 140 group by 1")
def z5(spark, sf):
    z = load(spark, sf, "zones")
    at = lambda dx, dy: F.struct((F.col("x") + dx).cast("double").alias("x"), (F.col("y") + dy).cast("double").alias("y"))
    areas = z.select(F.col("zone_id").alias("area_id"), F.array(at(0, 0), at(180, 0), at(180, 140), at(0, 140)).alias("ring"))
    held = J.points_in_polygons(load(spark, sf, "cells").select("cell_id", "x", "y"), areas).groupBy("cell_id").agg(F.min("area_id").alias("area_id"))
    regions = held.join(z.select(F.col("zone_id").alias("area_id"), "region_id"), "area_id").select("cell_id", "area_id")
    everywhere = J.points_in_polygons(load(spark, sf, "cells").select("cell_id", "x", "y"), areas).join(z.select(F.col("zone_id").alias("area_id"), "region_id"), "area_id")
    return regions.join(everywhere.groupBy("cell_id").agg(F.min("region_id").alias("region_id")), "cell_id").select("cell_id", "area_id", "region_id")


@query("h2_endpoint_features", ctes("cells") + _TRIPS + " select trip_id, round(a.x / 100 + coalesce(b.x, 0) / 100, 6) as density from t join cells_ a on a.cell_id = t.orig_cell left join cells_ b on b.cell_id = t.dest_cell")
def h2(spark, sf):
    c = load(spark, sf, "cells").select("cell_id", "x")
    t = _trips(spark, sf).join(c.select(F.col("cell_id").alias("orig_cell"), F.col("x").alias("ox")), "orig_cell")
    t = t.join(c.select(F.col("cell_id").alias("dest_cell"), F.col("x").alias("dx")), "dest_cell", "left")
    out = L.endpoint_features(t, {"density": lambda df: (F.col("ox") / 100, F.col("dx") / 100)})
    return out.select("trip_id", F.round("density", 6).alias("density"))


@query("h5_mode_aggregators", ctes("matrix") + " select orig_id, dest_id, round(-ln(sum(exp(-0.1 * value))) / 0.1, 6) as logsum, min(value) as best from matrix_ group by 1, 2")
def h5(spark, sf):
    m, keys = load(spark, sf, "matrix"), ["orig_id", "dest_id"]
    a = L.over_modes(m, keys, "value", "logsum", 0.1).select(*keys, F.round("value", 6).alias("logsum"))
    return a.join(L.over_modes(m, keys, "value", F.min).withColumnRenamed("value", "best"), keys)


@query("r7_slot_percentiles", "select event_type, (floor((extract(hour from ts) * 60 + extract(minute from ts)) / 15) * 15)::bigint as slot, count(*) as n, round(quantile_cont(value, 0.5), 6) as p50, round(quantile_cont(value, 0.9), 6) as p90 from events where value is not null group by 1, 2")
def r7(spark, sf):
    e = tab(spark, sf, "events").withColumn("minute", F.hour("ts") * 60 + F.minute("ts"))
    out = L.slot_percentiles(e, ["event_type"], "minute", "value", [50, 90])
    return out.select("event_type", "slot", "n", F.round("p50", 6).alias("p50"), F.round("p90", 6).alias("p90"))


@query("h8_path_features", None)
def h8(spark, sf):
    e = load(spark, sf, "edges").groupBy("u", "v").agg(F.min("length").alias("w"))
    trips = e.select(F.col("u").alias("origin"), F.col("v").alias("dest")).distinct().where("origin < 5 and dest < 20").select((F.col("origin") * 100 + F.col("dest")).alias("trip_id"), "origin", "dest")
    rows = R.paths(spark, e, trips).withColumns({"slope": (F.col("u") - F.col("v")).cast("double"), "t": F.col("w") * (1 + F.col("u") % 3), "signals": (F.col("v") % 2).cast("double")})
    return R.path_metrics(rows, {"slope": "length_weighted", "signals": "duration_weighted", "t": "sum"}, duration="t")


@query("x2_destination_sample", None)
def x2(spark, sf):
    c, d = load(spark, sf, "cells").select("cell_id", "x", "y"), load(spark, sf, "dests").select("dest_id", "dx", "dy", "weight")
    places, members = J.once_a_place(c, "cell_id")
    near = J.within_radius(places, d.repartition(spark.sparkContext.defaultParallelism, "dest_id"), 300.0).withColumns({"bin": F.floor(F.col("dist") / 100).cast("int")})
    return P.nested_sample(near, "cell_id", "dest_id", "bin", "weight", {0: 0.5, 1: 0.3, 2: 0.2}, 20, 3, members)


@query("t10_legs", ctes("events") + ", o as (select *, lag(ts) over w as before_ts, lag(value) over w as before_value, row_number() over w as leg_no from events_ window w as (partition by user_id order by ts, event_id)) select user_id, event_id as leg_id, leg_no::int as leg_no, count(*) over (partition by user_id) as n_legs, case when before_ts is null then null else round((epoch(ts) - epoch(before_ts)) / 60.0, 4) end as gap_min, round(value - before_value, 4) as change from o")
def t10(spark, sf):
    out = Y.legs_in_order(load(spark, sf, "events"), "user_id", "event_id", "ts", "value")
    return out.select("user_id", "leg_id", "leg_no", "n_legs", F.round("gap_min", 4).alias("gap_min"), F.round("change", 4).alias("change"))


@query("t7_standard_year", "select '2020' || '_' || o_custkey as person_id, '2020' || '_' || o_custkey || '_' || row_number() over w as journey_id, o_orderkey as source_id, case o_orderpriority when '1-URGENT' then 'work' when '2-HIGH' then 'education' when '3-MEDIUM' then 'shopping' else 'other' end as purpose, case when o_totalprice > 0 then o_totalprice end as cost from orders window w as (partition by o_custkey order by o_orderdate, o_orderkey)")
def t7(spark, sf):
    raw = tab(spark, sf, "orders")
    spec = {"purpose": ("o_orderpriority", {"1-URGENT": "work", "2-HIGH": "education", "3-MEDIUM": "shopping"}, "other")}
    out = Y.standard_journeys(raw, "2020", "o_custkey", ["o_orderdate", "o_orderkey"], "o_orderkey", spec, {"cost": ("o_totalprice", [-97, -98, -99])})
    return out.select("person_id", "journey_id", "source_id", "purpose", "cost")
