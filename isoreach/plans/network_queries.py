"""Queries of road tags, graphs, routing, land use, trips and estimators."""

from __future__ import annotations

from pyspark.sql import functions as F

from isoreach.functions import osm as M
from isoreach.operators import dasymetric as D
from isoreach.operators import estimators as E
from isoreach.operators import graph as N
from isoreach.operators import routing as R
from isoreach.operators import survey as T
from isoreach.operators.validation import spec_grid
from isoreach.plans.domain import ctes, load, query

# ---- road tags: made from the orders' keys ----

HIGHWAYS = ["motorway", "trunk", "primary", "secondary", "tertiary", "residential", "living_street", "service", "footway", "cycleway", "path", "steps", "construction"]
CHOICES = {
    "bicycle": (11, {0: "no", 1: "yes", 2: "dismount", 3: "use_sidepath"}),
    "foot": (9, {0: "no", 1: "use_sidepath"}),
    "access": (10, {0: "private", 1: "no", 2: "yes"}),
    "motor_vehicle": (8, {0: "no", 1: "destination"}),
    "motorroad": (17, {0: "yes"}),
    "service": (4, {0: "alley", 1: "driveway"}),
    "oneway": (6, {0: "yes", 1: "-1"}),
    "oneway:bicycle": (7, {0: "no", 1: "yes"}),
    "maxspeed": (12, {0: "50", 1: "30 mph", 2: "CH:urban", 3: "DE:rural", 4: "GB:nsl_single", 5: "50;80", 6: "junk", 7: "0", 8: "20"}),
    "lanes": (5, {0: "2", 1: "2;3", 2: "4"}),
    "surface": (7, {0: "asphalt", 1: "sett", 2: "gravel", 3: "grass", 4: "odd"}),
    "smoothness": (3, {0: "bad", 1: "good"}),
    "cycleway_dir": (6, {0: "track", 1: "lane"}),
    "oneway_motor": (4, {0: "1"}),
}


def _tag_sql(name: str) -> str:
    if name == "highway":
        return "case o_orderkey % 13 " + " ".join(f"when {k} then '{v}'" for k, v in enumerate(HIGHWAYS)) + " end"
    n, values = CHOICES[name]
    return f"case (o_orderkey // 13) % {n} " + " ".join(f"when {k} then '{v}'" for k, v in values.items()) + " end"


TAGS = "with t as (select o_orderkey as way_id, " + ", ".join(f'{_tag_sql(k)} as "{k}"' for k in ("highway", *CHOICES)) + " from orders)"


def ways(spark, sf):
    o = spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey")
    cols = [x for k in ("highway", *CHOICES) for x in (F.lit(k), F.expr(_tag_sql(k).replace("//", "div")))]
    full = F.create_map(*cols)
    return o.select(F.col("o_orderkey").alias("way_id"), F.map_filter(full, lambda _, v: v.isNotNull()).alias("tags"))


_CLOSED = "coalesce(access in ('private', 'no'), false)"
_BIKE_OVER = "coalesce(bicycle not in ('no', 'private'), false)"
_FOOT_OVER = "coalesce(foot not in ('no', 'private'), false)"
_CAR_OVER = "coalesce(motor_vehicle in ('yes', 'designated', 'permissive', 'destination', 'customers'), false)"


@query("p1_way_usability", TAGS + f""" select way_id,
  highway <> 'construction' and highway <> 'motorway' and not ({_CLOSED} and not {_FOOT_OVER}) and coalesce(foot <> 'no', true) and coalesce(motorroad <> 'yes', true) as walk,
  highway not in ('construction', 'motorway', 'trunk', 'steps') and not ({_CLOSED} and not {_BIKE_OVER}) and coalesce(bicycle <> 'no', true) and coalesce(motorroad <> 'yes', true) as bike,
  highway in ('motorway', 'trunk', 'primary', 'secondary', 'tertiary', 'residential', 'living_street', 'service') and not (highway = 'service' and coalesce(service <> 'alley', true)) and not ({_CLOSED} and not {_CAR_OVER}) and coalesce(motor_vehicle <> 'no', true) as drive from t""")
def p1(spark, sf):
    return ways(spark, sf).select("way_id", *[M.usable(F.col("tags"), m).alias(m) for m in ("walk", "bike", "drive")])


@query("p2_sidepath_rule", TAGS + """ select way_id, case when highway in ('trunk', 'primary', 'secondary', 'tertiary', 'residential', 'living_street', 'service') and bicycle = 'use_sidepath' then 'bicycle=use_sidepath' end as bike,
  case when highway in ('trunk', 'primary', 'secondary', 'tertiary', 'residential', 'living_street', 'service') and foot = 'use_sidepath' then 'sidewalks mapped separately' end as walk from t""")
def p2(spark, sf):
    return ways(spark, sf).select("way_id", M.sidepath_reason(F.col("tags"), "bike").alias("bike"), M.sidepath_reason(F.col("tags"), "walk").alias("walk"))


_PUSHED = "(not coalesce(bicycle in ('yes'), false) and (coalesce(bicycle = 'dismount', false) or highway in ('footway', 'steps')))"


@query("p3_push_rule", TAGS + f" select way_id, {_PUSHED} as pushed from t")
def p3(spark, sf):
    return ways(spark, sf).select("way_id", M.pushed(F.col("tags")).alias("pushed"))


_SPEED = "case maxspeed when '50' then 50 when '30 mph' then 30 * 1.609344::double when 'CH:urban' then 50 when 'DE:rural' then 100 when 'GB:nsl_single' then 60 * 1.609344::double when '50;80' then 80 when '20' then 20 end::double"


@query("f23_maxspeed", TAGS + f" select way_id, round({_SPEED}, 4) as kmh from t")
def f23(spark, sf):
    return ways(spark, sf).select("way_id", F.round(M.maxspeed_kmh(M.tag(F.col("tags"), "maxspeed")), 4).alias("kmh"))


@query("f22_lanes", TAGS + " select way_id, case when lanes is null then 1 when oneway = 'yes' then case lanes when '4' then 4 else 2 end else case lanes when '4' then 2 else 1 end end::double as per_direction from t")
def f22(spark, sf):
    return ways(spark, sf).select("way_id", M.lanes_per_direction(M.tag(F.col("tags"), "lanes"), M.tag(F.col("tags"), "oneway") == "yes").alias("per_direction"))


@query("f24_directions", TAGS + """ select way_id, case when oneway = '-1' then false else true end as drive_fwd, case when oneway = 'yes' then false else true end as drive_back,
  case when "oneway:bicycle" in ('no', 'yes') then true when oneway = '-1' then false else true end as bike_fwd, case "oneway:bicycle" when 'no' then true when 'yes' then false else case when oneway = 'yes' then false else true end end as bike_back from t""")
def f24(spark, sf):
    d, b = M.directions(F.col("tags"), "drive"), M.directions(F.col("tags"), "bike")
    return ways(spark, sf).select("way_id", d["forward"].alias("drive_fwd"), d["backward"].alias("drive_back"), b["forward"].alias("bike_fwd"), b["backward"].alias("bike_back"))


@query("f26_surface", TAGS + " select way_id, case surface when 'asphalt' then 'paved' when 'sett' then 'cobble' when 'gravel' then case smoothness when 'bad' then 'unpaved_rough' else 'unpaved_smooth' end when 'grass' then case smoothness when 'good' then 'unpaved_smooth' else 'unpaved_rough' end end as surface from t")
def f26(spark, sf):
    return ways(spark, sf).select("way_id", M.surface_type(F.col("tags")).alias("surface"))


_MAIN = "highway in ('motorway', 'trunk', 'primary', 'secondary', 'tertiary')"
_V = f"coalesce({_SPEED}, case when {_MAIN} then 50 else 30 end)"
_ROW = f"case when highway = 'living_street' or coalesce({_SPEED} <= 20, false) then 0 when not ({_MAIN}) then case when {_V} <= 30 then 1 else 2 end when {_V} <= 30 then 2 when {_V} > 50 then 4 else 3 end"


@query("f27_bike_stress", TAGS + f""", r as (select *, {_ROW} as rw, {_PUSHED} as push, (highway in ('cycleway', 'path', 'footway', 'steps') or coalesce(motor_vehicle = 'no', false) or ({_CLOSED} and not {_CAR_OVER})) as free from t),
  m as (select *, greatest(0, least(4, rw - case when oneway_motor is not null then 1 else 0 end + case when way_id % 3 = 0 then 1 else 0 end)) as mv from r)
  select way_id, case when push then null when free then 0 when cycleway_dir = 'track' then case rw when 0 then 0 when 1 then 0 when 2 then 1 when 3 then 2 else 3 end when cycleway_dir = 'lane' then case mv when 0 then 1 when 1 then 1 when 2 then 2 when 3 then 3 else 4 end else case mv when 0 then 1 when 1 then 2 when 2 then 3 when 3 then 4 else 5 end end::double as stress from m""")
def f27(spark, sf):
    slope = F.when(F.col("way_id") % 3 == 0, 0.08).otherwise(0.0)
    return ways(spark, sf).select("way_id", M.bike_stress(F.col("tags"), F.lit(None).cast("int"), slope).alias("stress"))


@query("f28_highway_rank", TAGS + " select way_id, case highway when 'motorway' then 7 when 'trunk' then 6 when 'primary' then 5 when 'secondary' then 4 when 'tertiary' then 3 when 'residential' then 2 when 'living_street' then 1 else -1 end as rank from t")
def f28(spark, sf):
    return ways(spark, sf).select("way_id", M.highest_rank(F.col("tags")).alias("rank"))


@query("s10_poi_tags", TAGS + """, m as (select way_id, 'rest' as category, 1.0::double as weight from t where highway = 'footway' union all select way_id, 'rest', 2.0::double from t where surface = 'grass' union all select way_id, 'fast', 3.0::double from t where maxspeed is not null) select way_id as osm_id, category, max(weight) as weight from m group by 1, 2""")
def s10(spark, sf):
    from isoreach.sources.formats import tag_matches

    features = ways(spark, sf).select(F.lit("way").alias("osm_type"), F.col("way_id").alias("osm_id"), "tags")
    wanted = [("highway", "footway", "rest", 1.0), ("surface", "grass", "rest", 2.0), ("maxspeed", "*", "fast", 3.0)]
    return tag_matches(features, wanted).select("osm_id", "category", "weight")


# ---- graphs ----

EDGES = ctes("edges").replace("with edges_", "with e0 as (select o_orderkey as way_id, o_custkey as u, (o_custkey * 7 + o_orderkey) % 1499 as v, o_totalprice / 1000 as w, o_orderkey % 8 as rank from orders), edges_")


def edges(spark, sf):
    o = spark.read.parquet(f"{sf}/orders.parquet")
    return o.selectExpr("o_orderkey as way_id", "o_custkey as u", "(o_custkey * 7 + o_orderkey) % 1499 as v", "o_totalprice / 1000 as w", "o_orderkey % 8 as rank")


_UND = EDGES + ", und as (select distinct least(u, v) as a, greatest(u, v) as b from e0 where u <> v), nb as (select node_id, count(*) as n from (select a as node_id, b as o from und union all select b, a from und) group by 1)"


@query("n10_junctions", _UND + " select node_id, cast(n = 3 as int) as is_t, cast(n >= 4 as int) as is_4way from nb")
def n10(spark, sf):
    return N.junction_flags(edges(spark, sf))


@query("n11_rank_flags", EDGES + ", x as (select u as node_id, rank from e0 union all select v, rank from e0) select node_id, max(rank) as rank_max, min(rank) as rank_min, cast(min(rank) >= 3 as int) as is_major, cast(max(rank) >= 3 and min(rank) <= 5 as int) as is_anchor from x group by 1")
def n11(spark, sf):
    return N.rank_flags(edges(spark, sf))


@query("n12_one_way", EDGES + " select e.way_id, not exists (select 1 from e0 b where b.u = e.v and b.v = e.u) as oneway from e0 e")
def n12(spark, sf):
    return N.one_way(edges(spark, sf)).select("way_id", "oneway")


@query("n6_dead_ends", _UND + ", sh as (select node_id, min(w) as l from (select u as node_id, w from e0 union all select v, w from e0) group by 1), gone as (select nb.node_id from nb join sh using (node_id) where n = 1 and l < 200) select way_id from e0 where u not in (select node_id from gone) and v not in (select node_id from gone)")
def n6(spark, sf):
    return N.prune_dead_ends(edges(spark, sf).withColumnRenamed("w", "length"), 200.0).select("way_id")


@query("n3_weak_components", EDGES.replace("with ", "with recursive ", 1) + """, und as (select distinct u as a, v as b from e0 union select distinct v, u from e0),
  reach as (select distinct a as node_id, a as root from und union select und.b, reach.root from reach join und on und.a = reach.node_id) select node_id, min(root) as component from reach group by node_id""")
def n3(spark, sf):
    return N.weak_components(spark, edges(spark, sf))


@query("n4_strong_component", EDGES.replace("with ", "with recursive ", 1) + """, e1 as (select distinct u, v from e0), f as (select 5::bigint as node_id union select v from f join e1 on u = node_id), g as (select 5::bigint as node_id union select u from g join e1 on v = node_id) select node_id from f intersect select node_id from g""")
def n4(spark, sf):
    return N.strong_component(spark, edges(spark, sf), 5)


@query("n17_nodes_to_edges", EDGES + ", nd as (select u as node_id, avg(w) as z from e0 group by u) select way_id, round((a.z + b.z) / 2, 8) as z from e0 left join nd a on a.node_id = u left join nd b on b.node_id = v")
def n17(spark, sf):
    e = edges(spark, sf)
    nodes = e.groupBy(F.col("u").alias("node_id")).agg(F.avg("w").alias("z"))
    return N.nodes_to_edges(e, nodes, ["z"]).select("way_id", F.round("z", 8).alias("z"))


@query("n18_smoothing", EDGES + """, nd as (select u as node_id, avg(rank) as z from e0 group by u), nr as (select node_id, o, min(w) as w from (select u as node_id, v as o, w from e0 where u <> v union all select v, u, w from e0 where u <> v) group by 1, 2),
  r as (select nr.node_id, nd.z, exp(-w * w / (2 * 100.0::double * 100.0::double)) as k from nr join nd on nd.node_id = nr.o union all select node_id, z, 1.0::double from nd) select node_id, round(sum(z * k) / sum(k), 4) as z from r group by 1""")
def n18(spark, sf):
    e = edges(spark, sf)
    nodes = e.groupBy(F.col("u").alias("node_id")).agg(F.avg("rank").alias("z"))
    return N.smooth(nodes, e.withColumnRenamed("w", "length"), "z", 100.0).select("node_id", F.round("z", 4).alias("z"))


@query("g24_round_trip_speed", EDGES + " select least(u, v) as a, greatest(u, v) as b, round(3.6::double * sum(w) / sum(w / (1 + rank)), 4) as speed_kph from e0 group by 1, 2")
def g24(spark, sf):
    e = edges(spark, sf).withColumns({"length": F.col("w"), "duration": F.col("w") / (1 + F.col("rank")), "k": F.lit(0)})
    return N.round_trip_speed(e).select("a", "b", F.round("speed_kph", 4).alias("speed_kph"))


WAYS = "with w0 as (select l_orderkey as way_id, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey) as pos, l_partkey as node_id from lineitem), uses as (select node_id, count(*) as n, bool_or(pos = lo or pos = hi) as is_end from w0 join (select way_id, min(pos) as lo, max(pos) as hi from w0 group by 1) using (way_id) group by node_id)"


def node_lists(spark, sf):
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    g = li.groupBy(F.col("l_orderkey").alias("way_id")).agg(F.sort_array(F.collect_list(F.struct("l_linenumber", F.col("l_partkey").alias("n")))).alias("s"))
    return g.select("way_id", F.transform("s", lambda x: x["n"]).alias("nodes"))


@query("n1_intersections", WAYS + " select node_id from uses where n >= 2 or is_end")
def n1(spark, sf):
    return N.intersections(node_lists(spark, sf))


@query("n2_segments", WAYS + """, c as (select way_id, w0.node_id, row_number() over (partition by way_id order by pos) as p from w0), cut as (select c.* from c join uses using (node_id) where n >= 2 or is_end),
  s as (select way_id, lag(node_id) over (partition by way_id order by p) as u, node_id as v, p - lag(p) over (partition by way_id order by p) as n_steps, row_number() over (partition by way_id order by p) - 1 as seg from cut) select way_id, cast(seg as int) as seg, u, v, cast(n_steps as int) as n_steps from s where u is not null""")
def n2(spark, sf):
    return N.segments(node_lists(spark, sf))


@query("r1_relaxation", EDGES.replace("with ", "with recursive ", 1) + """, e1 as (select u, v, min(w) as w from e0 group by 1, 2), o as (select distinct u as origin from e0),
  s as (select origin, origin as node, 0.0::double as cost, 0 as hops from o union all select s.origin, e1.v, s.cost + e1.w, s.hops + 1 from s join e1 on e1.u = s.node where s.cost + e1.w <= 60 and s.hops < 12)
  select origin, node, round(min(cost), 6) as cost from s group by 1, 2""")
def r1(spark, sf):
    e = edges(spark, sf)
    return R.relax(spark, e, e.select(F.col("u").alias("origin")).distinct(), 60.0).select("origin", "node", F.round("cost", 6).alias("cost"))


@query("r2_batched_search", EDGES.replace("with ", "with recursive ", 1) + """, e1 as (select u, v, min(w) as w from e0 group by 1, 2), o as (select distinct u as origin from e0),
  s as (select origin, origin as node, 0.0::double as cost, 0 as hops from o union all select s.origin, e1.v, s.cost + e1.w, s.hops + 1 from s join e1 on e1.u = s.node where s.cost + e1.w <= 60 and s.hops < 12)
  select origin, node, round(min(cost), 6) as cost from s group by 1, 2""")
def r2(spark, sf):
    e = edges(spark, sf)
    return R.search(spark, e, e.select(F.col("u").alias("origin")), 60.0).select("origin", "node", F.round("cost", 6).alias("cost"))


def _trip_paths(spark, sf):
    e = edges(spark, sf)
    trips = spark.read.parquet(f"{sf}/customer.parquet").selectExpr("c_custkey as trip_id", "c_nationkey + 1 as origin", "(c_custkey * 31) % 1499 as dest")
    return e, R.paths(spark, e, trips)


@query("r4_path_metrics", None)
def r4(spark, sf):
    _, p = _trip_paths(spark, sf)
    out = R.path_metrics(p.withColumn("climb", F.col("v") % 10), {"climb": "length_weighted"})
    return out.select("trip_id", F.round("cost", 4).alias("cost"), "n_edges", F.round("climb", 4).alias("climb"))


@query("r5_betweenness", None)
def r5(spark, sf):
    e, p = _trip_paths(spark, sf)
    return R.betweenness(p, e)


@query("r6_best_via", "with a as (select c_custkey as orig_id, c_custkey % 25 as stop, c_custkey % 17 as cost from customer union all select c_custkey, (c_custkey + 3) % 25, c_custkey % 11 from customer), m as (select l_suppkey % 25 as f, l_partkey % 25 as t, min(l_quantity) as cost from lineitem group by 1, 2), e as (select s_suppkey as dest_id, s_suppkey % 25 as stop, s_suppkey % 7 as cost from supplier) select orig_id, dest_id, min(a.cost + m.cost + e.cost) as cost from a join m on a.stop = f join e on t = e.stop group by 1, 2")
def r6(spark, sf):
    c, li, s = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("customer", "lineitem", "supplier"))
    a = c.selectExpr("c_custkey as orig_id", "c_custkey % 25 as stop", "c_custkey % 17 as cost").union(c.selectExpr("c_custkey", "(c_custkey + 3) % 25", "c_custkey % 11"))
    m = li.selectExpr("l_suppkey % 25 as from_stop", "l_partkey % 25 as to_stop", "l_quantity").groupBy("from_stop", "to_stop").agg(F.min("l_quantity").alias("cost"))
    return R.best_via(a, m, s.selectExpr("s_suppkey as dest_id", "s_suppkey % 25 as stop", "s_suppkey % 7 as cost"))


# ---- land use ----

CELLBOX = "cb as (select n_nationkey as cell_id, cast((n_nationkey % 5) * 200 as double) as cx0, cast((n_nationkey // 5) * 200 as double) as cy0, cast((n_nationkey % 5) * 200 + 200 as double) as cx1, cast((n_nationkey // 5) * 200 + 200 as double) as cy1, 100.0::double + n_nationkey * 10 as total from nation)"
INT = "it(tag, intensity) as (select distinct p_type, case when length(p_type) % 3 = 0 then null else 0.01::double * length(p_type) end from part)"


def _cell_boxes(spark, sf):
    n = spark.read.parquet(f"{sf}/nation.parquet")
    k = F.col("n_nationkey")
    x, y = (k % 5 * 200).cast("double"), (F.floor(k / 5) * 200).cast("double")
    return n.select(k.alias("cell_id"), x.alias("cx0"), y.alias("cy0"), (x + 200).alias("cx1"), (y + 200).alias("cy1"), (100.0 + k * 10).alias("total"))


def _intensities(spark, sf):
    n = F.length("p_type")
    return spark.read.parquet(f"{sf}/part.parquet").select(F.col("p_type").alias("tag"), F.when(n % 3 != 0, 0.01 * n).alias("intensity")).distinct()


@query("d1_allocation", ctes("buildings") + f""", {CELLBOX}, {INT}, o as (select building_id, cell_id, total, intensity * (least(x1, cx1) - greatest(x0, cx0)) * (least(y1, cy1) - greatest(y0, cy0)) as pred from buildings_ b join it on it.tag = b.tag and intensity is not null join cb on least(x1, cx1) > greatest(x0, cx0) and least(y1, cy1) > greatest(y0, cy0)),
  s as (select building_id, pred / sum(pred) over (partition by cell_id) * total as v from o) select building_id, round(sum(v), 4) as value from s group by 1 having sum(v) > 0""")
def d1(spark, sf):
    out = D.allocate(load(spark, sf, "buildings"), _cell_boxes(spark, sf), _intensities(spark, sf))
    return out.select("building_id", F.round("value", 4).alias("value"))


@query("d2_bottom_up", ctes("buildings") + f", {INT} select building_id, round_even(coalesce(intensity, 0) * area, 2) as value from buildings_ b join it on it.tag = b.tag")
def d2(spark, sf):
    return D.apply_intensities(load(spark, sf, "buildings"), _intensities(spark, sf)).select("building_id", "value")


@query("d3_proportional_split", ctes("buildings") + ", p as (select building_id % 40 as parent, building_id, area from buildings_), t as (select parent, 1000.0::double + parent as total, sum(area) as s from p group by parent) select building_id, round(case when parent < 30 then area / s * total else 0 end, 4) as split from p join t using (parent)")
def d3(spark, sf):
    b = load(spark, sf, "buildings").select("building_id", (F.col("building_id") % 40).alias("parent"), "area")
    parents = spark.range(30).select(F.col("id").alias("parent"), (1000.0 + F.col("id")).alias("total"))
    return D.split_in_proportion(b, "building_id", parents, "parent", "area").select("building_id", F.round("split", 4).alias("split"))


@query("j4_j5_category_merge", ctes("buildings") + " select tag, round(sum(case when building_id % 2 = 0 then area end), 2) as a, round(sum(case when building_id % 2 = 1 then area end), 2) as b from buildings_ group by tag")
def j4(spark, sf):
    b = load(spark, sf, "buildings")
    part = lambda k: b.where(F.col("building_id") % 2 == k).groupBy("tag").agg(F.sum("area").alias("value"))
    return D.merge_values({"a": part(0), "b": part(1)}, "tag").select("tag", F.round("a", 2).alias("a"), F.round("b", 2).alias("b"))


@query("d8_unmatched_tags", ctes("buildings") + f", {INT} select tag, count(*) as n from buildings_ where tag not in (select tag from it where intensity is not null) group by tag")
def d8(spark, sf):
    return D.unmatched_tags(load(spark, sf, "buildings"), _intensities(spark, sf).where("intensity is not null"))


@query("d4_nnls_intensities", None)
def d4(spark, sf):
    b, cells = load(spark, sf, "buildings"), _cell_boxes(spark, sf)
    return D.fit_intensities(spark, D.area_long(b, cells, 400.0), cells.select("cell_id", "total"))


@query("f37_strata", ctes("cells") + " select cell_id, case when population is null or population <= 1000 then 'rural' when population <= 5000 then 'suburban' else 'urban' end as stratum from cells_")
def f37(spark, sf):
    return load(spark, sf, "cells").select("cell_id", D.stratum(F.col("population"), [1000.0, 5000.0], ["rural", "suburban", "urban"]).alias("stratum"))


# ---- trips ----

LEGS = """with l as (select conv_id || '_' || turn as leg_id, conv_id as trip_id, case when turn % 4 = 1 then 'transit' when turn % 4 = 3 and conv_id % 5 = 0 then 'car' else 'walk' end as mode, turn, length(text) * 2.0::double as dist from conversations),
  legs as (select *, count(*) over (partition by trip_id) as n_legs_in_trip from l)"""


def legs(spark, sf):
    from pyspark.sql import Window

    c = spark.read.parquet(f"{sf}/conversations.parquet")
    t = F.col("turn") % 4
    mode = F.when(t == 1, "transit").when((t == 3) & (F.col("conv_id") % 5 == 0), "car").otherwise("walk")
    d = F.length("text") * 2.0
    out = c.select(F.concat_ws("_", "conv_id", "turn").alias("leg_id"), F.col("conv_id").alias("trip_id"), mode.alias("mode"), "turn", d.alias("dist_measured"))
    out = out.withColumn("n_legs_in_trip", F.count("*").over(Window.partitionBy("trip_id")))
    return out.withColumns({
        "time_measured": F.rint(F.col("dist_measured") / 90) * 60 + 60, "departure": F.col("turn") * 900.0 + 28_800, "arrival": F.col("turn") * 900.0 + 28_800 + F.rint(F.col("dist_measured") / 90) * 60 + 60,
        "orig_x": F.col("turn") * 300.0, "orig_y": F.lit(0.0), "dest_x": F.col("turn") * 300.0 + F.col("dist_measured") / 2, "dest_y": F.lit(0.0), "is_valid_dist_time": F.lit(1),
    })


@query("t1_drop_causes", LEGS + """, p as (select *, row_number() over (partition by trip_id order by turn) - 1 as pos from legs), f as (select *, min(case when mode = 'transit' then pos end) over (partition by trip_id) as ft, max(case when mode = 'transit' then pos end) over (partition by trip_id) as lt from p),
  g as (select trip_id, count(*) as present, count(*) filter (where mode = 'walk') as walks, count(*) filter (where mode = 'transit') as transits, count(*) filter (where mode = 'car') as feeders, count(*) filter (where mode = 'car' and pos > ft and pos < lt) as between_n, count(*) filter (where mode = 'car' and pos < ft) as before_n, count(*) filter (where mode = 'car' and pos > lt) as after_n from f group by 1)
  select trip_id, case when not ((present = 1 and walks = 1) or (transits = 0 and feeders = 1) or (transits >= 1 and between_n = 0 and before_n <= 1 and after_n <= 1)) then 'other leg combination' end as cause from g""")
def t1(spark, sf):
    return T.drop_causes(legs(spark, sf))


@query("t2_trips", None)
def t2(spark, sf):
    return T.trips(legs(spark, sf))


# ---- estimators ----


def _one_row(spark, values: dict):
    keys = list(values)
    return spark.createDataFrame([tuple(float(values[k]) for k in keys)], ", ".join(f"`{k}` double" for k in keys))


@query("e1_ols", ctes("cells") + " select round(regr_slope(population, x), 4) as slope, round(regr_intercept(population, x), 4) as const, round(regr_r2(population, x), 6) as r2 from cells_")
def e1(spark, sf):
    r = E.ols(load(spark, sf, "cells"), "population", ["x"])
    return _one_row(spark, {"slope": round(r["x"], 4), "const": round(r["const"], 4), "r2": round(r["r2"], 6)})


@query("e2_poisson", None)
def e2(spark, sf):
    rows = load(spark, sf, "cells").select((F.col("x") / 1000).alias("a"), (F.col("y") / 1000).alias("b"), F.floor(F.col("population") / 1000).alias("trips"))
    return _one_row(spark, E.poisson(rows, "trips", ["a", "b"]))


@query("e3_median_regression", None)
def e3(spark, sf):
    rows = load(spark, sf, "cells").select((F.col("x") / 1000).alias("a"), (F.col("population") / 1000).alias("t"))
    return _one_row(spark, E.median_regression(rows, "t", ["a"], rounds=25))


@query("e4_huber", None)
def e4(spark, sf):
    rows = load(spark, sf, "cells").select((F.col("x") / 1000).alias("a"), (F.col("population") / 1000).alias("t"))
    return _one_row(spark, E.huber(rows, "t", ["a"], scale=2.0, rounds=25))


@query("e5_interval_em", None)
def e5(spark, sf):
    rows = load(spark, sf, "cells").select((F.col("x") / 1000).alias("a"), F.floor(F.col("population") / 1000).alias("lo"), (F.floor(F.col("population") / 1000) + 1).alias("hi"))
    return _one_row(spark, E.interval_em(rows, "lo", "hi", ["a"], rounds=12, burn_in=6))


@query("e9_multinomial_logit", None)
def e9(spark, sf):
    c = load(spark, sf, "cells").select((F.col("x") / 500).alias("t_car"), (F.col("y") / 500).alias("t_bus"), F.when((F.col("cell_id") * 13 % 100) / 50.0 + F.col("x") / 500 < F.col("y") / 500 + 1, "car").otherwise("bus").alias("choice"))
    return _one_row(spark, E.multinomial_logit(c, "choice", {"car": {"asc_car": "1", "b_time": "t_car"}, "bus": {"b_time": "t_bus"}}, rounds=15))


@query("e9_nested_logit", None)
def e9_nested(spark, sf):
    c = load(spark, sf, "cells").select((F.col("x") / 500).alias("t_car"), (F.col("y") / 500).alias("t_bus"), (F.col("y") / 450 + 0.2).alias("t_rail"), F.when((F.col("cell_id") * 13 % 100) / 50.0 + F.col("x") / 500 < F.col("y") / 500 + 1, "car").when(F.col("cell_id") % 3 == 0, "rail").otherwise("bus").alias("choice"))
    return _one_row(spark, E.nested_logit(c, "choice", {"car": {"asc_car": "1", "b_time": "t_car"}, "bus": {"b_time": "t_bus"}, "rail": {"b_time": "t_rail"}}, {"road": ["car"], "public": ["bus", "rail"]}, rounds=12))


@query("e7_spec_grid", None)
def e7(spark, sf):
    rows = load(spark, sf, "cells").select((F.col("x") / 1000).alias("a"), (F.col("y") / 1000).alias("b"), (F.col("population") / 1000).alias("t"))
    fits = spec_grid(rows, "t", {"one": ["a"], "two": ["a", "b"]})
    return spark.createDataFrame([(k, float(f["const"]), float(f["a"]), float(f.get("b", 0.0)), float(f["r2"])) for k, f in sorted(fits.items())], "spec string, const double, a double, b double, r2 double")


@query("x3_volume_ratio", EDGES + " select way_id as edge_id, round(10 * w, 4) as flow_estimate, (case when rank >= 6 then 30000 when rank >= 3 then 15000 else 10000 end * 2)::double as capacity, round(power(least(10 * w / (case when rank >= 6 then 30000 when rank >= 3 then 15000 else 10000 end * 2), 2), 2), 8) as vc_beta from e0 where rank >= 4 union all select way_id, 0, (case when rank >= 6 then 30000 when rank >= 3 then 15000 else 10000 end * 2)::double, 0 from e0 where rank < 4")
def x3(spark, sf):
    from isoreach.operators.sampling import volume_ratio

    e = edges(spark, sf).select(F.col("way_id").alias("edge_id"), "w", "rank", F.lit(2.0).alias("lanes"))
    out = volume_ratio(e, e.where("rank >= 4").select("edge_id", F.col("w").alias("flow")), 10.0, [2.0])
    return out.select("edge_id", F.round("flow_estimate", 4).alias("flow_estimate"), "capacity", F.round(F.col("`vc_beta_2.0`"), 8).alias("vc_beta"))
