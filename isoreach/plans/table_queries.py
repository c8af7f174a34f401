"""Queries of the relational operators: joins, group aggregates, windows, order, sets, scalar functions."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from isoreach.functions import survey as S
from isoreach.operators import stats as V
from isoreach.operators import survey as T
from isoreach.plans.domain import ctes, load, query
from isoreach.sources import catalog as K


def rounded(df, *cols: str, digits: int = 4):
    return df.withColumns({c: F.round(c, digits) for c in cols})


@query("j1_keyed_lookup", ctes("cells", "zones") + " select cell_id, region_id from cells_ c left join (select * from zones_ where region_id <> 2) z on c.zone_id = z.zone_id")
def j1(spark, sf):
    z = load(spark, sf, "zones").where("region_id <> 2").select("zone_id", "region_id")
    return load(spark, sf, "cells").join(z, "zone_id", "left").select("cell_id", "region_id")


@query("j2_layered_override", ctes("cells") + " select cell_id, zone_id, case when cell_id % 3 = 0 then null else round(population * 2, 4) end as population from cells_")
def j2(spark, sf):
    c = load(spark, sf, "cells")
    later = c.select("cell_id", F.when(F.col("cell_id") % 3 != 0, F.round(F.col("population") * 2, 4)).alias("population"))
    return K.layered([c.select("cell_id", "zone_id", "population"), later], "cell_id").select("cell_id", "zone_id", "population")


@query("j28_private_override", ctes("cells") + ", priv as (select cell_id, population * 3 as population from cells_ where segment = 'BUILDING') select c.cell_id, round(case when c.zone_id < 5 then coalesce(p.population, 0) else c.population end, 4) as population from cells_ c left join priv p on p.cell_id = c.cell_id")
def j28(spark, sf):
    c = load(spark, sf, "cells").select("cell_id", "zone_id", "population")
    priv = load(spark, sf, "cells").where("segment = 'BUILDING'").select("cell_id", (F.col("population") * 3).alias("population"))
    return rounded(K.override(c, priv, "cell_id", ["population"], c.where("zone_id < 5").select("cell_id")).select("cell_id", "population"), "population")


@query("j24_full_outer_modes", ctes("matrix") + """, a as (select orig_id, dest_id, min(value) as va from matrix_ where value < 10 group by 1, 2), b as (select orig_id, dest_id, max(value) as vb from matrix_ where value > 49 group by 1, 2)
  select coalesce(a.orig_id, b.orig_id) as orig_id, coalesce(a.dest_id, b.dest_id) as dest_id, va, vb from a full join b on a.orig_id = b.orig_id and a.dest_id = b.dest_id""")
def j24(spark, sf):
    m = load(spark, sf, "matrix")
    long = m.where("value < 10").withColumn("mode", F.lit("a")).unionByName(m.where("value > 49").withColumn("mode", F.lit("b")))
    g = long.groupBy("orig_id", "dest_id")  # one shuffle instead of an outer join's two
    return g.agg(F.min(F.when(F.col("mode") == "a", F.col("value"))).alias("va"), F.max(F.when(F.col("mode") == "b", F.col("value"))).alias("vb"))


@query("j25_pick_by_key", "select o_orderkey, case o_orderstatus when 'F' then o_totalprice when 'O' then o_totalprice * 0.5 end as picked from orders")
def j25(spark, sf):
    o = spark.read.parquet(f"{sf}/orders.parquet")
    return o.select("o_orderkey", F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")).when(F.col("o_orderstatus") == "O", F.col("o_totalprice") * 0.5).alias("picked"))


@query("j27_semi_anti", "select c_custkey, exists (select 1 from orders where o_custkey = c_custkey and o_totalprice > 300000) as has_big from customer where c_custkey not in (select o_custkey from orders where o_orderstatus = 'P')")
def j27(spark, sf):
    c, o = spark.read.parquet(f"{sf}/customer.parquet").select("c_custkey"), spark.read.parquet(f"{sf}/orders.parquet")
    c = c.join(o.where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_anti")
    big = o.where("o_totalprice > 300000").select(F.col("o_custkey").alias("b")).distinct()
    return c.join(big, F.col("c_custkey") == F.col("b"), "left").select("c_custkey", F.col("b").isNotNull().alias("has_big"))


@query("j29_fallback_chain", ctes("cells", "dests") + ", a as (select dest_zone, category, max(weight) as w from dests_ group by 1, 2), b as (select dest_zone, max(weight) as w from dests_ group by 1) select cell_id, round(coalesce(a.w, b.w), 4) as w, case when a.w is not null then 'class' when b.w is not null then 'zone' end as level from cells_ c left join a on a.dest_zone = c.zone_id and a.category = c.cell_id % 3 left join b on b.dest_zone = c.zone_id")
def j29(spark, sf):
    d = load(spark, sf, "dests")
    a = d.groupBy(F.col("dest_zone").alias("az"), F.col("category").alias("ac")).agg(F.max("weight").alias("aw"))
    b = d.groupBy(F.col("dest_zone").alias("bz")).agg(F.max("weight").alias("bw"))
    c = load(spark, sf, "cells").join(a, (F.col("zone_id") == F.col("az")) & (F.col("cell_id") % 3 == F.col("ac")), "left").join(b, F.col("zone_id") == F.col("bz"), "left")
    return c.select("cell_id", F.round(F.coalesce("aw", "bw"), 4).alias("w"), F.when(F.col("aw").isNotNull(), "class").when(F.col("bw").isNotNull(), "zone").alias("level"))


@query("j30_infer_by_share", "with s as (select c_nationkey, avg(case when c_mktsegment = 'BUILDING' then 1.0 else 0.0 end) as share from customer group by 1) select c_custkey, case when share >= 0.21 then 1 when c_mktsegment = 'BUILDING' then 2 end as member from customer join s using (c_nationkey)")
def j30(spark, sf):
    c = spark.read.parquet(f"{sf}/customer.parquet")
    s = c.groupBy("c_nationkey").agg(F.avg((F.col("c_mktsegment") == "BUILDING").cast("double")).alias("share"))
    return c.join(s, "c_nationkey").select("c_custkey", F.when(F.col("share") >= 0.21, 1).when(F.col("c_mktsegment") == "BUILDING", 2).alias("member"))


@query("j31_composed_key", "with v as (select l_orderkey || '_' || l_linenumber as vid, l_quantity from lineitem) select o_orderkey, l_quantity from orders left join v on v.vid = o_orderkey || '_1'")
def j31(spark, sf):
    v = spark.read.parquet(f"{sf}/lineitem.parquet").select(F.concat_ws("_", "l_orderkey", "l_linenumber").alias("vid"), "l_quantity")
    o = spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey", F.concat_ws("_", "o_orderkey", F.lit("1")).alias("k"))
    return o.join(v, F.col("k") == F.col("vid"), "left").select("o_orderkey", "l_quantity")


@query("g1_sum_reindex", ctes("zones", "dests") + " select z.zone_id, round(coalesce(s, 0), 4) as s from zones_ z left join (select dest_zone, sum(weight) as s from dests_ where category = 1 group by 1) d on d.dest_zone = z.zone_id")
def g1(spark, sf):
    s = load(spark, sf, "dests").where("category = 1").groupBy(F.col("dest_zone").alias("zone_id")).agg(F.sum("weight").alias("s"))
    return load(spark, sf, "zones").select("zone_id").join(s, "zone_id", "left").select("zone_id", F.round(F.coalesce("s", F.lit(0.0)), 4).alias("s"))


@query("g2_count_pivot", ctes("dests") + ' select dest_zone, count(*) filter (where category = 0) as "c0", count(*) filter (where category = 1) as "c1", count(*) filter (where category = 2) as "c2" from dests_ group by dest_zone')
def g2(spark, sf):
    p = load(spark, sf, "dests").groupBy("dest_zone").pivot("category", [0, 1, 2]).count().na.fill(0)
    return p.withColumnsRenamed({"0": "c0", "1": "c1", "2": "c2"})


@query("g4_transform_sum", ctes("cells") + " select cell_id, round(sum(population) over (partition by zone_id), 4) as zone_total from cells_")
def g4(spark, sf):
    return load(spark, sf, "cells").select("cell_id", F.round(F.sum("population").over(Window.partitionBy("zone_id")), 4).alias("zone_total"))


@query("g8_weighted_columns", "select round(sum(cast(c_custkey % 2 as double) * greatest(c_acctbal, 0)) / sum(greatest(c_acctbal, 0)), 6) as sd_odd, round(sum(case when c_custkey % 5 <> 0 then c_nationkey * greatest(c_acctbal, 0) end) / sum(case when c_custkey % 5 <> 0 then greatest(c_acctbal, 0) end), 6) as sd_nation from customer")
def g8(spark, sf):
    c = spark.read.parquet(f"{sf}/customer.parquet")
    c = c.select((F.col("c_custkey") % 2).cast("double").alias("sd_odd"), F.when(F.col("c_custkey") % 5 != 0, F.col("c_nationkey").cast("double")).alias("sd_nation"), F.greatest("c_acctbal", F.lit(0.0)).alias("w"))
    return rounded(T.weighted_means(c, "w"), "sd_odd", "sd_nation", digits=6)


@query("g10_dissolve", ctes("cells") + " select zone_id, count(*) as n, round(sum(population), 4) as population, max(x) as x1, min(x) as x0, max(y) as y1, min(y) as y0 from cells_ group by zone_id")
def g10(spark, sf):
    return rounded(load(spark, sf, "cells").groupBy("zone_id").agg(F.count("*").alias("n"), F.sum("population").alias("population"), F.max("x").alias("x1"), F.min("x").alias("x0"), F.max("y").alias("y1"), F.min("y").alias("y0")), "population")


@query("g11_mode_first_seen", ctes("cells") + ", c as (select zone_id, segment, count(*) as n, min(cell_id) as f from cells_ group by 1, 2), r as (select *, row_number() over (partition by zone_id order by n desc, f) as rn from c) select zone_id, segment from r where rn = 1")
def g11(spark, sf):
    return V.mode_value(load(spark, sf, "cells"), ["zone_id"], "segment", "cell_id")


@query("g12_all_any", "select user_id, bool_and(value > 1) as all_above, bool_or(event_type = 'click') as any_click from events group by user_id")
def g12(spark, sf):
    return load(spark, sf, "events").groupBy("user_id").agg(F.bool_and(F.col("value") > 1).alias("all_above"), F.bool_or(F.col("event_type") == "click").alias("any_click"))


@query("g13_first_last", "select user_id, arg_min(event_type, (ts, event_id)) as first_type, arg_max(event_type, (ts, event_id)) as last_type from events group by user_id")
def g13(spark, sf):
    at = F.struct("ts", "event_id")
    return load(spark, sf, "events").groupBy("user_id").agg(F.min_by("event_type", at).alias("first_type"), F.max_by("event_type", at).alias("last_type"))


@query("g14_quantiles", ctes("cells") + " select zone_id, round(quantile_cont(population, 0.05), 4) as p5, round(quantile_cont(population, 0.5), 4) as p50, round(quantile_cont(population, 0.95), 4) as p95 from cells_ group by zone_id")
def g14(spark, sf):
    return rounded(V.quantiles(load(spark, sf, "cells"), ["zone_id"], "population", {"p5": 0.05, "p50": 0.5, "p95": 0.95}), "p5", "p50", "p95")


@query("g16_binned_stats", ctes("cells") + """, b as (select cast(case when x > 0 and x <= 5 then 0 when x > 5 and x <= 300 then 1 when x > 300 and x <= 600 then 2 when x > 600 and x <= 999 then 3 end as int) as bin, population from cells_)
  select bin, count(*) as n, case when count(*) >= 20 then round(avg(population), 4) end as mean, case when count(*) >= 20 then round(quantile_cont(population, 0.5), 4) end as median from b where bin is not null group by bin""")
def g16(spark, sf):
    return rounded(V.binned_stats(load(spark, sf, "cells"), "x", "population", [0, 5, 300, 600, 999], 20), "mean", "median")


@query("g17_raster_mean", ctes("cells") + " select cast(floor(x / 20) as bigint) * 50 + cast(floor(y / 20) as bigint) as px, round(sum(population) / count(*), 4) as z from cells_ group by 1")
def g17(spark, sf):
    px = F.floor(F.col("x") / 20).cast("long") * 50 + F.floor(F.col("y") / 20).cast("long")
    return rounded(load(spark, sf, "cells").groupBy(px.alias("px")).agg((F.sum("population") / F.count("*")).alias("z")), "z")


@query("g18_density_panel", "with a as (select c_nationkey as area, year(o_orderdate) as yr, sum(o_totalprice) as v, count(*) as n from customer join orders on o_custkey = c_custkey group by 1, 2), g as (select n_nationkey as area, yr from nation cross join (select distinct year(o_orderdate) as yr from orders)) select cast(g.area as bigint) as area, cast(g.yr as bigint) as yr, round(coalesce(v, 0) / 100, 2) as per_area, round(coalesce(v / nullif(n, 0), 0), 2) as per_order from g left join a on a.area = g.area and a.yr = g.yr")
def g18(spark, sf):
    c, o, n = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("customer", "orders", "nation"))
    a = o.join(c, F.col("o_custkey") == F.col("c_custkey")).groupBy(F.col("c_nationkey").alias("aa"), F.year("o_orderdate").alias("ay")).agg(F.sum("o_totalprice").alias("v"), F.count("*").alias("n"))
    years = o.select(F.year("o_orderdate").alias("yr")).distinct().agg(F.collect_set("yr").alias("ys"))  # a few years
    g = n.select(F.col("n_nationkey").alias("area")).crossJoin(F.broadcast(years)).select("area", F.explode("ys").alias("yr"))
    out = g.join(a, (F.col("area") == F.col("aa")) & (F.col("yr") == F.col("ay")), "left")
    return out.select(F.col("area").cast("long").alias("area"), F.col("yr").cast("long").alias("yr"), F.round(F.coalesce("v", F.lit(0.0)) / 100, 2).alias("per_area"), F.round(F.coalesce(F.col("v") / F.col("n"), F.lit(0.0)), 2).alias("per_order"))


@query("g19_length_weighted", "with s as (select l_suppkey, l_returnflag, sum(l_quantity) as l from lineitem group by 1, 2), m as (select l_suppkey, arg_max(l_returnflag, (l, l_returnflag)) as flag from s group by 1), w as (select l_suppkey, round_even(sum(l_discount * l_quantity) / sum(l_quantity), 2) as d from lineitem group by 1) select l_suppkey, d as l_discount, flag as l_returnflag from w join m using (l_suppkey)")
def g19(spark, sf):
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    return V.length_weighted(li, ["l_suppkey"], "l_discount", "l_quantity").join(V.length_weighted(li, ["l_suppkey"], "l_returnflag", "l_quantity", mode=True), "l_suppkey")


@query("g22_conditional_distinct", "select event_type, count(distinct user_id) as users, count(distinct case when value > 50 then user_id end) as big from events group by event_type")
def g22(spark, sf):
    return load(spark, sf, "events").groupBy("event_type").agg(F.count_distinct("user_id").alias("users"), F.count_distinct(F.when(F.col("value") > 50, F.col("user_id"))).alias("big"))


@query("g23_top_codes", "select p_brand, count(*) as n from part group by p_brand order by n desc, p_brand limit 8")
def g23(spark, sf):
    return spark.read.parquet(f"{sf}/part.parquet").groupBy("p_brand").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "p_brand").limit(8)


@query("g25_having", ctes("cells") + " select zone_id, round(sum(population), 4) as population from cells_ group by zone_id having sum(population) > 250000")
def g25(spark, sf):
    return rounded(load(spark, sf, "cells").groupBy("zone_id").agg(F.sum("population").alias("population")).where("population > 250000"), "population")


@query("g26_string_agg", "select s_nationkey, string_agg(s_suppkey::varchar, ';' order by s_suppkey) as members from supplier group by s_nationkey")
def g26(spark, sf):
    s = spark.read.parquet(f"{sf}/supplier.parquet")
    return s.groupBy("s_nationkey").agg(F.array_join(F.transform(F.sort_array(F.collect_list("s_suppkey")), lambda x: x.cast("string")), ";").alias("members"))


@query("g28_crosstab", "select l_returnflag, count(*) filter (where l_linestatus = 'F') as f, count(*) filter (where l_linestatus = 'O') as o from lineitem group by l_returnflag")
def g28(spark, sf):
    p = spark.read.parquet(f"{sf}/lineitem.parquet").groupBy("l_returnflag").pivot("l_linestatus", ["F", "O"]).count().na.fill(0)
    return p.withColumnsRenamed({"F": "f", "O": "o"})


@query("g29_grouping_sets", "select l_returnflag, l_linestatus, count(*) as n, cast(sum(l_quantity) as double) as q from lineitem group by cube (l_returnflag, l_linestatus)")
def g29(spark, sf):
    return spark.read.parquet(f"{sf}/lineitem.parquet").cube("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.sum("l_quantity").cast("double").alias("q"))


@query("w4_running_maximum", ctes("events") + " select event_id, max(value) over (partition by user_id order by ts, event_id rows between unbounded preceding and current row) as envelope from events_")
def w4(spark, sf):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    return load(spark, sf, "events").select("event_id", F.max("value").over(w).alias("envelope"))


@query("w10_first_seen_codes", ctes("cells") + ", f as (select segment, row_number() over (order by min(cell_id)) - 1 as code from cells_ group by segment) select cell_id, cast(code as bigint) as code from cells_ join f using (segment)")
def w10(spark, sf):
    out = T.first_seen_codes(load(spark, sf, "cells").select("cell_id", "segment"), "segment", "cell_id", "code")
    return out.select("cell_id", F.col("code").cast("long").alias("code"))


@query("w12_contiguous_prefix", "with b as (select distinct p_size as lo, p_size + 1 as hi from part where p_size not in (17, 30)), g as (select *, case when lo = lag(hi) over (order by lo) or lag(hi) over (order by lo) is null then 0 else 1 end as gap from b), s as (select *, sum(gap) over (order by lo rows between unbounded preceding and current row) as run from g) select lo, hi from s where run = 0")
def w12(spark, sf):
    b = spark.read.parquet(f"{sf}/part.parquet").where(~F.col("p_size").isin(17, 30)).select(F.col("p_size").alias("lo"), (F.col("p_size") + 1).alias("hi")).distinct()
    w = Window.orderBy("lo")  # the bins of one metric, a few dozen rows
    gap = F.coalesce((F.col("lo") != F.lag("hi").over(w)).cast("int"), F.lit(0))
    return b.withColumn("gap", gap).withColumn("run", F.sum("gap").over(w.rowsBetween(Window.unboundedPreceding, 0))).where("run = 0").select("lo", "hi")


@query("o1_trip_order", "select conv_id, turn, row_number() over (partition by conv_id order by turn) as pos from conversations")
def o1(spark, sf):
    legs = spark.read.parquet(f"{sf}/conversations.parquet").withColumn("leg_id", F.concat_ws("_", "conv_id", "turn"))
    w = Window.partitionBy("conv_id").orderBy(T.sequence_number(F.col("leg_id")))
    return legs.select("conv_id", "turn", F.row_number().over(w).cast("long").alias("pos"))


@query("o3_dedupe_keep_best", "with r as (select *, row_number() over (partition by p_brand, p_type order by p_retailprice desc, p_partkey) as rn from part) select p_brand, p_type, p_partkey from r where rn = 1")
def o3(spark, sf):
    p = spark.read.parquet(f"{sf}/part.parquet")
    return p.groupBy("p_brand", "p_type").agg(F.max_by("p_partkey", F.struct("p_retailprice", -F.col("p_partkey"))).alias("p_partkey"))


@query("o4_dedupe_keep_first", "with r as (select *, row_number() over (partition by user_id, event_type order by ts, event_id) as rn from events) select event_id, user_id, event_type from r where rn = 1")
def o4(spark, sf):
    e = load(spark, sf, "events").groupBy("user_id", "event_type").agg(F.min(F.struct("ts", "event_id")).alias("b"))
    return e.select(F.col("b.event_id").alias("event_id"), "user_id", "event_type")


@query("o5_exact_duplicates", "select count(*) as n_rows, (select count(*) from (select distinct l_returnflag, l_linestatus, l_quantity from lineitem)) as n_distinct from lineitem")
def o5(spark, sf):
    li = spark.read.parquet(f"{sf}/lineitem.parquet").select("l_returnflag", "l_linestatus", "l_quantity")
    g = li.groupBy(*li.columns).agg(F.count("*").alias("n"))
    return g.agg(F.sum("n").alias("n_rows"), F.count("*").alias("n_distinct"))


@query("o6_mapped_order", "select l_returnflag, l_linestatus, count(*) as n, case l_returnflag when 'R' then 0 when 'A' then 1 else 2 end as ord from lineitem group by 1, 2 order by ord, l_linestatus")
def o6(spark, sf):
    order = F.when(F.col("l_returnflag") == "R", 0).when(F.col("l_returnflag") == "A", 1).otherwise(2)
    return spark.read.parquet(f"{sf}/lineitem.parquet").groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n")).withColumn("ord", order).orderBy("ord", "l_linestatus")


@query("u1_union_by_name", "select c_custkey as id, c_acctbal as balance, cast(null as varchar) as brand from customer union all select p_partkey, null, p_brand from part")
def u1(spark, sf):
    a = spark.read.parquet(f"{sf}/customer.parquet").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance"))
    b = spark.read.parquet(f"{sf}/part.parquet").select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("brand"))
    return a.unionByName(b, allowMissingColumns=True)


@query("u2_union_distinct", "select c_nationkey as k from customer union select s_nationkey from supplier")
def u2(spark, sf):
    return spark.read.parquet(f"{sf}/customer.parquet").select(F.col("c_nationkey").alias("k")).union(spark.read.parquet(f"{sf}/supplier.parquet").select("s_nationkey")).distinct()


@query("u3_u5_set_differences", "select 'both' as part, k from (select distinct c_nationkey as k from customer where c_acctbal > 9500 intersect select s_nationkey from supplier where s_acctbal > 3000) union all select 'left', k from (select distinct c_nationkey as k from customer where c_acctbal > 9500 except select s_nationkey from supplier where s_acctbal > 3000) union all select 'right', k from (select distinct s_nationkey as k from supplier where s_acctbal > 3000 except select c_nationkey from customer where c_acctbal > 9500)")
def u3(spark, sf):
    a = spark.read.parquet(f"{sf}/customer.parquet").where("c_acctbal > 9500").select(F.col("c_nationkey").alias("k"))
    b = spark.read.parquet(f"{sf}/supplier.parquet").where("s_acctbal > 3000").select(F.col("s_nationkey").alias("k"))
    tag = lambda df, name: df.select(F.lit(name).alias("part"), "k")
    return tag(a.intersect(b), "both").unionByName(tag(a.subtract(b), "left")).unionByName(tag(b.subtract(a), "right"))


@query("f1_f7_code_decoding", """select o_orderkey, case when trim(o_orderpriority) in ('', '.') then null else try_cast(replace(substr(o_orderpriority, 1, 1) || ',' || o_orderkey % 10, ',', '.') as double) end as number,
  case substr(o_orderpriority, 1, 1) when '1' then 'urgent' when '2' then 'high' end as category, case when o_orderkey % 3 = 1 then 1 when o_orderkey % 3 = 2 then 0 end as flag,
  case when (o_orderkey * 7 % 4000) % 100 < 60 and floor((o_orderkey * 7 % 4000) / 100) <= 36 then floor((o_orderkey * 7 % 4000) / 100) * 60 + (o_orderkey * 7 % 4000) % 100 end::double as minutes from orders""")
def f1(spark, sf):
    o = spark.read.parquet(f"{sf}/orders.parquet")
    first = F.substring("o_orderpriority", 1, 1)
    return o.select(
        "o_orderkey",
        S.to_float(F.concat(first, F.lit(","), F.col("o_orderkey") % 10)).alias("number"),
        S.category(first, {1: "urgent", 2: "high", 3: None}).alias("category"),
        S.flag(F.col("o_orderkey") % 3).alias("flag"),
        S.hhmm_minutes(F.col("o_orderkey") * 7 % 4000).cast("double").alias("minutes"),
    )


@query("f5_any_flag", "select o_orderkey, cast(case when f = 1 or g = 1 then 1 when f = 0 and g = 0 then 0 end as int) as any_flag from (select o_orderkey, case o_orderkey % 3 when 1 then 1 when 2 then 0 end as f, case o_orderkey % 4 when 1 then 1 when 2 then 0 when 3 then 0 end as g from orders)")
def f5(spark, sf):
    k = F.col("o_orderkey")
    o = spark.read.parquet(f"{sf}/orders.parquet")
    return o.select("o_orderkey", S.any_flag(S.flag(k % 3), S.flag(k % 4, no=(2, 3))).alias("any_flag"))


@query("f10_bin_labels", "select c_custkey, case when a > -1 and a <= 6 then 'leq6' when a > 6 and a <= 13 then '7to13' when a > 13 and a <= 14 then '14' when a > 14 and a <= 99 then '15+' end as bin from (select c_custkey, c_custkey % 30 as a from customer)")
def f10(spark, sf):
    return spark.read.parquet(f"{sf}/customer.parquet").select("c_custkey", S.binned(F.col("c_custkey") % 30, [-1, 6, 13, 14, 99]).alias("bin"))


@query("f11_report_intervals", "with m as (select event_id, round_even(value * 60 / 60, 0) as m from events) select event_id, greatest(m - 0.5, 0) * 60 as exact_lo, (m + 0.5) * 60 as exact_hi, case when m % 5 = 0 then case when m = 5 then 0 else greatest(m - 2.5, 0) * 60 end end::double as rounded_lo, case when m % 5 = 0 then (m + 2.5) * 60 end as rounded_hi from m")
def f11(spark, sf):
    i = S.report_interval(F.col("value") * 60)
    return load(spark, sf, "events").select("event_id", *[i[c].alias(c) for c in ("exact_lo", "exact_hi", "rounded_lo", "rounded_hi")])


@query("f12_day_periods", "with e as (select event_id, hour(ts) as h, isodow(ts) <= 5 as wd from events) select event_id, case when wd and h in (8, 16, 17, 18) then 'peak' when (wd and h in (0,1,2,3,4,5,6,20,21,22,23)) or (not wd and h in (0,1,2,3,4,5,6,7,8,20,21,22,23)) then 'night' else 'base' end as peak_str from e")
def f12(spark, sf):
    weekday = F.dayofweek("ts").between(2, 6).cast("int")
    return load(spark, sf, "events").select("event_id", S.hours(F.hour("ts"), weekday)["peak_str"].alias("peak_str"))


@query("f13_daylight_season", """with t as (select event_id, ts, hour(ts) + minute(ts) / 60.0::double + second(ts) / 3600.0::double as h, dayofyear(ts) as doy, 47.0::double as lat, 8.0::double as lon from events),
  g as (select *, 2 * pi() / 365 * (doy - 1 + (h - 12) / 24) as g from t),
  s as (select *, 229.18 * (0.000075 + 0.001868 * cos(g) - 0.032077 * sin(g) - 0.014615 * cos(2 * g) - 0.040849 * sin(2 * g)) as eq, 0.006918 - 0.399912 * cos(g) + 0.070257 * sin(g) - 0.006758 * cos(2 * g) + 0.000907 * sin(2 * g) - 0.002697 * cos(3 * g) + 0.00148 * sin(3 * g) as d from g)
  select event_id, round(degrees(asin(sin(radians(lat)) * sin(d) + cos(radians(lat)) * cos(d) * cos(radians((h * 60 + eq + 4 * lon) / 4 - 180)))), 4) as altitude, case when month(ts) in (12, 1, 2) then 'winter' when month(ts) in (3, 4, 5) then 'spring' when month(ts) in (6, 7, 8) then 'summer' else 'fall' end as season from s""")
def f13(spark, sf):
    e = load(spark, sf, "events")
    return e.select("event_id", F.round(S.solar_altitude(F.col("ts"), F.lit(47.0), F.lit(8.0)), 4).alias("altitude"), S.season(F.month("ts")).alias("season"))


@query("f15_detour", ctes("cells") + " select cell_id, case when x > 0 and y / x > 3 then 0 else 1 end as ok from cells_")
def f15(spark, sf):
    return load(spark, sf, "cells").select("cell_id", S.within_detour(F.col("y"), F.col("x")).alias("ok"))


@query("f16_gap_flag", "with s as (select user_id, date_trunc('day', ts) as d, epoch(max(ts)) - epoch(min(ts)) as span, sum(value) * 60 as legs from events group by 1, 2) select user_id, d, case when span - legs >= -300 and span - legs <= least(1800, greatest(300, 0.5 * legs)) then 1 else 0 end as ok from s")
def f16(spark, sf):
    e = load(spark, sf, "events").groupBy("user_id", F.date_trunc("day", "ts").alias("d")).agg((F.unix_micros(F.max("ts").cast("timestamp")) / 1e6 - F.unix_micros(F.min("ts").cast("timestamp")) / 1e6).alias("span"), (F.sum("value") * 60).alias("legs"))
    return e.select("user_id", F.col("d").cast("timestamp_ntz").alias("d"), S.within_gap(F.col("span") - F.col("legs"), F.col("legs")).alias("ok"))


@query("f20_significant_digits", "select o_orderkey, case when o_totalprice = 0 then 0 else round_even(o_totalprice * power(10, 1 - floor(log10(abs(o_totalprice)))), 0) / power(10, 1 - floor(log10(abs(o_totalprice)))) end as price2 from orders")
def f20(spark, sf):
    from isoreach.operators.metrics import round_significant

    return spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey", round_significant(F.col("o_totalprice"), 2).alias("price2"))


@query("f21_coordinates", ctes("cells") + ", p as (select cell_id, (2600000 + x * 100 - 2600000) / 1e6 as a, (1200000 + y * 100 - 1200000) / 1e6 as b from cells_) select cell_id, round((2.6779094 + 4.728982 * a + 0.791484 * a * b + 0.1306 * a * b * b - 0.0436 * a * a * a) * 100 / 36, 6)::double as lon, round((16.9023892 + 3.238272 * b - 0.270978 * a * a - 0.002528 * b * b - 0.0447 * a * a * b - 0.0140 * b * b * b) * 100 / 36, 6)::double as lat from p")
def f21(spark, sf):
    ll = S.swiss_to_wgs84(2_600_000 + F.col("x") * 100, 1_200_000 + F.col("y") * 100)
    return load(spark, sf, "cells").select("cell_id", F.round(ll["lon"], 6).alias("lon"), F.round(ll["lat"], 6).alias("lat"))


@query("f33_log_interactions", ctes("cells") + " select cell_id, round(ln(1 + population), 6) as log_pop, round(ln(1 + population) * x, 4) as log_pop_x from cells_")
def f33(spark, sf):
    return load(spark, sf, "cells").select("cell_id", F.round(F.log1p("population"), 6).alias("log_pop"), F.round(F.log1p("population") * F.col("x"), 4).alias("log_pop_x"))


@query("f39_dummies", "select c_custkey, cast(c_mktsegment = 'BUILDING' as int) as sd_cat_BUILDING, cast(c_mktsegment = 'MACHINERY' as int) as sd_cat_MACHINERY, 0 as sd_cat_NONE from customer")
def f39(spark, sf):
    return T.dummies(spark.read.parquet(f"{sf}/customer.parquet").select("c_custkey", "c_mktsegment"), "c_mktsegment", ["BUILDING", "MACHINERY", "NONE"]).drop("c_mktsegment")


@query("f43_label_parse", "select p_partkey, try_cast(regexp_extract(p_brand, '([0-9]+)$', 1) as int) as num, regexp_extract(p_brand, '^([^0-9]+)', 1) as name from part")
def f43(spark, sf):
    return spark.read.parquet(f"{sf}/part.parquet").select("p_partkey", F.regexp_extract("p_brand", "([0-9]+)$", 1).try_cast("int").alias("num"), F.regexp_extract("p_brand", "^([^0-9]+)", 1).alias("name"))


@query("f48_json_props", "select event_id, array_to_string(list_sort(json_keys(props)), ',') as keys from events")
def f48(spark, sf):
    e = spark.read.parquet(f"{sf}/events.parquet")
    return e.select("event_id", F.array_join(F.array_sort(F.map_keys(F.from_json("props", "map<string,string>"))), ",").alias("keys"))


@query("p12_cohort_window", "select event_id from events where year(ts) + month(ts) / 100.0 >= 2024.02 and year(ts) + month(ts) / 100.0 <= 2024.05")
def p12(spark, sf):
    code = F.year("ts") + F.month("ts") / 100.0
    return load(spark, sf, "events").where((F.round(code, 2) >= 2024.02) & (F.round(code, 2) <= 2024.05)).select("event_id")


@query("p13_unlisted_codes", "select c_mktsegment, count(*) as n from customer where c_mktsegment not in ('BUILDING', 'MACHINERY') group by 1")
def p13(spark, sf):
    known = spark.createDataFrame([("BUILDING",), ("MACHINERY",)], "c_mktsegment string")
    return spark.read.parquet(f"{sf}/customer.parquet").join(F.broadcast(known), "c_mktsegment", "left_anti").groupBy("c_mktsegment").agg(F.count("*").alias("n"))


@query("p14_person_cascade", "select event_id from events where user_id not in (select user_id from events where value > 99)")
def p14(spark, sf):
    return T.person_cascade(load(spark, sf, "events"), "user_id", F.col("value") > 99).select("event_id")


@query("t9_detailed_weights", "with r as (select event_id, user_id, event_type, value, count(*) over (partition by user_id) as listed, count(*) filter (where event_type = 'click') over (partition by user_id) as detailed from events) select event_id, round(value * listed / detailed, 8) as value from r where event_type = 'click'")
def t9(spark, sf):
    e = load(spark, sf, "events").withColumn("listed", F.count("*").over(Window.partitionBy("user_id")))
    return rounded(T.detailed_weights(e, "user_id", "value", "listed", F.col("event_type") == "click").select("event_id", "value"), "value", digits=8)


@query("s14_number_lines", "select doc_id, cast(regexp_matches(text, '^\\s*\\d+\\s+\\d+\\s+-?[0-9.]+\\s*$') as boolean) as is_data from documents")
def s14(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", F.col("text").rlike(r"^\s*\d+\s+\d+\s+-?[0-9.]+\s*$").alias("is_data"))


@query("s31_group_points", "select coalesce(case when s_suppkey % 4 > 0 then s_nationkey end, s_suppkey) as stop, round(avg((s_suppkey * 53) % 1000), 4) as lon, round(avg((s_suppkey * 71) % 1000), 4) as lat from supplier group by 1")
def s31(spark, sf):
    s = spark.read.parquet(f"{sf}/supplier.parquet")
    k = F.coalesce(F.when(F.col("s_suppkey") % 4 > 0, F.col("s_nationkey").cast("long")), F.col("s_suppkey"))
    return rounded(s.groupBy(k.alias("stop")).agg(F.avg((F.col("s_suppkey") * 53) % 1000).alias("lon"), F.avg((F.col("s_suppkey") * 71) % 1000).alias("lat")), "lon", "lat")


@query("f19_distance_and_k1", ctes("cells") + " select cell_id, round(sqrt((x - 500) * (x - 500) + (y - 500) * (y - 500)), 4) as dist from cells_")
def f19(spark, sf):
    return K.check_key(load(spark, sf, "cells"), "cell_id").select("cell_id", F.round(F.hypot(F.col("x") - 500, F.col("y") - 500), 4).alias("dist"))


@query("str1_sessions", """with e as (select user_id, ts, case when ts - lag(ts) over (partition by user_id order by ts) < interval 30 minute then 0 else 1 end as fresh from events),
  s as (select *, sum(fresh) over (partition by user_id order by ts rows between unbounded preceding and current row) as sid from e) select user_id, min(ts) as start, max(ts) + interval 30 minute as "end", count(*) as n from s group by user_id, sid""")
def sessions(spark, sf):
    from isoreach.streaming.windows import sessions as run

    out = run(load(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp")), "user_id", "ts")
    return out.select("user_id", F.col("start").cast("timestamp_ntz").alias("start"), F.col("end").cast("timestamp_ntz").alias("end"), "n")


@query("str2_day_periods", "with e as (select value, hour(ts) as h, isodow(ts) <= 5 as wd from events) select case when wd and h in (8, 16, 17, 18) then 'peak' when (wd and h in (0,1,2,3,4,5,6,20,21,22,23)) or (not wd and h in (0,1,2,3,4,5,6,7,8,20,21,22,23)) then 'night' else 'base' end as peak_str, count(*) as n, round(avg(value), 4) as mean from e group by 1")
def day_periods(spark, sf):
    from isoreach.streaming.windows import by_day_period

    return rounded(by_day_period(load(spark, sf, "events"), "ts", "value"), "mean")
