"""Validation and the later stages' operators: exact baselines, group comparisons, edge durations, snapping, reports."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isoreach.operators import estimators, metrics, stats
from isoreach.operators.graph import bearing
from isoreach.operators.spatial import near_segments, points_in_polygons

ALONG_M, ALONG_SHARE = 20.0, 0.8


def both_ends_inside(trips: DataFrame, key: str, polygons: DataFrame) -> DataFrame:
    """Trips whose origin (ox, oy) and destination (dx, dy) are inside any of the polygons."""
    o = points_in_polygons(trips.select(key, F.col("ox").alias("x"), F.col("oy").alias("y")), polygons).select(key).distinct()
    d = points_in_polygons(trips.select(key, F.col("dx").alias("x"), F.col("dy").alias("y")), polygons).select(key).distinct()
    return trips.join(o, key, "left_semi").join(d, key, "left_semi")


def gates(rows: DataFrame, flags: list[str], null_passes: tuple[str, ...] = ()) -> DataFrame:
    """Rows for which all the flags that the table has are 1; listed flags also pass as null."""
    ok = F.lit(True)
    for f in flags:
        if f in rows.columns:
            ok = ok & F.coalesce(F.col(f) == 1, F.lit(f in null_passes))
    return rows.where(ok)


def eligible_cells(cells: DataFrame, zones: DataFrame, origins: bool) -> DataFrame:
    """Cells with a node and a snapped zone; origins must also be active."""
    z = zones.where("node_id is not null").select(F.col("zone_id").alias("_z"))
    out = cells.where("node_id is not null and zone_id is not null").join(z, F.col("zone_id") == F.col("_z"), "left_semi")
    return out.where("is_active = 1") if origins else out


def non_empty(units: DataFrame) -> DataFrame:
    return units.where("population > 0 or employment > 0 or n_pois > 0")


def edge_duration(length: Column, speed_kph: Column, alpha: float, multipliers: dict[str, float], additive: dict[str, float], slowest: float, fastest: float) -> Column:
    """Seconds on an edge: length over speed, times alpha plus the features' multipliers, plus additive features; the speed stays in its bounds."""
    base = length / (speed_kph / 3.6)
    factor = reduce(lambda a, b: a + b, [F.lit(m) * F.coalesce(F.col(f), F.lit(0.0)) for f, m in multipliers.items()], F.lit(alpha))
    extra = reduce(lambda a, b: a + b, [F.lit(m) * F.coalesce(F.col(f), F.lit(0.0)) for f, m in additive.items()], F.lit(0.0))
    return F.greatest(length / (fastest / 3.6), F.least(length / (slowest / 3.6), base * factor + extra))


def excluded(steps: Column, dz: Column, length: Column, steepest: float = 0.20) -> Column:
    """Whether an edge can't be used: steps, or a slope beyond the steepest."""
    return F.coalesce(steps > 0, F.lit(False)) | F.coalesce(F.abs(dz) / F.greatest(length, F.lit(0.1)) > steepest, F.lit(False))


def slope_features(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Rise, gain, loss and squared climb over length of each edge from its nodes' elevation; 0 on bridges and in tunnels."""
    a, b = nodes.select(F.col("node_id").alias("_a"), F.col("z").alias("_za")), nodes.select(F.col("node_id").alias("_b"), F.col("z").alias("_zb"))
    e = edges.join(a, F.col("u") == F.col("_a"), "left").join(b, F.col("v") == F.col("_b"), "left")
    dz = F.when(F.col("covered"), 0.0).otherwise(F.col("_zb") - F.col("_za"))
    e = e.withColumn("dz", dz).drop("_a", "_b", "_za", "_zb")
    gain = F.greatest(F.lit(0.0), "dz")
    return e.withColumns({"gain": gain, "loss": F.greatest(F.lit(0.0), -F.col("dz")), "climb": gain * gain / F.nullif(F.col("length"), F.lit(0.0)), "slope": F.abs("dz") / F.nullif(F.col("length"), F.lit(0.0))})


def capped_profile(duration: Column, length: Column, target_kph: float, limit_kph: Column, not_slower_than: Column, barred: Column) -> Column:
    """A derived profile's seconds: at most the target speed or the limit, no slower than another profile, infinite where barred."""
    speed = F.least(F.lit(target_kph), F.coalesce(limit_kph, F.lit(target_kph))) / 3.6
    floor = F.when(speed == 0, length * float("inf")).otherwise(length / speed)  # a limit of 0 is no error
    return F.when(barred, F.lit(float("inf"))).otherwise(F.least(F.greatest(duration, floor), not_slower_than))


def gross_time(routed: Column, alpha: float, orig: Column, dest: Column, least: float) -> Column:
    """Door-to-door seconds: routed time scaled, both ends' overheads, not below the floor."""
    return F.greatest(F.lit(least), routed * alpha + orig + dest)


def exact_access(pairs: DataFrame, origin: str, bins: list[tuple[float, float]], betas: dict[str, float]) -> DataFrame:
    """Untiered metrics on exact pairs: counts by bin and gravity, in one pass over the pairs."""
    a = metrics.cumulative(pairs, origin, bins, name="count")
    b = metrics.gravity(pairs, origin, betas, name="gravity")
    return a.join(b, origin)


def compare_groups(groups: dict[str, tuple[DataFrame, DataFrame]], key: str, columns: list[str]) -> DataFrame:
    """Agreement by column for each named pair of result tables."""
    parts = [stats.compare_wide(a, b, key, columns).withColumn("group", F.lit(name)) for name, (a, b) in groups.items()]
    return reduce(DataFrame.unionByName, parts)


def worst_difference(a: DataFrame, b: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """Pairs on both sides, and the largest absolute difference."""
    both = a.join(b.withColumnRenamed(value, "_b"), keys)
    return both.agg(F.count("*").alias("n"), F.max(F.abs(F.col(value) - F.col("_b"))).alias("worst"))


def road_tier(rank: Column) -> Column:
    return F.when(rank >= 6, "highway").when(rank >= 3, "main").otherwise("local")


def minutes_per_utility(slopes: list[float]) -> float:
    """Minutes that one unit of utility is worth, by the mean slope of the time bands."""
    return -1.0 / (sum(slopes) / len(slopes))


def snap_counters(counters: DataFrame, edges: DataFrame, radius: float, tolerance: float, eligible: Callable[[], Column] | None = None) -> DataFrame:
    """counter_id -> the nearest edge within radius whose bearing differs by no more than the tolerance (degrees).

    counters (counter_id, x, y, heading), edges (edge_id, x0..y1); eligible adds a
    condition on the pair.
    """
    near = near_segments(counters, edges, radius)
    turn = F.abs(bearing(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")) - F.col("heading"))
    near = near.where(F.least(turn, 360.0 - turn) <= tolerance)
    if eligible is not None:
        near = near.where(eligible())
    return near.groupBy("counter_id").agg(F.min_by(F.struct("edge_id", "dist"), F.struct(F.round("dist", 6), "edge_id")).alias("b")).select("counter_id", "b.edge_id", "b.dist")


def project_on_edges(points: DataFrame, key: str, edges: DataFrame, radius: float, spacing: float) -> DataFrame:
    """Where a point's nearest edge gets a node: at the foot of the perpendicular, or the end that is closer than the spacing.

    Returns key, edge_id, node ('u', 'v' or 'new'), share along the edge, x, y.
    """
    near = near_segments(points, edges, radius)
    best = near.groupBy(key).agg(F.min_by(F.struct("edge_id", "x0", "y0", "x1", "y1", "x", "y"), F.struct(F.round("dist", 6), "edge_id")).alias("b")).select(key, "b.*")
    dx, dy = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((F.col("x") - F.col("x0")) * dx + (F.col("y") - F.col("y0")) * dy) / F.nullif(dx * dx + dy * dy, F.lit(0.0))))
    best = best.withColumns({"_t": F.coalesce(t, F.lit(0.0)), "_l": F.hypot(dx, dy)})
    node = F.when(F.col("_t") * F.col("_l") < spacing, "u").when((1 - F.col("_t")) * F.col("_l") < spacing, "v").otherwise("new")
    share = F.when(node == "u", 0.0).when(node == "v", 1.0).otherwise(F.col("_t"))
    return best.select(key, "edge_id", node.alias("node"), share.alias("share"), (F.col("x0") + share * dx).alias("x"), (F.col("y0") + share * dy).alias("y"))


def transport_centroids(nodes: DataFrame, polygons: DataFrame, key: str) -> DataFrame:
    """Median place of the nodes inside each polygon."""
    return points_in_polygons(nodes, polygons).groupBy(key).agg(F.percentile("x", F.lit(0.5)).alias("x"), F.percentile("y", F.lit(0.5)).alias("y"), F.count("*").alias("n"))


def coarse_graph(lines: DataFrame) -> DataFrame:
    """Directed edges both ways between line ends rounded to 0.1; loops are dropped.  Node ids are the ends' own text."""
    end = lambda x, y: F.concat_ws(",", F.bround(x, 1), F.bround(y, 1))
    e = lines.withColumns({"a": end("x0", "y0"), "b": end("x1", "y1")}).where("a <> b")
    return e.select("line_id", F.col("a").alias("u"), F.col("b").alias("v")).unionByName(e.select("line_id", F.col("b").alias("u"), F.col("a").alias("v")))


def alongside(dropped: DataFrame, kept: DataFrame, samples: int = 11) -> DataFrame:
    """way_id of dropped ways (way_id, x0..y1) of which a kept way covers 80 % within 20 m, by points along them."""
    steps = F.explode(F.array(*[F.lit(k / (samples - 1)) for k in range(samples)]))
    p = dropped.withColumn("q", steps).select(F.col("way_id").alias("dway"), "q", (F.col("x0") + F.col("q") * (F.col("x1") - F.col("x0"))).alias("x"), (F.col("y0") + F.col("q") * (F.col("y1") - F.col("y0"))).alias("y"))
    hit = near_segments(p, kept.select("way_id", "x0", "y0", "x1", "y1"), ALONG_M).select("dway", "q").distinct()
    return hit.groupBy(F.col("dway").alias("way_id")).agg(F.count("*").alias("n")).where(F.col("n") >= ALONG_SHARE * samples).select("way_id")


def put_back(dropped: DataFrame, label: DataFrame) -> DataFrame:
    """Dropped ways (way_id, u, v) that join different components of what is left (node_id, component), or reach a node that is left out."""
    a, b = label.select(F.col("node_id").alias("_a"), F.col("component").alias("_ca")), label.select(F.col("node_id").alias("_b"), F.col("component").alias("_cb"))
    e = dropped.join(a, F.col("u") == F.col("_a"), "left").join(b, F.col("v") == F.col("_b"), "left")
    return e.where("_ca is null or _cb is null or _ca <> _cb").select("way_id")


def availability(trips: DataFrame, times: dict[str, str], owned: dict[str, str], most: float = 300 * 60.0) -> DataFrame:
    """av_<mode>: the mode's time is known and below the limit, and what it needs is owned."""
    ok = {}
    for mode, column in times.items():
        free = F.coalesce(F.col(column) < most, F.lit(False))
        if mode in owned:
            free = free & F.coalesce(F.col(owned[mode]) == 1, F.lit(False))
        ok[f"av_{mode}"] = free.cast("int")
    return trips.withColumns(ok)


def modeled_sample(trips: DataFrame, modes: list[str], features: list[str], longest: float) -> DataFrame:
    """Trips within the distance, whose chosen mode is available besides another one, without nulls among the features."""
    chosen = reduce(lambda a, b: a | b, [(F.col("mode") == m) & (F.col(f"av_{m}") == 1) for m in modes])
    n = reduce(lambda a, b: a + b, [F.col(f"av_{m}") for m in modes])
    return trips.where((F.col("dist_line") <= longest) & chosen & (n >= 2)).dropna(subset=features)


def pooled_fit(profiles: dict[str, DataFrame], y: str, features: list[str]) -> dict[str, float]:
    """One median regression shared by several profiles' rows."""
    rows = reduce(DataFrame.unionByName, [df.select(y, *features) for df in profiles.values()])
    return estimators.median_regression(rows, y, features)


def spec_grid(rows: DataFrame, y: str, sets: dict[str, list[str]], constrained: bool | None = None) -> dict[str, dict[str, float]]:
    """A fit for each feature set; with constrained=None both free ones and, under '<name>_constrained', ones whose coefficients aren't negative."""
    out = {}
    for name, features in sets.items():
        if constrained is not True:
            out[name] = estimators.ols(rows, y, features)
        if constrained is not False:
            out[name if constrained else f"{name}_constrained"] = estimators.bounded_ols(rows, y, features, lower=dict.fromkeys(features, 0.0))
    return out


def cross_validated(rows: DataFrame, wave: str, y: str, features: list[str], out: str) -> DataFrame:
    """Each wave's rows predicted by a fit on all other waves; the waves are few."""
    parts = []
    for (value,) in rows.select(wave).distinct().orderBy(wave).collect():
        fit = estimators.ols(rows.where(F.col(wave) != F.lit(value)), y, features)
        predicted = reduce(lambda a, b: a + b, [F.lit(fit[f]) * F.col(f) for f in features], F.lit(fit["const"]))
        parts.append(rows.where(F.col(wave) == F.lit(value)).withColumn(out, predicted))
    return reduce(DataFrame.unionByName, parts)


def calibrate_edges(edges: DataFrame, route: Callable[[DataFrame], DataFrame], observed: DataFrame, features: list[str], rounds: int = 5, tolerance: float = 1e-5) -> dict[str, float]:
    """Route with the present durations, refit observed times on the routes' feature sums, until R2 moves no more.

    route takes the edges (with w) and gives trip_id and the features' sums; observed has trip_id, time.
    """
    fit, last = {}, None
    for _ in range(rounds):
        sums = route(edges)
        fit = estimators.ols(sums.join(observed, "trip_id"), "time", features)
        if last is not None and abs(fit["r2"] - last) < tolerance:
            break
        last = fit["r2"]
        edges = edges.withColumn("w", F.greatest(F.lit(0.1), reduce(lambda a, b: a + b, [F.lit(max(0.0, fit[f])) * F.col(f) for f in features])))
    return fit


def completeness(legs: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """n, and how many rows fail each check first; one pass."""
    cause = F.lit("complete")
    for name, ok in reversed(list(checks.items())):
        cause = F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)).otherwise(cause)
    return legs.groupBy(cause.alias("cause")).agg(F.count("*").alias("n"))


def consistency_rates(rows: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """One row: the share of rows that keep each rule, of those for which it is known."""
    return rows.agg(*[F.avg(ok.cast("double")).alias(name) for name, ok in rules.items()])


def renumbered(rows: DataFrame, group: list[str], order: list[str], out: str) -> DataFrame:
    return rows.withColumn(out, F.row_number().over(Window.partitionBy(*group).orderBy(*order)))


def radius_densities(sums: DataFrame, value: str, radius: float, land: str, built: str) -> DataFrame:
    """A disc's sum over its area, its land and its built-up land (km2), to two digits."""
    circle = 3.141592653589793 * radius * radius / 1e6
    per = lambda d: F.round(F.col(value) / F.nullif(d, F.lit(0.0)), 2)
    return sums.withColumns({f"{value}_per_km2": per(F.lit(circle)), f"{value}_per_land_km2": per(F.col(land)), f"{value}_per_built_km2": per(F.col(built))})


def clean_sentinels(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Negative codes as null."""
    return rows.withColumns({c: F.when(F.col(c) >= 0, F.col(c)) for c in columns})


def traffic_zones(zones: DataFrame, centres: DataFrame) -> DataFrame:
    """zone_id with prefix ZD for zones that have a centre of their own, ZF for others, which take their polygon's centroid."""
    c = centres.select(F.col("zone_no").alias("_n"), F.col("x").alias("_cx"), F.col("y").alias("_cy"))
    out = zones.join(c, F.col("zone_no") == F.col("_n"), "left")
    home = F.col("_n").isNotNull()
    return out.select(F.concat(F.when(home, "ZD").otherwise("ZF"), F.col("zone_no").cast("string")).alias("zone_id"), F.coalesce("_cx", "x").alias("x"), F.coalesce("_cy", "y").alias("y"), home.alias("is_domestic"))


def counter_flows(counters: DataFrame) -> DataFrame:
    """Cars a day: the cars counted if there are any, else nine tenths of all vehicles; counters without cars go."""
    return counters.withColumn("cars", F.when(F.col("passenger") >= 1, F.col("passenger")).otherwise(0.9 * F.col("vehicles"))).where("cars > 0")


def profile_or_sibling(coefs: dict[str, dict[str, float]], profile: str, siblings: list[str]) -> dict[str, float]:
    """A profile's coefficients, else those of the first sibling of its mode that has any."""
    for name in (profile, *siblings):
        if name in coefs:
            return coefs[name]
    raise KeyError(f"no coefficients for {profile} or its mode")


def tiered_path_costs(od: DataFrame, costs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Costs of searches (origin, node, cost) on tiered pairs, through the nodes (kind 'cell' or 'zone', id, node) of both ends; beyond the cutoff null."""
    o = nodes.select(F.col("kind").alias("_ok"), F.col("id").alias("_oi"), F.col("node").alias("_on"))
    d = nodes.select(F.col("kind").alias("_dk"), F.col("id").alias("_di"), F.col("node").alias("_dn"))
    ko, kd = F.when(F.col("tier") == "z2z", "zone").otherwise("cell"), F.when(F.col("tier") == "c2c", "cell").otherwise("zone")
    rows = od.join(o, (ko == F.col("_ok")) & (F.col("orig_id") == F.col("_oi")), "left").join(d, (kd == F.col("_dk")) & (F.col("dest_id") == F.col("_di")), "left")
    c = costs.select(F.col("origin").alias("_co"), F.col("node").alias("_cn"), "cost")
    return rows.join(c, (F.col("_on") == F.col("_co")) & (F.col("_dn") == F.col("_cn")), "left").select("tier", "orig_id", "dest_id", F.col("cost").alias("value"))


def clean_edges(edges: DataFrame, means: list[str], drop: tuple[str, ...] = ("name",)) -> DataFrame:
    """Merged edges' list attributes as one value each: numbers by their mean, the highway of the highest rank; length from the geometry."""
    from isoreach.functions.osm import highway_rank, mean_of_numbers
    from isoreach.operators.geometry import length

    out = edges.drop(*drop).withColumns({c: mean_of_numbers(F.col(c)) for c in means})
    if "highway" in edges.columns:
        out = out.withColumn("highway", F.array_max(F.transform("highway", lambda h: F.struct(highway_rank(h).alias("r"), h.alias("h"))))["h"])
    return out.withColumn("length", length(F.col("geometry"))) if "geometry" in edges.columns else out


def filled_speed(maxspeed: Column, by_class: Column) -> Column:
    """The limit, else the class's speed, else 50."""
    return F.coalesce(maxspeed, by_class, F.lit(50.0))


def leg_times(legs: DataFrame, by_profile: dict[str, DataFrame]) -> DataFrame:
    """Legs with each profile's routed time (leg_id, cost) as time_<profile>; unrouted ones null."""
    for name, df in by_profile.items():
        legs = legs.join(df.select(F.col("leg_id").alias("_l"), F.col("cost").alias(f"time_{name}")), F.col("leg_id") == F.col("_l"), "left").drop("_l")
    return legs


def leg_overheads(legs: DataFrame, overheads: DataFrame) -> DataFrame:
    """Both ends' overheads of legs (orig_cell, dest_cell) from cells (cell_id, overhead)."""
    o, d = overheads.select(F.col("cell_id").alias("_o"), F.col("overhead").alias("overhead_orig")), overheads.select(F.col("cell_id").alias("_d"), F.col("overhead").alias("overhead_dest"))
    return legs.join(o, F.col("orig_cell") == F.col("_o"), "left").join(d, F.col("dest_cell") == F.col("_d"), "left").drop("_o", "_d")


def tier_medians(od: DataFrame) -> DataFrame:
    return od.where(F.col("value").isNotNull()).groupBy("tier").agg(F.percentile("value", F.lit(0.5)).alias("median"), F.count("*").alias("n"))


def with_prefixes(rows: DataFrame, prefixes: tuple[str, ...]) -> DataFrame:
    return rows.select(*[c for c in rows.columns if c.startswith(prefixes)])


def evaluated_counters(counters: DataFrame, flows: DataFrame) -> DataFrame:
    """Agreement of counted and modeled flows by road tier: counters (edge_id, counted, rank), flows (edge_id, flow_estimate)."""
    both = counters.join(flows.select(F.col("edge_id").alias("_e"), "flow_estimate"), F.col("edge_id") == F.col("_e")).withColumn("tier", road_tier(F.col("rank")))
    return stats.agreement(both, ["tier"], "counted", "flow_estimate")
