"""Row masks of calibration, routing and validation, column selections, and callables that users plug in."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Values that mean a road can't be driven on (fixed values).
CLOSED = ("construction", "proposed", "abandoned")


def every(*conditions: Column) -> Column:
    """True where all conditions hold; a null counts as false."""
    return reduce(lambda a, b: a & b, [F.coalesce(c, F.lit(False)) for c in conditions], F.lit(True))


def flags_hold(flags: list[str]) -> Column:
    return every(*[F.col(f).cast("boolean") for f in flags])


def calibration_mask(area: Column, node: Column, exposure: Column, features: list[Column]) -> Column:
    """In the area, snapped to a node, exposed to traffic, and with all features known."""
    return every(area, node.isNotNull(), exposure > 0, *[f.isNotNull() & ~F.isnan(f.cast("double")) for f in features])


def first_in(values: Column, classes: tuple[str, ...]) -> Column:
    """Whether the first of a list of values is one of the classes."""
    return F.coalesce(F.try_element_at(values, F.lit(1)).isin(*classes), F.lit(False))


def cost_mask(mode: Column, wanted: str, flags: list[Column], cost: Column, weight: Column, low: float, high: float) -> Column:
    """Trips of a mode with all flags, a weight, and a finite cost in [low, high]."""
    return every(mode == wanted, *flags, ~F.isnan(cost.cast("double")), cost.between(low, high), weight > 0)


def any_of(*groups: list[Column]) -> Column:
    """True where all conditions of one of the groups hold."""
    return reduce(lambda a, b: a | b, [every(*g) for g in groups], F.lit(False))


def drivable(road_class: Column, classes: tuple[str, ...], state: Column, banned: Column) -> Column:
    """Roads of the classes that are neither banned nor unfinished."""
    return every(road_class.isin(*classes), ~F.coalesce(state.isin(*CLOSED), F.lit(False)), ~F.coalesce(banned.cast("boolean"), F.lit(False)))


def common_columns(a: DataFrame, b: DataFrame, prefix: str = "") -> list[str]:
    """Columns that both tables have, in the first one's order."""
    other = set(b.columns)
    return [c for c in a.columns if c in other and c.startswith(prefix)]


def split_tag(tag: Column, stratum: Column, split: tuple[str, ...]) -> Column:
    """tag__stratum for the tags that are split by stratum, others as they are."""
    return F.when(tag.isin(*split) & stratum.isNotNull(), F.concat(tag, F.lit("__"), stratum)).otherwise(tag)


def shapes(df: DataFrame, key: str, geometry: str, allowed: tuple[str, ...], extras: tuple[str, ...] = ()) -> DataFrame:
    """The columns of a shapes table: its key first, allowed ones that it has, extras, and the geometry last."""
    missing = [c for c in (key, geometry, *extras) if c not in df.columns]
    if missing:
        raise ValueError(f"the table lacks {missing}")
    keep = [c for c in df.columns if c in allowed and c not in (key, geometry)]
    return df.select(key, *dict.fromkeys([*keep, *(c for c in extras if c not in (key, geometry))]), geometry)


def lean(edges: DataFrame, ends: tuple[str, str], kept: list[str]) -> DataFrame:
    """Edges with their ends and the kept weights only; those without any of the weights go."""
    return edges.select(*ends, *kept).where(reduce(lambda a, b: a | b, [F.col(k).isNotNull() for k in kept], F.lit(False)))


def overlaid(edges: DataFrame, key: str, layers: list[DataFrame], column: str) -> DataFrame:
    """A property of edges from several layers (key, column): the last layer that has an edge wins, and the edge's own value stays without any."""
    out = edges
    for k, layer in enumerate(layers):
        out = out.join(layer.select(F.col(key).alias(f"_k{k}"), F.col(column).alias(f"_v{k}")), F.col(key) == F.col(f"_k{k}"), "left")
    own = [F.col(column)] if column in edges.columns else []
    best = F.coalesce(*[F.col(f"_v{k}") for k in reversed(range(len(layers)))], *own, F.lit(None))
    return out.select(*[c for c in edges.columns if c != column], best.alias(column))


def endpoint_features(trips: DataFrame, sources: dict[str, Callable[[DataFrame], tuple[Column, Column]]]) -> DataFrame:
    """For each named source its (origin, destination) columns, their sum as the feature; a source is a callable of the table."""
    added = {}
    for name, source in sources.items():
        o, d = source(trips)
        added |= {f"{name}_o": o, f"{name}_d": d, name: F.coalesce(o, F.lit(0.0)) + F.coalesce(d, F.lit(0.0))}
    return trips.withColumns(added)


def over_modes(rows: DataFrame, keys: list[str], cost: str, how: str | Callable[[Column], Column], beta: float = 1.0) -> DataFrame:
    """One cost for each key over its modes: 'logsum', or any aggregate of the modes' costs that is given as a callable."""
    if how == "logsum":
        value = -F.log(F.sum(F.exp(-F.lit(beta) * F.col(cost)))) / F.lit(beta)
    elif callable(how):
        value = how(F.col(cost))
    else:
        raise ValueError(f"{how!r} is neither 'logsum' nor a callable")
    return rows.where(F.col(cost).isNotNull()).groupBy(*keys).agg(value.alias(cost))


def metric_name(dest: str, value: float | int) -> str:
    """<destination>_<parameter>, whole numbers without a point."""
    return f"{dest}_{int(value) if float(value).is_integer() else value}"


def wide(rows: DataFrame, key: str, dest: str, param: str, value: str, names: list[tuple[str, float]]) -> DataFrame:
    """Long metrics as one column for each (destination, parameter), named by metric_name."""
    aggs = [F.max(F.when((F.col(dest) == d) & (F.col(param) == p), F.col(value))).alias(metric_name(d, p)) for d, p in names]
    return rows.groupBy(key).agg(*aggs)


def batches_of(items: list, size: int = 5) -> list[list]:
    """Items in batches of a size at most.  Destinations are rows here, so no metric needs batches; callers that want wide tables do."""
    return [items[k : k + size] for k in range(0, len(items), size)]


def picked(rows: DataFrame, key: Column, columns: dict[str, str]) -> Column:
    """The column that belongs to a row's key, null for an unknown one."""
    out = F.lit(None).cast("double")
    for value, column in columns.items():
        out = F.when(key == value, F.col(column)).otherwise(out)
    return out


def transit_prediction(trips: DataFrame, matrix: DataFrame, overheads: DataFrame, alpha: float) -> DataFrame:
    """alpha times the zones' time plus both ends' overheads: trips (trip_id, orig_zone, dest_zone, orig_cell, dest_cell); null where a part is missing."""
    m = matrix.select(F.col("orig_id").alias("_mo"), F.col("dest_id").alias("_md"), F.col("value").alias("_v"))
    o = overheads.select(F.col("cell_id").alias("_oc"), F.col("overhead").alias("_ov_o"))
    d = overheads.select(F.col("cell_id").alias("_dc"), F.col("overhead").alias("_ov_d"))
    out = trips.join(m, (F.col("orig_zone") == F.col("_mo")) & (F.col("dest_zone") == F.col("_md")), "left")
    out = out.join(o, F.col("orig_cell") == F.col("_oc"), "left").join(d, F.col("dest_cell") == F.col("_dc"), "left")
    return out.withColumn("predicted", F.lit(alpha) * F.col("_v") + F.col("_ov_o") + F.col("_ov_d")).select(*trips.columns, "predicted")


def slot_percentiles(times: DataFrame, keys: list[str], minute: str, value: str, percentiles: list[int], slot: int = 15) -> DataFrame:
    """Percentiles of travel times by slots of departure minutes: keys, slot, n, p<percentile>; times that aren't known count as unreachable, and aren't counted."""
    rows = times.where(F.col(value).isNotNull()).withColumn("slot", (F.floor(F.col(minute) / slot) * slot).cast("long"))
    return rows.groupBy(*keys, "slot").agg(F.count("*").alias("n"), *[F.expr(f"percentile(`{value}`, {p / 100!r}D)").alias(f"p{p}") for p in percentiles])
