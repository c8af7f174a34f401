"""Samples and expected flows, reproducible by hashes of ids and a seed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isoreach.sources.store import stash

#: Slices of the unit interval at most; a row that has all the weight is filed under all of them.
SLICES = 1 << 20


def uniform(key: Column, seed: int) -> Column:
    """A number in (0, 1) that is fixed by the key and the seed."""
    return (F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(1 << 40)) + 0.5) / float(1 << 40)


def simple_sample(rows: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """n rows of the smallest hashes; the same ones whatever the partitions."""
    return rows.withColumn("_h", F.xxhash64(key, F.lit(seed))).orderBy("_h", key).limit(n).drop("_h")


def fraction_sample(rows: DataFrame, key: str, fraction: float, seed: int) -> DataFrame:
    return rows.where(uniform(F.col(key), seed) < fraction)


def jitter(c: Column, key: Column, seed: int, width: float) -> Column:
    """c moved by up to width either way."""
    return c + (uniform(key, seed) * 2 - 1) * width


def weighted_with_replacement(rows: DataFrame, key: str, weight: str, n: int, seed: int) -> DataFrame:
    """n draws in proportion to weight: key, times.

    Each draw's uniform number falls into one row's share of the cumulative
    weight.  Both sides are cut into as many slices of the unit interval as there
    are draws (SLICES at most), so the range join is an equi-join on the slice, a
    slice has about one draw, and a row is filed under the slices that it covers.
    """
    slices = max(1, min(n, SLICES))
    rows = rows.where(F.col(weight) > 0)
    total = rows.agg(F.sum(weight)).first()[0]
    if not total:
        return rows.select(key, F.lit(0).cast("long").alias("times")).limit(0)
    # prefix sums in two steps: over ranges of the key's hash, then within one
    r = rows.select(key, F.col(weight).cast("double").alias("_w"), F.pmod(F.xxhash64(key), F.lit(1024)).alias("_b"))
    before = r.groupBy("_b").agg(F.sum("_w").alias("_s")).withColumn("_p", F.coalesce(F.sum("_s").over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    w = Window.partitionBy("_b").orderBy(key)
    r = r.join(F.broadcast(before.select(F.col("_b").alias("_bb"), "_p")), F.col("_b") == F.col("_bb")).withColumn("_hi", (F.col("_p") + F.sum("_w").over(w.rowsBetween(Window.unboundedPreceding, 0))) / total)
    r = r.withColumn("_lo", F.col("_hi") - F.col("_w") / total)
    last = F.least(F.floor(F.col("_hi") * slices), F.lit(slices - 1))
    r = r.withColumn("_slice", F.explode(F.sequence(F.least(F.floor(F.col("_lo") * slices), F.lit(slices - 1)).cast("int"), last.cast("int"))))
    draws = rows.sparkSession.range(n).select(uniform(F.col("id"), seed).alias("_u")).withColumn("_us", F.floor(F.col("_u") * slices).cast("int"))
    hit = draws.join(r, F.col("_us") == F.col("_slice")).where((F.col("_u") > F.col("_lo")) & (F.col("_u") <= F.col("_hi")))
    return hit.groupBy(key).agg(F.count("*").alias("times"))


def expected_flows(pairs: DataFrame, origin: str, trips: str, bin_: str, share: str, weight: str) -> DataFrame:
    """Trips of each pair: an origin's trips by the target share of the pair's cost bin, within it by weight.

    The shares of the bins that an origin reaches are scaled to one.
    """
    w = Window.partitionBy(origin, bin_)
    rows = pairs.where(F.col(weight) > 0).withColumn("_in", F.sum(weight).over(w))
    per_bin = rows.groupBy(origin, bin_).agg(F.first(share).alias("_sh")).groupBy(origin).agg(F.sum("_sh").alias("_all"))
    rows = rows.join(per_bin, origin)
    return rows.withColumn("flow", F.col(trips) * F.col(share) / F.nullif(F.col("_all"), F.lit(0.0)) * F.col(weight) / F.col("_in")).drop("_in", "_all")


def volume_ratio(edges: DataFrame, flows: DataFrame, scale: float, betas: list[float], most: float = 2.0) -> DataFrame:
    """All edges with flow, capacity, flow / capacity, and min(v/c, most) to the power of each beta; edges without flow have 0."""
    f = flows.select(F.col("edge_id").alias("_e"), (F.col("flow") * F.lit(scale)).alias("_f"))
    out = edges.join(f, F.col("edge_id") == F.col("_e"), "left").withColumn("flow_estimate", F.coalesce("_f", F.lit(0.0)))
    # fixed values: vehicles a day and lane by rank of the road
    per_lane = F.when(F.col("rank") >= 6, 30_000.0).when(F.col("rank") >= 3, 15_000.0).otherwise(10_000.0)
    out = out.withColumn("capacity", per_lane * F.greatest(F.lit(1.0), F.coalesce("lanes", F.lit(1.0)))).withColumn("vc", F.col("flow_estimate") / F.col("capacity"))
    return out.withColumns({f"vc_beta_{b:.1f}": F.pow(F.least("vc", F.lit(most)), F.lit(b)) for b in betas}).drop("_e", "_f")


def nested_sample(pairs: DataFrame, origin: str, dest: str, bin_: str, weight: str, target: dict[int, float], n: int, seed: int, members: DataFrame | None = None) -> DataFrame:
    """n destinations of each origin, drawn with replacement: a cost bin by its target share among the bins that the origin
    reaches, then a destination of the bin by weight.  Returns origin, dest, times.

    Draws are hashes of the origin, their number and the seed.  An origin's
    destinations are laid on the unit interval, bin by bin, and a draw takes the
    one that it falls on, by the slice of the interval; a slice has some eight
    destinations.  With members (_unit, origin; spatial.once_a_place) the units
    draw from the destinations of their origin, each for itself.
    """
    share = F.element_at(F.create_map(*[F.lit(x) for k, v in target.items() for x in (k, float(v))]), F.col(bin_))
    rows = pairs.select(origin, dest, F.col(bin_).alias("_b"), F.col(weight).cast("double").alias("_w"), share.alias("_t")).where("_w > 0 and _t > 0")
    rows = rows.groupBy(origin, dest, "_b").agg(F.sum("_w").alias("_w"), F.first("_t").alias("_t"))
    per_bin = rows.groupBy(origin, "_b").agg(F.sum("_w").alias("_in"), F.first("_t").alias("_t"), F.count("*").alias("_many"))
    over = Window.partitionBy(origin)
    laid = per_bin.withColumn("_all", F.sum("_t").over(over)).withColumn("_from", F.coalesce(F.sum("_t").over(over.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)) / F.col("_all"))
    laid = laid.withColumn("_slices", F.greatest(F.lit(n), F.ceil(F.sum("_many").over(over) / 8)).cast("int"))
    laid = stash(pairs.sparkSession, laid.select(F.col(origin).alias("_o"), F.col("_b").alias("_lb"), "_in", "_from", (F.col("_t") / F.col("_all")).alias("_share"), "_slices"), "sample-bins")
    rows = rows.join(laid, (F.col(origin) == F.col("_o")) & (F.col("_b") == F.col("_lb")))
    w = Window.partitionBy(origin, "_b").orderBy(dest).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("_hi", F.col("_from") + F.col("_share") * F.sum("_w").over(w) / F.col("_in")).withColumn("_lo", F.col("_hi") - F.col("_share") * F.col("_w") / F.col("_in"))
    at = lambda c: F.floor(F.col(c) * F.col("_slices"))
    rows = rows.select(origin, dest, "_lo", "_hi", F.explode(F.sequence(at("_lo").cast("int"), F.least(at("_hi"), F.col("_slices") - 1).cast("int"))).alias("_slice"))
    origins = laid.select(F.col("_o").alias("_do"), "_slices").distinct()
    units = origins.withColumn("_unit", F.col("_do")) if members is None else members.withColumnRenamed(origin, "_mo").join(origins, F.col("_mo") == F.col("_do")).select("_unit", "_do", "_slices")
    draws = units.withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    draws = draws.withColumn("_u", uniform(F.concat_ws(":", "_unit", "_k"), seed)).withColumn("_us", at("_u").cast("int")).drop("_slices", "_k")
    hit = draws.join(rows, (F.col("_do") == F.col(origin)) & (F.col("_us") == F.col("_slice"))).where((F.col("_u") > F.col("_lo")) & (F.col("_u") <= F.col("_hi")))
    return hit.groupBy(F.col("_unit").alias(origin), dest).agg(F.count("*").alias("times"))
