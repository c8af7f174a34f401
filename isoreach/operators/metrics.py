"""Accessibility metrics from stitched rows (origin, dest, cost, weight).

All families are combinable aggregates by origin, but for nearest-k, which needs
the destinations in the order of their cost; there a window over the origin is
inherent, and rows beyond the k-th unit could be cut by a cutoff beforehand.  A
weight of 0 or null contributes nothing.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def cumulative(rows: DataFrame, origin: str, bins: list[tuple[float, float]], cost: str = "cost", weight: str = "weight", name: str = "w") -> DataFrame:
    """Weight with lo <= cost < hi for each bin, in one pass: <name>_<lo>_<hi>."""
    def one(lo: float, hi: float) -> Column:
        return F.coalesce(F.sum(F.when((F.col(cost) >= lo) & (F.col(cost) < hi), F.col(weight))), F.lit(0.0)).alias(f"{name}_{lo:g}_{hi:g}")

    return rows.groupBy(origin).agg(*[one(lo, hi) for lo, hi in bins])


def taken(rows: DataFrame, origin: str, dest: str, cost: str, weight: str) -> DataFrame:
    """Rows with the weight that lies nearer (_before) and with the row (_upto)."""
    w = Window.partitionBy(origin).orderBy(cost, dest)
    rows = rows.where((F.col(weight) > 0) & F.col(cost).isNotNull())
    upto = F.sum(weight).over(w.rowsBetween(Window.unboundedPreceding, 0))
    before = F.coalesce(F.sum(weight).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    return rows.withColumns({"_before": before, "_upto": upto})


def nearest_k(rows: DataFrame, origin: str, dest: str, ks: list[float], cost: str = "cost", weight: str = "weight", name: str = "w") -> DataFrame:
    """Mean cost of the first k units of weight, the last unit in part; null where there are fewer than k."""
    t = taken(rows, origin, dest, cost, weight)

    def one(k: float) -> Column:
        take = F.greatest(F.lit(0.0), F.least(F.col(weight), F.lit(float(k)) - F.col("_before")))
        return F.when(F.max("_upto") >= k, F.sum(take * F.col(cost)) / F.lit(float(k))).alias(f"{name}_{k:g}")

    return t.groupBy(origin).agg(*[one(k) for k in ks])


def decay(minutes: float, seconds: bool = True) -> float:
    """Rate that halves a weight after so many minutes."""
    return math.log(2) / (60 * minutes if seconds else minutes)


def gravity(rows: DataFrame, origin: str, betas: dict[str, float], cost: str = "cost", weight: str = "weight", name: str = "w") -> DataFrame:
    """Sum of weight * exp(-beta * cost) for each named rate."""
    return rows.groupBy(origin).agg(*[F.coalesce(F.sum(F.col(weight) * F.exp(-F.lit(b) * F.col(cost))), F.lit(0.0)).alias(f"{name}_{n}") for n, b in betas.items()])


def utility_logsum(rows: DataFrame, origin: str, beta: float, cost: str = "cost", weight: str = "weight", out: str = "logsum") -> DataFrame:
    """(1 / beta) ln of the gravity sum over disutilities; null where nothing is reached."""
    s = F.sum(F.col(weight) * F.exp(-F.lit(beta) * F.col(cost)))
    return rows.groupBy(origin).agg(F.when(s > 0, F.log(s) / F.lit(beta)).alias(out))


def cross_modal(by_mode: DataFrame, origin: str, mode_value: str = "logsum", out: str = "logsum_all") -> DataFrame:
    """ln of the sum over modes of exp(a_m), for one row a mode; null only if all are."""
    top = by_mode.groupBy(origin).agg(F.max(mode_value).alias("_m"), F.collect_list(mode_value).alias("_v"))
    return top.select(origin, F.when(F.col("_m").isNotNull(), F.col("_m") + F.log(F.aggregate("_v", F.lit(0.0), lambda acc, v: acc + F.exp(v - F.col("_m"))))).alias(out))


def on_active(metric: DataFrame, active: DataFrame, key: str) -> DataFrame:
    """A row for each active unit, null where it has no metric."""
    return active.select(key).join(metric, key, "left")


def round_significant(c: Column, digits: int) -> Column:
    """Rounded half to even to so many significant digits; 0 and null are kept."""
    exponent = F.floor(F.log10(F.abs(c)))
    factor = F.pow(F.lit(10.0), F.lit(digits - 1) - exponent)
    return F.when(c == 0, c).otherwise(F.rint(c * factor) / factor)


def weighted_quantile(rows: DataFrame, group: str, value: str, weight: str, q: float, tie: str, out: str) -> DataFrame:
    """The first value at which the cumulative weight reaches q of the total."""
    w = Window.partitionBy(group).orderBy(value, tie)
    rows = rows.where((F.col(weight) > 0) & F.col(value).isNotNull())
    cum = F.sum(weight).over(w.rowsBetween(Window.unboundedPreceding, 0))
    total = F.sum(weight).over(Window.partitionBy(group))
    return rows.withColumns({"_c": cum, "_t": total}).groupBy(group).agg(F.min(F.when(F.col("_c") >= q * F.col("_t"), F.col(value))).alias(out))


def weighted_quantile_midrank(rows: DataFrame, group: str, value: str, weight: str, q: float, tie: str, out: str) -> DataFrame:
    """Linear interpolation of the mid-rank distribution (cumulative weight less half the own one, over the total)."""
    w = Window.partitionBy(group).orderBy(value, tie)
    rows = rows.where((F.col(weight) > 0) & F.col(value).isNotNull())
    cum = F.sum(weight).over(w.rowsBetween(Window.unboundedPreceding, 0))
    total = F.sum(weight).over(Window.partitionBy(group))
    p = rows.withColumn("_p", (cum - F.col(weight) / 2) / total)
    p = p.withColumns({"_np": F.lead("_p").over(w), "_nv": F.lead(value).over(w)})
    inside = F.when((F.col("_p") <= q) & (F.col("_np") > q), F.col(value) + (F.col("_nv") - F.col(value)) * (F.lit(q) - F.col("_p")) / (F.col("_np") - F.col("_p")))
    first = F.min(F.when(F.lit(q) < F.col("_p"), F.col(value)))
    last = F.max(F.when(F.lit(q) >= F.col("_p"), F.col(value)))
    return p.groupBy(group).agg(F.coalesce(F.max(inside), F.when(F.min("_p") > q, first), last).alias(out))


def reach(rows: DataFrame, origin: str, dest: str, q: float, kernel: Column, cost: str = "cost", weight: str = "weight", out: str = "reach") -> DataFrame:
    """Cost within which q of an origin's kernel-weighted opportunities lie."""
    return weighted_quantile(rows.withColumn("_k", F.col(weight) * kernel), origin, cost, "_k", q, dest, out)


def sums_by_band(rows: DataFrame, origin: str, value: str, at: str, radii: list[float]) -> DataFrame:
    """Sums of value where `at` is within each radius."""
    cols = [F.coalesce(F.sum(F.when(F.col(at) <= r, F.col(value))), F.lit(0.0)).alias(f"{value}_within_{r:g}") for r in radii]
    return rows.groupBy(origin).agg(*cols)


def all_of(flags: list[str], present: list[str]) -> Column:
    """AND of those flags that the table has; a missing column passes."""
    have = [F.coalesce(F.col(f) == 1, F.lit(False)) for f in flags if f in present]
    return reduce(lambda a, b: a & b, have, F.lit(True))
