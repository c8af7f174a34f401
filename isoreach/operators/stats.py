"""Agreement statistics and other group statistics, each one aggregate pass."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def agreement(rows: DataFrame, group: list[str], measured: str, predicted: str) -> DataFrame:
    """n, bias, bias_pct, med_resid, med_resid_pct, mae, mae_pct, rmse, slope, r2 (against 1:1), r2_fit of the pairs known on both sides.

    All but n are null for fewer than two pairs; a ratio is null where its base is 0.
    The sums are taken about the group's means, which Spark's variance aggregates
    carry along, so large values lose no digits.
    """
    m, p = F.col(measured).cast("double"), F.col(predicted).cast("double")
    ok = rows.where(m.isNotNull() & p.isNotNull() & ~F.isnan(m) & ~F.isnan(p))
    r = p - m
    g = ok.groupBy(*group).agg(
        F.count("*").alias("n"), F.avg(m).alias("_m"), F.avg(r).alias("bias"), F.avg(F.abs(r)).alias("mae"), F.avg(r * r).alias("_rr"), F.avg(F.abs(m)).alias("_am"),
        F.var_pop(m).alias("_vm"), F.var_pop(p).alias("_vp"), F.covar_pop(m, p).alias("_c"), F.percentile(r, F.lit(0.5)).alias("med_resid"), F.percentile(m, F.lit(0.5)).alias("_mm"),
    )
    zero = F.lit(0.0)
    vm, vp = F.nullif(F.col("_vm"), zero), F.nullif(F.col("_vp"), zero)
    values = {
        "bias": F.col("bias"),
        "bias_pct": 100.0 * F.col("bias") / F.nullif(F.col("_m"), zero),
        "med_resid": F.col("med_resid"),
        "med_resid_pct": 100.0 * F.col("med_resid") / F.nullif(F.col("_mm"), zero),
        "mae": F.col("mae"),
        "mae_pct": 100.0 * F.col("mae") / F.nullif(F.col("_am"), zero),
        "rmse": F.sqrt("_rr"),
        "slope": F.col("_c") / vm,
        "r2": 1.0 - F.col("_rr") / vm,
        "r2_fit": F.col("_c") * F.col("_c") / (vm * vp),
    }
    return g.select(*group, "n", *[F.when(F.col("n") >= 2, v).alias(k) for k, v in values.items()])


def unpivot(wide: DataFrame, key: str, columns: list[str], name: str, value: str) -> DataFrame:
    return wide.unpivot([key], columns, name, value)


def compare_wide(left: DataFrame, right: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Agreement of two wide tables by column, over the keys of both."""
    a, b = unpivot(left, key, columns, "column", "a"), unpivot(right, key, columns, "column", "b").withColumnsRenamed({key: "_k", "column": "_c"})
    both = a.join(b, (F.col(key) == F.col("_k")) & (F.col("column") == F.col("_c")))
    return agreement(both, ["column"], "a", "b")


def cumulative_columns(wide: DataFrame, bins: list[str], names: list[str]) -> DataFrame:
    """Adds the running sums of neighbouring bin columns, from the first on."""
    sums = {n: reduce(lambda a, b: a + b, [F.col(c) for c in bins[: k + 1]]) for k, n in enumerate(names)}
    return wide.withColumns(sums)


def quantiles(rows: DataFrame, group: list[str], value: str, qs: dict[str, float]) -> DataFrame:
    """Exact quantiles, linear between ranks."""
    return rows.groupBy(*group).agg(*[F.percentile(value, F.lit(q)).alias(n) for n, q in qs.items()])


def median_of_medians(rows: DataFrame, outer: list[str], inner: list[str], value: str) -> DataFrame:
    first = rows.groupBy(*outer, *inner).agg(F.percentile(value, F.lit(0.5)).alias("_m"))
    return first.groupBy(*outer).agg(F.percentile("_m", F.lit(0.5)).alias("median"), F.count("*").alias("n_groups"))


def mode_value(rows: DataFrame, group: list[str], value: str, order: str) -> DataFrame:
    """The most frequent value; of equally frequent ones the first seen by `order`."""
    counts = rows.where(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count("*").alias("_n"), F.min(order).alias("_first"))
    return counts.groupBy(*group).agg(F.min_by(value, F.struct((-F.col("_n")).alias("n"), "_first")).alias(value))


def length_weighted(rows: DataFrame, group: list[str], value: str, length: str, mode: bool = False) -> DataFrame:
    """Length-weighted mean of a number, rounded half to even to 2 digits, or the value with the most length."""
    if mode:
        sums = rows.groupBy(*group, value).agg(F.sum(length).alias("_l"))
        return sums.groupBy(*group).agg(F.max_by(value, F.struct("_l", value)).alias(value))
    return rows.groupBy(*group).agg(F.bround(F.sum(F.col(value) * F.col(length)) / F.sum(F.when(F.col(value).isNotNull(), F.col(length))), 2).alias(value))


def share_of_total(rows: DataFrame, group: list[str], by: str, value: str) -> DataFrame:
    """Each class's share of its group's sum."""
    sums = rows.groupBy(*group, by).agg(F.sum(value).alias("_s"))
    return sums.withColumn("share", F.col("_s") / F.nullif(F.sum("_s").over(Window.partitionBy(*group)), F.lit(0.0))).drop("_s")


def binned_stats(rows: DataFrame, x: str, y: str, edges: list[float], least: int) -> DataFrame:
    """Bin (right-closed, by number), n, mean and median of y; null where a bin holds fewer than `least`."""
    b = F.lit(None).cast("int")
    for k, (lo, hi) in enumerate(zip(edges, edges[1:], strict=False)):
        b = F.when((F.col(x) > lo) & (F.col(x) <= hi), k).otherwise(b)
    g = rows.withColumn("bin", b).where("bin is not null").groupBy("bin").agg(F.count("*").alias("n"), F.avg(y).alias("_a"), F.percentile(y, F.lit(0.5)).alias("_m"))
    return g.select("bin", "n", F.when(F.col("n") >= least, F.col("_a")).alias("mean"), F.when(F.col("n") >= least, F.col("_m")).alias("median"))


def bands_and_all(rows: DataFrame, band: Column, value: str) -> DataFrame:
    """n and mean by band, and one row for all, in one pass over grouping sets."""
    g = rows.withColumn("band", band).rollup("band").agg(F.count("*").alias("n"), F.avg(value).alias("mean"), F.grouping("band").alias("_g"))
    return g.select(F.when(F.col("_g") == 1, "ALL").otherwise(F.col("band")).alias("band"), "n", "mean")


def monotone_envelope(bins: DataFrame, order: str, value: str, group: list[str] | None = None) -> DataFrame:
    """The running maximum in the order of the bins."""
    w = Window.partitionBy(*(group or [])).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return bins.withColumn(value, F.max(value).over(w))


def interpolate(points: DataFrame, x: str, knots: DataFrame, kx: str, ky: str, out: str) -> DataFrame:
    """Linear between knots, flat beyond the first and last; the knots are few and their number is fixed by the caller."""
    k = knots.agg(F.sort_array(F.collect_list(F.struct(F.col(kx).alias("x"), F.col(ky).alias("y")))).alias("_k"))
    p = points.crossJoin(F.broadcast(k))  # one row
    lo = F.try_element_at(F.filter("_k", lambda e: e["x"] <= F.col(x)), F.lit(-1))
    hi = F.try_element_at(F.filter("_k", lambda e: e["x"] > F.col(x)), F.lit(1))
    p = p.withColumns({"_lo": lo, "_hi": hi})
    y = F.when(F.col("_lo").isNull(), F.col("_hi.y")).when(F.col("_hi").isNull(), F.col("_lo.y"))
    y = y.otherwise(F.col("_lo.y") + (F.col("_hi.y") - F.col("_lo.y")) * (F.col(x) - F.col("_lo.x")) / F.nullif(F.col("_hi.x") - F.col("_lo.x"), F.lit(0.0)))
    return p.withColumn(out, y).drop("_k", "_lo", "_hi")


def savgol5(rows: DataFrame, group: str, order: str, value: str, out: str) -> DataFrame:
    """Window 5, order 2 smoothing inside runs of neighbouring whole-number bins without nulls; shorter runs and ends keep a quadratic's fit through their nearest five.

    Runs of fewer than five values are left as they are.
    """
    w = Window.partitionBy(group).orderBy(order)
    rows = rows.where(F.col(value).isNotNull()).withColumn("_new", (F.col(order) - F.lag(order).over(w) != 1).cast("int"))
    rows = rows.withColumn("_run", F.sum(F.coalesce("_new", F.lit(0))).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    r = Window.partitionBy(group, "_run")
    ro = r.orderBy(order)
    rows = rows.withColumns({"_n": F.count("*").over(r), "_i": F.row_number().over(ro), "_all": F.collect_list(value).over(ro.rowsBetween(-4, 4))})
    # position of the value in the five around it, shifted inward at the ends
    at = {0: (31, 9, -3, -5, 3), 1: (9, 13, 12, 6, -5), 2: (-3, 12, 17, 12, -3), 3: (-5, 6, 12, 13, 9), 4: (3, -5, -3, 9, 31)}
    back = F.least(F.col("_i") - 1, F.lit(4))
    pos = F.when(F.col("_i") <= 2, F.col("_i") - 1).when(F.col("_i") > F.col("_n") - 2, 4 - (F.col("_n") - F.col("_i"))).otherwise(2)
    start = back - pos  # 0-based start of the five inside _all
    y = F.lit(None).cast("double")
    for k, c in at.items():
        s = reduce(lambda a, b: a + b, [F.try_element_at("_all", (start + 1 + j).cast("int")) * float(c[j]) for j in range(5)])
        y = F.when(pos == k, s / 35.0).otherwise(y)
    return rows.withColumn(out, F.when(F.col("_n") >= 5, y).otherwise(F.col(value))).drop("_new", "_run", "_n", "_i", "_all")
