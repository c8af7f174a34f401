"""Dasymetric mapping: totals of areas spread over the buildings in them.

The heavy parts are overlay joins and group sums; the least-squares fit needs
only the tags' Gram matrix, which is one aggregate of tags x tags numbers, so
the solver runs on the driver whatever the number of buildings.
"""

from __future__ import annotations

import logging
import math

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from isoreach.operators.spatial import nearest, overlay_boxes

log = logging.getLogger(__name__)
BOX = ("x0", "y0", "x1", "y1")
CELL_BOX = ("cx0", "cy0", "cx1", "cy1")


def allocate(buildings: DataFrame, cells: DataFrame, intensities: DataFrame, fallback: float | None = None, grid: float = 100.0) -> DataFrame:
    """Top-down: spread each cell's total over the buildings that overlap it, by intensity times overlap area.

    buildings (building_id, tag, x0..y1), cells (cell_id, cx0..cy1, total),
    intensities (tag, intensity).  A cell without a prediction gives its total to
    the nearest building of a known tag within `fallback` of its centre; buildings
    that get nothing are left out.  Returns building_id, value.
    """
    known = buildings.join(intensities.where("intensity is not null"), "tag")
    parts = overlay_boxes(known, cells, grid, BOX, CELL_BOX).withColumn("_pred", F.col("intensity") * F.col("overlap_area"))
    total = F.sum("_pred").over(Window.partitionBy("cell_id"))
    shares = parts.withColumn("_value", F.when(total > 0, F.col("_pred") / total * F.col("total")).otherwise(F.lit(0.0)))
    out = shares.select("building_id", "cell_id", "_value", total.alias("_t"))
    given = out.groupBy("building_id").agg(F.sum("_value").alias("value"))
    if fallback is not None:
        served = out.where("_t > 0").select("cell_id").distinct()
        rest = cells.join(served, "cell_id", "left_anti").where("total > 0")
        rest = rest.select("cell_id", "total", ((F.col("cx0") + F.col("cx1")) / 2).alias("x"), ((F.col("cy0") + F.col("cy1")) / 2).alias("y"))
        centres = known.select("building_id", ((F.col("x0") + F.col("x1")) / 2).alias("dx"), ((F.col("y0") + F.col("y1")) / 2).alias("dy"))
        rescued = nearest(rest, "cell_id", centres, "building_id", fallback).groupBy("building_id").agg(F.sum("total").alias("value"))
        given = given.unionByName(rescued).groupBy("building_id").agg(F.sum("value").alias("value"))
    return given.where("value > 0")


def apply_intensities(buildings: DataFrame, intensities: DataFrame, digits: int | None = 2) -> DataFrame:
    """Bottom-up: intensity times area, rounded half to even; a null intensity gives 0, an unknown tag no row."""
    value = F.coalesce(F.col("intensity"), F.lit(0.0)) * F.col("area")
    return buildings.join(intensities, "tag").withColumn("value", value if digits is None else F.bround(value, digits)).drop("intensity")


def split_in_proportion(points: DataFrame, key: str, parents: DataFrame, parent_key: str, value: str) -> DataFrame:
    """A parent's total split over its points by their own value; a parent without value gives 0, a point without parent gets 0."""
    sums = points.groupBy(parent_key).agg(F.sum(value).alias("_s"))
    table = parents.select(F.col(parent_key).alias("_p"), F.col("total").alias("_t")).join(sums.withColumnRenamed(parent_key, "_sp"), F.col("_p") == F.col("_sp"))
    out = points.join(table, F.col(parent_key) == F.col("_p"), "left")
    return out.select(key, F.coalesce(F.col(value) / F.nullif(F.col("_s"), F.lit(0.0)) * F.col("_t"), F.lit(0.0)).alias("split"))


def merge_categories(tables: dict[str, DataFrame]) -> DataFrame:
    """Intensity tables (tag, intensity, n_observations) side by side; nulls where a tag is missing, the largest n kept."""
    out = None
    for name, df in tables.items():
        df = df.select("tag", F.col("intensity").alias(f"intensity_{name}"), F.col("n_observations").alias(f"_n_{name}"))
        out = df if out is None else out.join(df, "tag", "full")
    counts = [F.col(f"_n_{n}") for n in tables]
    n = counts[0] if len(counts) == 1 else F.greatest(*counts)
    return out.withColumn("n_observations", n).drop(*[f"_n_{x}" for x in tables])


def merge_values(tables: dict[str, DataFrame], key: str) -> DataFrame:
    """Value tables (key, value) side by side over all keys, 0 where a table has none."""
    long = None
    for name, df in tables.items():
        part = df.select(key, F.lit(name).alias("_c"), "value")
        long = part if long is None else long.unionByName(part)
    return long.groupBy(key).agg(*[F.coalesce(F.sum(F.when(F.col("_c") == n, F.col("value"))), F.lit(0.0)).alias(n) for n in tables])


def area_long(buildings: DataFrame, cells: DataFrame, fallback: float | None = None, grid: float = 100.0) -> DataFrame:
    """(cell_id, tag, area) of the buildings' centres in cells; a cell of a total without any takes its nearest one within fallback."""
    cx, cy = (F.col("x0") + F.col("x1")) / 2, (F.col("y0") + F.col("y1")) / 2
    centres = buildings.select("building_id", "tag", ((F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0"))).alias("area"), cx.alias("bx0"), cy.alias("by0"), (cx + 1e-9).alias("bx1"), (cy + 1e-9).alias("by1"))
    inside = overlay_boxes(centres, cells, grid, ("bx0", "by0", "bx1", "by1"), CELL_BOX).select("cell_id", "tag", "area")
    if fallback is not None:
        rest = cells.join(inside.select("cell_id").distinct(), "cell_id", "left_anti").where("total > 0")
        rest = rest.select("cell_id", ((F.col("cx0") + F.col("cx1")) / 2).alias("x"), ((F.col("cy0") + F.col("cy1")) / 2).alias("y"))
        near = nearest(rest, "cell_id", centres.select("building_id", "tag", "area", F.col("bx0").alias("dx"), F.col("by0").alias("dy")), "building_id", fallback)
        inside = inside.unionByName(near.select("cell_id", "tag", "area"))
    return inside.groupBy("cell_id", "tag").agg(F.sum("area").alias("area"))


def nnls(gram: np.ndarray, moment: np.ndarray, tolerance: float = 1e-10) -> np.ndarray:
    """Non-negative least squares from X'X and X'y, by the active-set method."""
    n = len(moment)
    beta, free = np.zeros(n), np.zeros(n, dtype=bool)
    for _ in range(10 * n + 10):
        slope = moment - gram @ beta
        slope[free] = -np.inf
        best = int(np.argmax(slope)) if n else 0
        if not n or slope[best] <= tolerance * max(1.0, np.abs(moment).max()):
            break
        free[best] = True
        while True:
            trial = np.zeros(n)
            trial[free] = np.linalg.lstsq(gram[np.ix_(free, free)], moment[free], rcond=None)[0]
            if (trial[free] > 0).all():
                beta = trial
                break
            low = free & (trial <= 0)
            step = (beta[low] / (beta[low] - trial[low])).min()
            beta = beta + step * (trial - beta)
            free &= beta > tolerance
            beta[~free] = 0
            if not free.any():
                break
    return beta


def fit_intensities(spark: SparkSession, areas: DataFrame, cells: DataFrame) -> DataFrame:
    """tag, intensity, p_value, contribution, n_observations by non-negative least squares of cell totals on tag areas.

    areas (cell_id, tag, area), cells (cell_id, total).  Intensities are rescaled
    so that the predictions of the reachable cells add up to all totals; p is
    two-sided normal.  Tags in proportional areas raise a warning.
    """
    used = areas.where("area > 0")
    left, right = used.select("cell_id", F.col("tag").alias("t"), F.col("area").alias("a")), used.select("cell_id", F.col("tag").alias("u"), F.col("area").alias("b"))
    pairs = left.join(right, "cell_id").groupBy("t", "u").agg(F.sum(F.col("a") * F.col("b")).alias("g"), F.count("*").alias("n")).collect()  # tags x tags
    moments = used.join(cells, "cell_id").groupBy("tag").agg(F.sum(F.col("area") * F.col("total")).alias("m"), F.sum("area").alias("area"), F.count("*").alias("n")).collect()
    reached = cells.join(used.select("cell_id").distinct(), "cell_id", "left_semi").agg(F.count("*").alias("n"), F.sum(F.col("total") * F.col("total")).alias("yy")).first()
    everything = cells.agg(F.sum("total")).first()[0] or 0.0
    tags = sorted(r.tag for r in moments)
    at = {t: k for k, t in enumerate(tags)}
    gram, moment, area, counts = np.zeros((len(tags), len(tags))), np.zeros(len(tags)), np.zeros(len(tags)), np.zeros(len(tags), dtype=int)
    for r in pairs:
        gram[at[r.t], at[r.u]] = r.g
    for r in moments:
        moment[at[r.tag]], area[at[r.tag]], counts[at[r.tag]] = r.m, r.area, r.n
    n = reached.n or 0
    _warn_collinear(tags, gram, area, n)
    beta = nnls(gram, moment)
    rss = max(0.0, float((reached.yy or 0.0) - 2 * beta @ moment + beta @ gram @ beta))
    used_tags = beta > 0
    se = np.full(len(tags), np.nan)
    if used_tags.any() and n > used_tags.sum():
        inverse = np.linalg.pinv(gram[np.ix_(used_tags, used_tags)])
        se[used_tags] = np.sqrt(np.maximum(np.diag(inverse), 0) * rss / (n - used_tags.sum()))
    predicted = float(beta @ area)
    beta_out = beta * (everything / predicted) if predicted > 0 else beta
    rows = []
    for k, t in enumerate(tags):
        z = beta[k] / se[k] if se[k] and not math.isnan(se[k]) else (math.inf if beta[k] > 0 else 0.0)
        rows.append((t, float(beta_out[k]), math.erfc(z / math.sqrt(2)) if z != math.inf else 0.0, float(beta_out[k] * area[k]), int(counts[k])))
    return spark.createDataFrame(rows, "tag string, intensity double, p_value double, contribution double, n_observations long")


def _warn_collinear(tags: list[str], gram: np.ndarray, sums: np.ndarray, n: int, limit: float = 0.99) -> list[tuple[str, str]]:
    """Pairs of tags whose areas correlate above the limit, from the Gram sums alone."""
    if n < 2:
        return []
    cov = gram / n - np.outer(sums, sums) / n**2
    sd = np.sqrt(np.maximum(np.diag(cov), 0))
    found = [(tags[i], tags[j]) for i in range(len(tags)) for j in range(i) if sd[i] > 0 and sd[j] > 0 and abs(cov[i, j] / (sd[i] * sd[j])) > limit]
    for a, b in found:
        log.warning("collinearity: the areas of %s and %s are all but proportional", a, b)
    return found


def uncap_private(cells: DataFrame, key: str, value: str, most: int, weights: tuple[float, ...], seed: int) -> DataFrame:
    """Values that were raised to `most` for privacy, drawn anew from 1..most by fixed weights; the draw is a hash of key and seed."""
    u = (F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(1 << 30)) + 0.5) / float(1 << 30)
    total, cum, draw = sum(weights), 0.0, F.lit(most)
    steps = []
    for k, w in enumerate(weights, 1):
        cum += w / total
        steps.append((cum, k))
    for edge, k in reversed(steps):
        draw = F.when(u < edge, k).otherwise(draw)
    return cells.withColumn(value, F.when(F.col(value) == most, draw).otherwise(F.col(value)))


def split_tags(buildings: DataFrame, strata: DataFrame, key: str, tags: list[str]) -> DataFrame:
    """tag -> tag__stratum for the given tags; others stay."""
    out = buildings.join(strata.select(key, "stratum"), key, "left")
    return out.withColumn("tag", F.when(F.col("tag").isin(*tags) & F.col("stratum").isNotNull(), F.concat_ws("__", "tag", "stratum")).otherwise(F.col("tag"))).drop("stratum")


def stratum(density, breaks: list[float], names: list[str]):
    """Name of a density's class, right-closed; null belongs to the first."""
    out = F.lit(names[-1])
    for b, name in reversed(list(zip(breaks, names, strict=False))):
        out = F.when(density.isNull() | (density <= b), F.lit(name)).otherwise(out)
    return out


def unmatched_tags(buildings: DataFrame, intensities: DataFrame) -> DataFrame:
    """Tags of buildings that have no intensity, with the number of buildings."""
    return buildings.join(intensities, "tag", "left_anti").groupBy("tag").agg(F.count("*").alias("n"))
