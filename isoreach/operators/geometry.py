"""Geometry on arrays of struct<x, y>: areas, centroids, clipping, simplification, hexagons."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

POINTS = T.ArrayType(T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())]))


def _edges(ring: Column) -> Column:
    after = F.concat(F.slice(ring, 2, F.size(ring) - 1), F.slice(ring, 1, 1))
    return F.zip_with(ring, after, lambda a, b: F.struct(a["x"].alias("x0"), a["y"].alias("y0"), b["x"].alias("x1"), b["y"].alias("y1")))


def signed_area(ring: Column) -> Column:
    return F.aggregate(_edges(ring), F.lit(0.0), lambda acc, e: acc + (e["x0"] * e["y1"] - e["x1"] * e["y0"])) / 2


def area(ring: Column) -> Column:
    """Shoelace area of a ring, open or closed."""
    return F.abs(signed_area(ring))


def centroid(points: Column) -> Column:
    """Centroid of a closed ring's area, else of an open line by length; a single point is its own."""
    closed = (F.size(points) >= 4) & (F.element_at(points, 1) == F.element_at(points, -1))
    a = signed_area(points)
    ring = lambda u, v: F.aggregate(_edges(points), F.lit(0.0), lambda acc, e: acc + (e[u] + e[v]) * (e["x0"] * e["y1"] - e["x1"] * e["y0"])) / (6 * F.nullif(a, F.lit(0.0)))
    steps = F.slice(_edges(points), 1, F.greatest(F.size(points) - 1, F.lit(0)))
    length = lambda e: F.hypot(e["x1"] - e["x0"], e["y1"] - e["y0"])
    total = F.nullif(F.aggregate(steps, F.lit(0.0), lambda acc, e: acc + length(e)), F.lit(0.0))
    line = lambda u, v: F.aggregate(steps, F.lit(0.0), lambda acc, e: acc + (e[u] + e[v]) / 2 * length(e)) / total
    first = F.element_at(points, 1)
    pick = lambda u, v, c: F.coalesce(F.when(closed, ring(u, v)), line(u, v), first[c])
    return F.struct(pick("x0", "x1", "x").alias("x"), pick("y0", "y1", "y").alias("y"))


def length(points: Column) -> Column:
    steps = F.slice(_edges(points), 1, F.greatest(F.size(points) - 1, F.lit(0)))
    return F.aggregate(steps, F.lit(0.0), lambda acc, e: acc + F.hypot(e["x1"] - e["x0"], e["y1"] - e["y0"]))


def rounded(points: Column, digits: int) -> Column:
    return F.transform(points, lambda p: F.struct(F.bround(p["x"], digits).alias("x"), F.bround(p["y"], digits).alias("y")))


def _array(points) -> np.ndarray:
    return np.array([(p["x"], p["y"]) for p in points], dtype=float).reshape(-1, 2)


def _keep(p: np.ndarray, tolerance: float) -> np.ndarray:
    """Douglas-Peucker: which points stay; the farthest one beyond the tolerance splits a stretch."""
    keep = np.zeros(len(p), dtype=bool)
    keep[[0, -1]] = True
    todo = [(0, len(p) - 1)]
    while todo:
        a, b = todo.pop()
        if b - a < 2:
            continue
        d, q = p[b] - p[a], p[a + 1 : b] - p[a]
        n = float(d @ d)
        foot = np.clip(q @ d / n, 0.0, 1.0) if n else np.zeros(len(q))  # the nearest place of the stretch itself, not of its line
        off = np.hypot(q[:, 0] - foot * d[0], q[:, 1] - foot * d[1])
        k = int(off.argmax())
        if off[k] > tolerance:
            keep[a + 1 + k] = True
            todo += [(a, a + 1 + k), (a + 1 + k, b)]
    return keep


def _points(p: np.ndarray) -> list[dict]:
    return [{"x": float(x), "y": float(y)} for x, y in p]


def simplify(df: DataFrame, column: str, tolerance: float) -> DataFrame:
    """Lines without the points that lie within the tolerance of what is left."""
    @F.pandas_udf(POINTS)
    def run(it: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in it:
            yield s.map(lambda v: None if v is None else _points(_array(v)[_keep(_array(v), tolerance)]) if len(v) > 2 else list(v))

    return df.withColumn(column, run(column))


def simplify_to(df: DataFrame, column: str, most: int) -> DataFrame:
    """Lines of at most `most` points, by doubling the tolerance until they are."""
    @F.pandas_udf(POINTS)
    def run(it: Iterator[pd.Series]) -> Iterator[pd.Series]:
        def one(v):
            if v is None or len(v) <= most:
                return None if v is None else list(v)
            p, t = _array(v), 0.5
            while True:
                keep = _keep(p, t)
                if keep.sum() <= max(2, most):
                    return _points(p[keep])
                t *= 2

        for s in it:
            yield s.map(one)

    return df.withColumn(column, run(column))


def _clip(subject: np.ndarray, convex: np.ndarray) -> np.ndarray:
    """Sutherland-Hodgman: the part of a polygon inside a convex one."""
    cross = lambda o, a, b: (a[0] - o[0]) * (b[1] - o[1]) - (a[1] - o[1]) * (b[0] - o[0])
    if sum(cross((0, 0), convex[k], convex[(k + 1) % len(convex)]) for k in range(len(convex))) < 0:
        convex = convex[::-1]
    out = [tuple(p) for p in subject]
    for k in range(len(convex)):
        a, b, src, out = convex[k], convex[(k + 1) % len(convex)], out, []
        for i, q in enumerate(src):
            p = src[i - 1]
            sp, sq = cross(a, b, p), cross(a, b, q)
            if (sp >= 0) != (sq >= 0):
                t = sp / (sp - sq)
                out.append((p[0] + t * (q[0] - p[0]), p[1] + t * (q[1] - p[1])))
            if sq >= 0:
                out.append(q)
    return np.array(out, dtype=float).reshape(-1, 2)


def clip_convex(df: DataFrame, subject: str, convex: str, out: str) -> DataFrame:
    """The part of a polygon inside a convex polygon; an empty array if there is none."""
    @F.pandas_udf(POINTS)
    def run(it: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for s, c in it:
            yield pd.Series([_points(_clip(_array(a), _array(b))) for a, b in zip(s, c, strict=True)])

    return df.withColumn(out, run(subject, convex))


def difference_area(polygons: DataFrame, key: str, ring: str, holes: DataFrame, hole_ring: str, cell: float) -> DataFrame:
    """key -> area of a polygon without the convex, disjoint holes that lie in or across it."""
    from isoreach.operators.spatial import overlay_boxes

    def boxed(df: DataFrame, column: str, p: str) -> DataFrame:
        xs, ys = F.transform(column, lambda q: q["x"]), F.transform(column, lambda q: q["y"])
        return df.withColumns({f"{p}x0": F.array_min(xs), f"{p}y0": F.array_min(ys), f"{p}x1": F.array_max(xs), f"{p}y1": F.array_max(ys)})

    a, b = boxed(polygons, ring, "a"), boxed(holes, hole_ring, "b")
    pairs = overlay_boxes(a, b, cell, ("ax0", "ay0", "ax1", "ay1"), ("bx0", "by0", "bx1", "by1"))
    cut = clip_convex(pairs, ring, hole_ring, "_in").groupBy(key).agg(F.sum(area(F.col("_in"))).alias("_cut"))
    return polygons.join(cut, key, "left").select(key, (area(F.col(ring)) - F.coalesce("_cut", F.lit(0.0))).alias("area"))


def square_ring(x: Column, y: Column, size: float) -> Column:
    """A square's ring from its lower left corner."""
    at = lambda dx, dy: F.struct((x + dx).alias("x"), (y + dy).alias("y"))
    return F.array(at(0.0, 0.0), at(size, 0.0), at(size, size), at(0.0, size))


def hexagon(x: Column, y: Column, size: float) -> Column:
    """Axial id 'q:r' of the pointy-top hexagon of side `size` that holds a point, by rounding cube coordinates."""
    q = (math.sqrt(3) / 3 * x - y / 3) / size
    r = (2.0 / 3 * y) / size
    s = -q - r
    rq, rr, rs = F.rint(q), F.rint(r), F.rint(s)
    dq, dr, ds = F.abs(rq - q), F.abs(rr - r), F.abs(rs - s)
    fq = F.when((dq > dr) & (dq > ds), -rr - rs).otherwise(rq)
    fr = F.when(~((dq > dr) & (dq > ds)) & (dr > ds), -rq - rs).otherwise(rr)
    return F.concat_ws(":", fq.cast("long").cast("string"), fr.cast("long").cast("string"))
