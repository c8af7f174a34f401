"""Spatial assignment joins: a spatial predicate becomes an equi-join on grid buckets.

No join here compares all rows with all rows.  Points are bucketed by a square
grid as wide as the search radius, so that a point's partners lie in its own or
the eight neighbouring buckets; the smaller side is the one to be repeated.
Distances are compared exactly afterwards.  Ties are broken by id throughout.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isoreach.sources.store import release, stash


def bucket(x: Column | str, size: float) -> Column:
    return F.floor((F.col(x) if isinstance(x, str) else x) / F.lit(float(size))).cast("long")


def distance(ax: str, ay: str, bx: str, by: str) -> Column:
    """Straight-line distance (hypotenuse) of two planar points."""
    dx, dy = F.col(ax) - F.col(bx), F.col(ay) - F.col(by)
    return F.sqrt(dx * dx + dy * dy)


def within_radius(left: DataFrame, right: DataFrame, radius: float, lxy: tuple[str, str] = ("x", "y"), rxy: tuple[str, str] = ("dx", "dy"), out: str = "dist") -> DataFrame:
    """All (left, right) pairs at most radius apart, with their distance.  Column names must not clash.

    right is repeated nine times, so it should be the smaller side.  Null
    coordinates meet nothing.
    """
    r = float(radius)
    near = F.explode(F.array(*[F.struct((bucket(rxy[0], r) + i).alias("gx"), (bucket(rxy[1], r) + j).alias("gy")) for i in (-1, 0, 1) for j in (-1, 0, 1)]))
    right = right.withColumn("_g", near)
    left = left.withColumns({"_gx": bucket(lxy[0], r), "_gy": bucket(lxy[1], r)})
    pairs = left.join(right, (F.col("_gx") == F.col("_g.gx")) & (F.col("_gy") == F.col("_g.gy")))
    return pairs.withColumn(out, distance(*lxy, *rxy)).where(F.col(out) <= r).drop("_gx", "_gy", "_g")


def once_a_place(left: DataFrame, key: str, xy: tuple[str, str] = ("x", "y")) -> tuple[DataFrame, DataFrame]:
    """(places, members): what depends on a row's place only is worked out for places (key, x, y), the row of the smallest
    key of each, and holds for all its members (_unit, key).  Rows without a place are in neither.

    A key that several rows share, or null, stays by itself with all its rows, as
    its results are made of all of them.
    """
    spark = left.sparkSession
    rows = left.select(key, *xy).withColumn("_n", F.count("*").over(Window.partitionBy(key)))
    rows = stash(spark, rows.where(F.col(xy[0]).isNotNull() & F.col(xy[1]).isNotNull()), "place-rows")
    alone = F.col(key).isNotNull() & (F.col("_n") == 1)
    own, shared = rows.where(alone), rows.where(~alone)
    places = stash(spark, own.groupBy(*xy).agg(F.min(key).alias(key)).select(key, *xy).unionByName(shared.select(key, *xy)), "places")
    at = own.groupBy(*(F.col(c).alias(f"_p{c}") for c in xy)).agg(F.min(key).alias(key))
    members = own.withColumnRenamed(key, "_unit").join(at, (F.col(xy[0]) == F.col(f"_p{xy[0]}")) & (F.col(xy[1]) == F.col(f"_p{xy[1]}"))).select("_unit", key)
    return places, members.unionByName(shared.select(F.col(key).alias("_unit"), key).distinct())


def to_members(found: DataFrame, members: DataFrame, key: str) -> DataFrame:
    """The rows found for places (once_a_place), repeated for each of the places' members."""
    m = members.withColumnRenamed(key, "_place")
    return m.join(found, F.col("_place").eqNullSafe(F.col(key))).select(F.col("_unit").alias(key), *[c for c in found.columns if c != key])


def at_places(left: DataFrame, key: str, find: Callable[[DataFrame], DataFrame], xy: tuple[str, str] = ("x", "y")) -> DataFrame:
    """find(rows of key and place) for all left rows, where it depends on a row's place only: worked out once a place."""
    places, members = once_a_place(left, key, xy)
    return to_members(find(places), members, key)


def sum_within_radius(left: DataFrame, key: str, right: DataFrame, weights: list[str], radius: float, density: bool = False, lxy: tuple[str, str] = ("x", "y"), rxy: tuple[str, str] = ("dx", "dy")) -> DataFrame:
    """Circular sums of the right side's weights about each left row, 0 where there are none; density divides by the circle's area."""
    area = math.pi * radius * radius if density else 1.0
    sums = at_places(left, key, lambda places: within_radius(places, right, radius, lxy, rxy).groupBy(key).agg(*[(F.sum(w) / F.lit(area)).alias(f"{w}_r{radius:g}") for w in weights]), lxy)
    names = [f"{w}_r{radius:g}" for w in weights]
    return left.join(sums, key, "left").withColumns({n: F.coalesce(F.col(n), F.lit(0.0)) for n in names})


def nearest(left: DataFrame, key: str, right: DataFrame, right_key: str, max_distance: float, k: int = 1, lxy: tuple[str, str] = ("x", "y"), rxy: tuple[str, str] = ("dx", "dy")) -> DataFrame:
    """The k nearest right rows within max_distance of each left row: left columns, right columns, dist, rank."""
    pairs = within_radius(left, right, max_distance, lxy, rxy)
    if k == 1:  # a combinable aggregate: no sort, and one row a key leaves each map task
        cols = [c for c in pairs.columns if c != key]
        best = pairs.groupBy(key).agg(F.min_by(F.struct(*cols), F.struct("dist", right_key)).alias("b"))
        return best.select(key, "b.*", F.lit(1).alias("rank"))
    w = Window.partitionBy(key).orderBy("dist", right_key)
    return pairs.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _box(df: DataFrame, xy: tuple[str, str]) -> tuple[float, float, float, float] | None:
    """(x0, y0, x1, y1) of the rows that have a place, None without any."""
    rows = df.where(F.col(xy[0]).isNotNull() & F.col(xy[1]).isNotNull())
    r = rows.agg(*(f(c).cast("double") for f in (F.min, F.max) for c in xy)).first()
    return None if r[0] is None else tuple(r)


def nearest_unbounded(left: DataFrame, key: str, right: DataFrame, right_key: str, start: float, lxy: tuple[str, str] = ("x", "y"), rxy: tuple[str, str] = ("dx", "dy")) -> DataFrame:
    """The nearest right row of each left row: left columns, right columns, dist, rank; one row for each left row.

    The radius grows for the rows still without a partner, twofold, or at once to
    the least distance that a row has from the box of all partners, until it spans
    both sides.  Each round is stored, so no round runs again.  A left row without
    a place, or without any partner at all, has nulls.
    """
    spark = left.sparkSession
    names = [key, *[c for c in left.columns if c != key], *[c for c in right.columns], "dist", "rank"]
    placed = F.col(lxy[0]).isNotNull() & F.col(lxy[1]).isNotNull()
    rest, box = stash(spark, left, "nearest-rest"), _box(right, rxy)
    found, nowhere = [], rest.where(~placed)
    own = _box(rest, lxy)
    if box and own:
        partners = stash(spark, right, "nearest-right")
        span = math.hypot(max(box[2], own[2]) - min(box[0], own[0]), max(box[3], own[3]) - min(box[1], own[1]))
        gap = F.sqrt(sum(F.pow(F.greatest(F.lit(0.0), F.lit(box[k]) - F.col(c), F.col(c) - F.lit(box[k + 2])), F.lit(2.0)) for k, c in enumerate(lxy)))
        todo, r = rest.where(placed), float(start)
        while True:
            least = todo.agg(F.min(gap)).first()[0]
            if least is None:
                break
            r = max(r, min(least * (1 + 1e-9), span))
            hit = stash(spark, nearest(todo, key, partners, right_key, r, 1, lxy, rxy).select(*names), "nearest-hit")
            found.append(hit)
            left_over = stash(spark, todo.join(hit.select(key), key, "left_anti").select(*left.columns), "nearest-rest")
            release(spark, todo)
            todo = left_over
            if r > span:
                break
            r = max(2 * r, float(start))
        release(spark, partners)
    else:
        nowhere = rest
    kinds = dict(right.dtypes) | {"dist": "double", "rank": "int"}
    bare = nowhere.select(*[F.col(c) if c in left.columns else F.lit(None).cast(kinds[c]).alias(c) for c in names])
    return reduce(DataFrame.unionByName, [*found, bare])


def snap_with_priority(points: DataFrame, key: str, nodes: DataFrame, node_key: str, priority: str, near: float, far: float) -> DataFrame:
    """Nearest priority node within near, else nearest node within far; node and distance are null beyond."""
    first = nearest(points, key, nodes.where(F.col(priority)), node_key, near).select(F.col(key).alias("_k1"), F.col(node_key).alias("_n1"), F.col("dist").alias("_d1"))
    second = nearest(points, key, nodes, node_key, far).select(F.col(key).alias("_k2"), F.col(node_key).alias("_n2"), F.col("dist").alias("_d2"))
    out = points.join(first, F.col(key) == F.col("_k1"), "left").join(second, F.col(key) == F.col("_k2"), "left")
    return out.select(*points.columns, F.coalesce("_n1", "_n2").alias(node_key), F.coalesce("_d1", "_d2").alias("snap_distance"))


def in_ring(x: Column, y: Column, ring: Column) -> Column:
    """Ray casting: whether (x, y) is inside a closed ring of struct<x, y>; edges at the lower left belong to it."""
    edges = F.zip_with(ring, F.concat(F.slice(ring, 2, F.size(ring) - 1), F.slice(ring, 1, 1)), lambda a, b: F.struct(a.alias("a"), b.alias("b")))

    def crosses(e: Column) -> Column:
        a, b = e["a"], e["b"]
        return ((a["y"] > y) != (b["y"] > y)) & (x < (b["x"] - a["x"]) * (y - a["y"]) / F.nullif(b["y"] - a["y"], F.lit(0.0)) + a["x"])

    return F.size(F.filter(edges, lambda e: F.coalesce(crosses(e), F.lit(False)))) % 2 == 1


def points_in_polygons(points: DataFrame, polygons: DataFrame, ring: str = "ring", cell: float = 100.0, xy: tuple[str, str] = ("x", "y")) -> DataFrame:
    """Pairs of a point and each polygon that holds it, via grids of cells as wide as the polygons.

    A polygon is filed under the grid, of cell times a power of two, whose cells
    are no narrower than its bounding box, so in four cells at most; a point is
    looked up once in each of the grids that are in use, some dozens at most.
    """
    xs, ys = F.transform(ring, lambda p: p["x"]), F.transform(ring, lambda p: p["y"])
    boxes = polygons.withColumns({"_x0": F.array_min(xs), "_x1": F.array_max(xs), "_y0": F.array_min(ys), "_y1": F.array_max(ys)})
    widest = F.greatest(F.col("_x1") - F.col("_x0"), F.col("_y1") - F.col("_y0"), F.lit(float(cell)))
    boxes = boxes.withColumn("_level", F.ceil(F.log2(widest / float(cell)) - 1e-9).cast("int"))
    levels = sorted(r[0] for r in boxes.select("_level").distinct().collect() if r[0] is not None)
    size = F.lit(float(cell)) * F.pow(F.lit(2.0), F.col("_level"))
    at = lambda c: F.floor(F.col(c) / size).cast("long")
    boxes = boxes.withColumn("_px", F.explode(F.sequence(at("_x0"), at("_x1")))).withColumn("_py", F.explode(F.sequence(at("_y0"), at("_y1")))).drop("_x0", "_x1", "_y0", "_y1")
    boxes = boxes.withColumnRenamed("_level", "_plevel")
    placed = points.withColumn("_level", F.explode(F.array(*[F.lit(k) for k in levels]).cast("array<int>"))).withColumns({"_qx": at(xy[0]), "_qy": at(xy[1])})
    pairs = placed.join(boxes, (F.col("_level") == F.col("_plevel")) & (F.col("_qx") == F.col("_px")) & (F.col("_qy") == F.col("_py")))
    return pairs.where(in_ring(F.col(xy[0]), F.col(xy[1]), F.col(ring))).drop("_qx", "_qy", "_px", "_py", "_level", "_plevel")


def points_near_polygons(points: DataFrame, key: str, polygons: DataFrame, radius: float, ring: str = "ring", xy: tuple[str, str] = ("x", "y")) -> DataFrame:
    """Points inside a polygon or at most radius from its edge, each once: the polygon with a buffer, without building it."""
    inside = points_in_polygons(points, polygons.select(ring), ring, xy=xy).select(key)
    after = F.concat(F.slice(ring, 2, F.size(ring) - 1), F.slice(ring, 1, 1))
    edges = polygons.select(F.explode(F.zip_with(ring, after, lambda a, b: F.struct(a["x"].alias("x0"), a["y"].alias("y0"), b["x"].alias("x1"), b["y"].alias("y1")))).alias("e")).select("e.*")
    beside = near_segments(points, edges, radius, xy=xy).select(key)
    return points.join(inside.unionByName(beside).distinct(), key, "left_semi")


def polygon_else_nearest(points: DataFrame, key: str, polygons: DataFrame, polygon_key: str, centres: DataFrame, max_distance: float) -> DataFrame:
    """key -> polygon: the smallest id that holds the point, else the nearest centre within max_distance."""
    held = points_in_polygons(points, polygons).groupBy(key).agg(F.min(polygon_key).alias(polygon_key), F.lit(0.0).alias("dist"))
    rest = points.join(held.select(key), key, "left_anti")
    near = nearest(rest, key, centres, polygon_key, max_distance).select(key, polygon_key, "dist")
    return held.unionByName(near)


def overlay_boxes(left: DataFrame, right: DataFrame, cell: float, lbox: tuple[str, str, str, str], rbox: tuple[str, str, str, str]) -> DataFrame:
    """Overlapping pairs of axis-aligned boxes (x0, y0, x1, y1), with the area of the intersection.

    Both sides are filed under the grid cells that they cover; a pair counts only
    in the first cell that both have.
    """
    def filed(df: DataFrame, box: tuple[str, str, str, str], s: str) -> DataFrame:
        # a box that ends on a cell's edge doesn't reach into it
        last = lambda hi, lo: F.greatest((F.ceil(F.col(hi) / F.lit(float(cell))) - 1).cast("long"), bucket(lo, cell))
        df = df.withColumn(f"_{s}x", F.explode(F.sequence(bucket(box[0], cell), last(box[2], box[0]))))
        return df.withColumn(f"_{s}y", F.explode(F.sequence(bucket(box[1], cell), last(box[3], box[1]))))

    a, b = filed(left, lbox, "l"), filed(right, rbox, "r")
    pairs = a.join(b, (F.col("_lx") == F.col("_rx")) & (F.col("_ly") == F.col("_ry")))
    first = (F.col("_lx") == F.greatest(bucket(lbox[0], cell), bucket(rbox[0], cell))) & (F.col("_ly") == F.greatest(bucket(lbox[1], cell), bucket(rbox[1], cell)))
    w = F.least(lbox[2], rbox[2]) - F.greatest(lbox[0], rbox[0])
    h = F.least(lbox[3], rbox[3]) - F.greatest(lbox[1], rbox[1])
    return pairs.where(first & (w > 0) & (h > 0)).withColumn("overlap_area", w * h).drop("_lx", "_ly", "_rx", "_ry")


def point_segment_distance(px: Column, py: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Distance of a point to a line segment; a segment without length is a point."""
    dx, dy = x1 - x0, y1 - y0
    t = F.coalesce(((px - x0) * dx + (py - y0) * dy) / F.nullif(dx * dx + dy * dy, F.lit(0.0)), F.lit(0.0))
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), t))
    ex, ey = px - (x0 + t * dx), py - (y0 + t * dy)
    return F.sqrt(ex * ex + ey * ey)


def near_segments(points: DataFrame, segments: DataFrame, radius: float, seg: tuple[str, str, str, str] = ("x0", "y0", "x1", "y1"), xy: tuple[str, str] = ("x", "y")) -> DataFrame:
    """Pairs of a point and a segment at most radius apart, with their distance."""
    r = float(radius)
    x0, y0, x1, y1 = seg
    s = segments.withColumn("_sx", F.explode(F.sequence(bucket(F.least(x0, x1) - r, r), bucket(F.greatest(x0, x1) + r, r))))
    s = s.withColumn("_sy", F.explode(F.sequence(bucket(F.least(y0, y1) - r, r), bucket(F.greatest(y0, y1) + r, r))))
    p = points.withColumns({"_px": bucket(xy[0], r), "_py": bucket(xy[1], r)})
    pairs = p.join(s, (F.col("_px") == F.col("_sx")) & (F.col("_py") == F.col("_sy")))
    return pairs.withColumn("dist", point_segment_distance(F.col(xy[0]), F.col(xy[1]), *(F.col(c) for c in seg))).where(F.col("dist") <= r).drop("_px", "_py", "_sx", "_sy")


def median_level_along(edges: DataFrame, key: str, obstacles: DataFrame, level: str, radius: float) -> DataFrame:
    """Points at 1/4, 1/2 and 3/4 of each edge take the highest level within radius (0 without); the edge takes their median."""
    at = F.explode(F.array(*[F.struct(F.lit(q).alias("q"), (F.col("x0") + q * (F.col("x1") - F.col("x0"))).alias("x"), (F.col("y0") + q * (F.col("y1") - F.col("y0"))).alias("y")) for q in (0.25, 0.5, 0.75)]))
    points = edges.select(key, at.alias("p")).select(key, "p.q", "p.x", "p.y")
    hit = within_radius(points, obstacles, radius).groupBy(key, "q").agg(F.max(level).alias("top"))
    tops = points.join(hit, [key, "q"], "left").groupBy(key).agg(F.sort_array(F.collect_list(F.coalesce("top", F.lit(0)))).alias("t"))
    return tops.select(key, F.col("t")[1].alias(level))


def hectare_id(x: str, y: str, size: int = 100) -> Column:
    """The id 'E:N' of the lower left corner of a square cell."""
    return F.concat_ws(":", (bucket(x, size) * size).cast("string"), (bucket(y, size) * size).cast("string"))


def disc_sum(cells: DataFrame, col: str, row: str, value: str, radius: int) -> DataFrame:
    """Sum of value over the disc of radius cells about every grid cell of the table, by moving each cell over the disc's offsets."""
    offsets = [(i, j) for i in range(-radius, radius + 1) for j in range(-radius, radius + 1) if i * i + j * j <= radius * radius]
    moved = cells.select((F.col(col)).alias("_c"), (F.col(row)).alias("_r"), value, F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in offsets])).alias("o"))
    sums = moved.groupBy((F.col("_c") + F.col("o.i")).alias("_c"), (F.col("_r") + F.col("o.j")).alias("_r")).agg(F.sum(value).alias(f"{value}_disc"))
    return cells.join(sums, (F.col(col) == F.col("_c")) & (F.col(row) == F.col("_r"))).drop("_c", "_r")
