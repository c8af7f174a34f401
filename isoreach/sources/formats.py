"""Readers for raw formats that Spark has no source for."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HALF_DAY_MIN = 24 * 60


def read_any(spark: SparkSession, path: str, schema: str | None = None, separator: str = ",") -> DataFrame:
    """A table by the path's ending: parquet, orc, json or csv; others are an error."""
    kind = path.rstrip("/").rsplit(".", 1)[-1].lower()
    if kind in ("parquet", "orc"):
        return spark.read.format(kind).load(path)
    if kind == "json":
        return (spark.read.schema(schema) if schema else spark.read).json(path)
    if kind == "csv":
        reader = spark.read.option("header", True).option("sep", separator)
        return (reader.schema(schema) if schema else reader).csv(path)
    raise ValueError(f"no reader for .{kind}")


def read_raw_survey(spark: SparkSession, path: str, separator: str = ";") -> DataFrame:
    """A survey's raw csv as text columns in lower case; names that then clash, or a single column, are errors."""
    df = spark.read.option("header", True).option("sep", separator).csv(path)
    if len(df.columns) < 2:
        raise ValueError(f"{path} has one column: the separator isn't {separator!r}")
    names = [c.strip().lower() for c in df.columns]
    if len(set(names)) < len(names):
        raise ValueError("column names clash in lower case")
    return df.toDF(*names)


def read_matrix_text(spark: SparkSession, path: str) -> DataFrame:
    """A text matrix ($O format): (orig, dest, value) rows between the header and the names' section, value times the file's factor.

    The factor stands on the fifth line; each data line has two whole numbers and a
    value.  The file is read as lines in parallel; only the factor is looked up first.
    """
    lines = spark.read.text(path)
    head = [r[0].strip() for r in lines.limit(8).collect()]
    factor = float(head[4]) if len(head) > 4 else 1.0
    parts = F.split(F.trim("value"), r"\s+")
    data = lines.where(F.col("value").rlike(r"^\s*\d+\s+\d+\s+-?[0-9.]+([eE][-+]?\d+)?\s*$"))
    return data.select(parts[0].cast("long").alias("orig"), parts[1].cast("long").alias("dest"), (parts[2].cast("double") * factor).alias("value"))


def clean_times(matrix: DataFrame, zones: DataFrame) -> DataFrame:
    """Pairs of known zones in seconds; times beyond a day stay as pairs without a value.  zones: zone_no, zone_id."""
    o, d = zones.select(F.col("zone_no").alias("_on"), F.col("zone_id").alias("orig_id")), zones.select(F.col("zone_no").alias("_dn"), F.col("zone_id").alias("dest_id"))
    out = matrix.join(o, F.col("orig") == F.col("_on")).join(d, F.col("dest") == F.col("_dn"))
    return out.select("orig_id", "dest_id", F.when(F.col("value") <= HALF_DAY_MIN, (F.col("value") * 60).cast("float")).alias("value"))


def sum_columns(df: DataFrame, groups: dict[str, list[str]]) -> DataFrame:
    """Adds sums of columns; one that the table lacks, or a null, counts 0."""
    have = set(df.columns)
    add = lambda cols: reduce(lambda a, b: a + b, [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in cols if c in have], F.lit(0.0))
    return df.withColumns({name: add(cols) for name, cols in groups.items()})


def tag_matches(features: DataFrame, wanted: list[tuple[str, str, str, float]]) -> DataFrame:
    """One row for each (feature, category) that a tag of the feature matches: features (osm_type, osm_id, tags map), wanted (key, value or '*', category, weight).

    Of several matches of one category the heaviest stays.
    """
    table = features.sparkSession.createDataFrame(wanted, "wkey string, wvalue string, category string, weight double")
    one = features.select("osm_type", "osm_id", F.explode(F.map_entries("tags")).alias("t")).select("osm_type", "osm_id", "t.key", "t.value")
    hit = one.join(F.broadcast(table), (F.col("key") == F.col("wkey")) & ((F.col("wvalue") == "*") | (F.col("value") == F.col("wvalue"))))
    best = F.max_by(F.struct("key", "value", "weight"), F.struct("weight", "key", "value"))
    return hit.groupBy("osm_type", "osm_id", "category").agg(best.alias("b")).select("osm_type", "osm_id", "category", "b.key", "b.value", "b.weight")


def buildings_from_ways(ways: DataFrame) -> DataFrame:
    """Closed ways of four points at least (nodes array); members of multipolygon relations come with the relation's id negated."""
    closed = (F.size("nodes") >= 4) & (F.element_at("nodes", 1) == F.element_at("nodes", -1))
    return ways.where(closed).select(F.when(F.col("is_relation"), -F.col("id")).otherwise(F.col("id")).alias("building_id"), "tags", "nodes")


def obstacles(features: DataFrame) -> DataFrame:
    """kind, osm_id of the highway values that hinder; a signalised crossing is a crossing and a signal."""
    kinds = ("traffic_signals", "crossing", "stop", "give_way", "mini_roundabout")
    h, c = F.try_element_at("tags", F.lit("highway")), F.try_element_at("tags", F.lit("crossing"))
    rows = features.select("osm_id", h.alias("kind"), (c == "traffic_signals").alias("signal")).where(F.col("kind").isin(*kinds))
    twice = rows.where((F.col("kind") == "crossing") & F.col("signal")).select("osm_id", F.lit("traffic_signals").alias("kind"))
    return rows.select("osm_id", "kind").unionByName(twice)


def clip(features: DataFrame, area: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    """Features whose point is inside the area's rings; a box filter comes first, which the scan can push down."""
    from isoreach.operators.spatial import points_in_polygons

    box = area.select(F.min(F.array_min(F.transform("ring", lambda p: p["x"]))).alias("x0"), F.max(F.array_max(F.transform("ring", lambda p: p["x"]))).alias("x1"), F.min(F.array_min(F.transform("ring", lambda p: p["y"]))).alias("y0"), F.max(F.array_max(F.transform("ring", lambda p: p["y"]))).alias("y1")).first()
    near = features.where(F.col(x).between(box.x0, box.x1) & F.col(y).between(box.y0, box.y1))
    return points_in_polygons(near, area.select("ring"), xy=(x, y)).select(*features.columns).distinct()


def read_jdbc(spark: SparkSession, url: str, table: str, column: str, low: int, high: int, parts: int) -> DataFrame:
    """A database table in parallel ranges of a number column; paging by offset would need an order to be repeatable."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, partitionColumn=column, lowerBound=low, upperBound=high, numPartitions=parts).load()


def with_statistic(rows: DataFrame, table: DataFrame, name: str, variable: str) -> tuple[DataFrame, int]:
    """One variable of a long statistics table (name, variable, value) joined by name, and the number of names without it."""
    one = table.where(F.col("variable") == variable).select(F.col("name").alias("_n"), F.col("value").alias(variable))
    out = rows.join(one, F.col(name) == F.col("_n"), "left")
    return out.drop("_n"), out.where("_n is null").select(name).distinct().count()


def pixels_to_points(pixels: DataFrame, x0: float, y0: float, size: float, no_data: float) -> DataFrame:
    """Centres of the pixels (col, row, value) that hold people, rows counted downward from the upper left corner."""
    kept = pixels.where((F.col("value") > 0) & (F.col("value") != no_data))
    return kept.select((F.lit(x0) + (F.col("col") + 0.5) * size).alias("x"), (F.lit(y0) - (F.col("row") + 0.5) * size).alias("y"), "value")


def merge_pages(pages: list[DataFrame], key: str, order: str) -> DataFrame:
    """Pages as one table; of rows that repeat a key the first by `order` stays."""
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), pages)
    cols = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.min_by(F.struct(*cols), order).alias("b")).select(key, "b.*")


def postcode_points(points: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One point a postcode (the smallest place), and each municipality's mean of its postcodes."""
    post = points.groupBy("postcode", "municipality").agg(F.min(F.struct("x", "y")).alias("p")).groupBy("postcode").agg(F.min(F.struct("municipality", "p")).alias("m"))
    post = post.select("postcode", "m.municipality", "m.p.x", "m.p.y")
    return post, post.groupBy("municipality").agg(F.avg("x").alias("x"), F.avg("y").alias("y"))


def hectare_points(rows: DataFrame, key: str = "id") -> DataFrame:
    """x and y from ids 'x:y'."""
    parts = F.split(key, ":")
    return rows.withColumns({"x": parts[0].try_cast("double"), "y": parts[1].try_cast("double")})


def mosaic(tiles: DataFrame, box: tuple[int, int, int, int]) -> DataFrame:
    """Pixels (tile, col, row, value) of several tiles as one raster within (col0, row0, col1, row1), ends included; the later tile covers the earlier, then the larger value."""
    inside = tiles.where(F.col("col").between(box[0], box[2]) & F.col("row").between(box[1], box[3]))
    return inside.groupBy("col", "row").agg(F.max(F.struct("tile", "value")).alias("m")).select("col", "row", "m.value")


#: Tags of ways that any rule here reads, as exact keys and prefixes; others are dropped at the source.
USEFUL_TAGS = ("highway", "access", "oneway", "junction", "lanes", "maxspeed", "surface", "smoothness", "tracktype", "cycleway", "bicycle", "foot", "motor_vehicle", "motorcar", "service", "footway", "sidewalk", "bridge", "tunnel", "sac_scale", "mtb:scale", "area", "cyclestreet", "vehicle")


def highway_ways(ways: DataFrame, relations: DataFrame | None = None) -> DataFrame:
    """Ways (id, tags map, nodes array) that are roads or paths, with useful tags only; members of mountain-bike routes get mtb_route=yes.

    relations: tags map, members array of way ids.  The ways are read as a table
    that was extracted before, since no reader of the binary format is at hand.
    """
    keep = lambda k, v: F.split(k, ":")[0].isin(*USEFUL_TAGS) | k.isin(*USEFUL_TAGS)
    roads = ways.where(F.try_element_at("tags", F.lit("highway")).isNotNull() & (F.size("nodes") >= 2))
    roads = roads.select("id", F.map_filter("tags", keep).alias("tags"), "nodes")
    if relations is None:
        return roads
    routes = relations.where(F.try_element_at("tags", F.lit("route")) == "mtb").select(F.explode("members").alias("_m")).distinct()
    marked = F.when(F.col("_m").isNotNull(), F.map_concat(F.map_filter("tags", lambda k, v: k != "mtb_route"), F.create_map(F.lit("mtb_route"), F.lit("yes")))).otherwise(F.col("tags"))
    return roads.join(routes, F.col("id") == F.col("_m"), "left").select("id", marked.alias("tags"), "nodes")


def lakes(layer: DataFrame, ring: str = "ring", tolerance: float = 2.0) -> DataFrame:
    """Lake outlines without heights, simplified."""
    from isoreach.operators.geometry import simplify

    flat = layer.withColumn(ring, F.transform(ring, lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"))))
    return simplify(flat, ring, tolerance)
