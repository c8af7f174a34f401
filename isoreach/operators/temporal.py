"""Joins and frames over time: as-of, interval and windowed joins, neighbours in order, sliding frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _seconds(c: Column) -> Column:
    return c.cast("timestamp").cast("double")


def as_of(left: DataFrame, right: DataFrame, key: str, time: str, right_time: str, values: list[str], width: float = 86_400.0, tolerance: float | None = None) -> DataFrame:
    """Each left row with the values of the right row of its key that came last, at its time or before; null without one.

    Rows meet in buckets of key and time, so a busy key is dealt to many tasks.
    What a bucket starts from is the last right row of the buckets before it, and
    these make one row a bucket.  Of right rows at one time the one with the
    largest values counts; one older than the tolerance in seconds doesn't.
    """
    last = F.struct(_seconds(F.col(right_time)).alias("at"), *[F.col(v) for v in values])
    at = lambda c: F.floor(_seconds(F.col(c)) / width).cast("long")
    r = right.where(F.col(right_time).isNotNull() & F.col(key).isNotNull()).select(F.col(key).alias("_k"), at(right_time).alias("_b"), _seconds(F.col(right_time)).alias("_t"), last.alias("_v"))
    le = left.select("*", F.col(key).alias("_k"), at(time).alias("_b"), _seconds(F.col(time)).alias("_t"))
    ends = r.groupBy("_k", "_b").agg(F.max("_v").alias("_end"))
    buckets = ends.unionByName(le.select("_k", "_b").distinct().withColumn("_end", F.lit(None).cast(ends.schema["_end"].dataType)))
    buckets = buckets.groupBy("_k", "_b").agg(F.max("_end").alias("_end"))
    before = F.last("_end", ignorenulls=True).over(Window.partitionBy("_k").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1))
    carried = buckets.select(F.col("_k").alias("_ck"), F.col("_b").alias("_cb"), before.alias("_carry"))
    both = le.withColumn("_v", F.lit(None).cast(ends.schema["_end"].dataType)).withColumn("_side", F.lit(1))
    both = both.unionByName(r.withColumn("_side", F.lit(0)), allowMissingColumns=True)
    frame = Window.partitionBy("_k", "_b").orderBy("_t", "_side", "_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    met = both.withColumn("_seen", F.last("_v", ignorenulls=True).over(frame)).where("_side = 1")
    out = met.join(carried, F.col("_k").eqNullSafe(F.col("_ck")) & F.col("_b").eqNullSafe(F.col("_cb")), "left")
    hit = F.coalesce("_seen", "_carry")
    hit = hit if tolerance is None else F.when(F.col("_t") - hit["at"] <= tolerance, hit)
    return out.select(*left.columns, *[hit[v].alias(v) for v in values])


def within_intervals(points: DataFrame, intervals: DataFrame, key: str, time: str, start: str, stop: str, width: float) -> DataFrame:
    """Pairs of a point and each interval [start, stop) of its key that holds it, by buckets of time as wide as a usual interval."""
    at = lambda c: F.floor(_seconds(F.col(c)) / width).cast("long")
    p = points.withColumn("_b", at(time))
    last = F.ceil(_seconds(F.col(stop)) / width).cast("long") - 1
    i = intervals.where(F.col(start) < F.col(stop)).withColumnRenamed(key, "_ik").withColumn("_ib", F.explode(F.sequence(at(start), F.greatest(at(start), last))))
    pairs = p.join(i, (F.col(key) == F.col("_ik")) & (F.col("_b") == F.col("_ib")))
    return pairs.where((F.col(time) >= F.col(start)) & (F.col(time) < F.col(stop))).drop("_b", "_ib", "_ik")


def neighbours_in_order(rows: DataFrame, key: str, order: list[str], value: str, tiles: int) -> DataFrame:
    """The value before and after each row of its key, and the row's tile of equally large ones."""
    w = Window.partitionBy(key).orderBy(*order)
    return rows.withColumns({"before": F.lag(value).over(w), "after": F.lead(value).over(w), "tile": F.ntile(tiles).over(w)})


def sliding(rows: DataFrame, key: str, time: str, value: str, seconds: int) -> DataFrame:
    """Number and sum of the values of a row's key in the last seconds, its own included."""
    w = Window.partitionBy(key).orderBy(F.col(time).cast("timestamp").cast("long")).rangeBetween(-seconds, 0)
    return rows.withColumns({"n_recent": F.count("*").over(w), "sum_recent": F.sum(value).over(w)})
