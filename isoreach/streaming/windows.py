"""Extensions beyond batch: event streams by sessions and time-of-day windows.

The same expressions serve a stream and a table: with a watermark they run
incrementally, on a batch frame the watermark has no effect.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isoreach.functions.survey import hours


def sessions(events: DataFrame, user: str, ts: str, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """Runs of a user's events no more than the gap apart: user, start, end, n."""
    e = events.withWatermark(ts, late)
    g = e.groupBy(user, F.session_window(ts, gap).alias("w")).agg(F.count("*").alias("n"))
    return g.select(user, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def tumbling(events: DataFrame, ts: str, value: str, width: str = "1 hour", late: str = "1 hour") -> DataFrame:
    e = events.withWatermark(ts, late)
    g = e.groupBy(F.window(ts, width).alias("w")).agg(F.count("*").alias("n"), F.sum(value).alias("total"))
    return g.select(F.col("w.start").alias("start"), "n", "total")


def by_day_period(events: DataFrame, ts: str, value: str) -> DataFrame:
    """n and mean by peak, base and night."""
    weekday = (F.dayofweek(ts).between(2, 6)).cast("int")
    return events.withColumn("peak_str", hours(F.hour(ts), weekday)["peak_str"]).groupBy("peak_str").agg(F.count("*").alias("n"), F.avg(value).alias("mean"))


def read_events(spark, path: str, schema) -> DataFrame:
    """A folder of Parquet files as a stream."""
    return spark.readStream.schema(schema).parquet(path)
