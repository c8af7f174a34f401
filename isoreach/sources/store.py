"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import os
import uuid

from pyspark.sql import DataFrame, SparkSession

LOCAL = "/tmp/checkpoints/isoreach-engine"


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where it is unset, a folder of our own, in local mode only."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    os.makedirs(LOCAL, exist_ok=True)
    return f"file://{LOCAL}"


_written: list[tuple[SparkSession, str]] = []


def stash(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write df once and return it as read again: a short plan of known size that survives lost executors."""
    path = f"{shared_dir(spark)}/isoreach-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written.append((spark, path))
    out = spark.read.schema(df.schema).parquet(path)
    out._stash_path = path
    return out


def release(spark: SparkSession, *frames: DataFrame) -> None:
    """Delete stored tables that no later step reads; a frame that isn't one is left alone."""
    for df in frames:
        path = getattr(df, "_stash_path", None)
        if path:
            _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


@atexit.register
def _sweep() -> None:
    for spark, path in _written:
        try:
            if spark.sparkContext._jsc is not None:
                _delete(spark, path)
        except Exception:  # the session has gone; the cluster's own cleaning removes the folder
            return
