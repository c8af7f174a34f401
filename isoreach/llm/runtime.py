"""Cluster plumbing shared by the operators: shipping code, shared storage.

Intermediate tables are written as Parquet under the folder that the cluster
names in ``spark.checkpoint.dir`` and read again.  This cuts lineage, survives
the loss of executors, and gives the planner real sizes for the next join.
"""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PACKAGE = Path(__file__).resolve().parent.parent
LOCAL_SHARED = "/tmp/checkpoints/isoreach"

_shipped: set[str] = set()
_written: list[tuple[SparkSession, str]] = []


def ship(spark: SparkSession) -> None:
    """Give this package to the executors' Python workers, once per application."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    folder = tempfile.mkdtemp(prefix="isoreach-ship-")
    target = os.path.join(folder, "isoreach_pkg.zip")
    with zipfile.ZipFile(target, "w") as z:
        for name in ("__init__.py", *(f"llm/{p.name}" for p in sorted((PACKAGE / "llm").glob("*.py")))):
            z.write(PACKAGE / name, f"isoreach/{name}")
    sc.addPyFile(target)  # the driver's file server hands it out; executors need no shared disk for it
    _shipped.add(sc.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; a folder of our own only in local mode, where it is unset."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    os.makedirs(LOCAL_SHARED, exist_ok=True)
    return f"file://{LOCAL_SHARED}"


def stash(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write df once to the shared folder and return it as read from there."""
    path = f"{shared_dir(spark)}/isoreach-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written.append((spark, path))
    out = spark.read.schema(df.schema).parquet(path)
    out._stash_path = path
    return out


def smallest_hashes(df: DataFrame, key: str, rows: int) -> DataFrame:
    """The rows of the smallest hashes of a key, about `rows` of them at most: a sample that doesn't depend on partitions.

    A cut by the number of all rows comes first, with twice what is wanted below
    it, so that what tasks hand on doesn't grow with their number.
    """
    share = min(1.0, 2.0 * rows / max(1, df.count()))
    u = F.pmod(F.xxhash64(key, F.lit(rows)), F.lit(1 << 40)) / float(1 << 40)
    return df.where(u < share).orderBy(u, key).limit(rows)


def release(spark: SparkSession, *frames: DataFrame) -> None:
    """Delete stashed tables that no later step reads."""
    for df in frames:
        path = getattr(df, "_stash_path", None)
        if path:
            _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


@atexit.register
def _sweep() -> None:
    for spark, path in _written:
        try:
            if spark.sparkContext._jsc is not None:
                _delete(spark, path)
        except Exception:  # the session has gone; the cluster's own cleaning removes the folder
            return
