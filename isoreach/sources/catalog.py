"""Named tables of a project: property layers, networks, tiered matrices, coefficients.

A catalog maps (kind, name) under a root to Parquet folders.  A catalog opened
on another namespace is read-only.
"""

from __future__ import annotations

import csv
import io
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Canonical units and their keys; other units are allowed.
KEYS = {"cells": "cell_id", "zones": "zone_id", "nodes": "node_id", "edges": "edge_id", "buildings": "building_id"}
TIERS = ("c2c", "c2z", "z2z")
KINDS = ("calibrated", "transferred", "manual")


class CatalogError(ValueError):
    pass


def check_key(df: DataFrame, key: str) -> DataFrame:
    """df, if key is a column of whole numbers or text without nulls or repetition."""
    if key not in df.columns:
        raise CatalogError(f"no key column {key}")
    if isinstance(df.schema[key].dataType, T.FloatType | T.DoubleType):
        raise CatalogError(f"key {key} is a floating-point number: ids have been lost in a merge")
    bad = df.groupBy(key).agg(F.count("*").alias("n")).where(F.col(key).isNull() | (F.col("n") > 1)).limit(1).collect()
    if bad:
        raise CatalogError(f"key {key} isn't unique: {bad[0][0]!r} occurs {bad[0].n} times")
    return df


def layered(layers: list[DataFrame], key: str) -> DataFrame:
    """Layers with equal key sets side by side; of a column that several have, the last layer's wins, nulls included."""
    def put(base: DataFrame, layer: DataFrame) -> DataFrame:
        if not base.select(key).exceptAll(layer.select(key)).isEmpty() or not layer.select(key).exceptAll(base.select(key)).isEmpty():
            raise CatalogError(f"layers differ in their {key}")
        return base.drop(*[c for c in layer.columns if c != key]).join(layer, key)

    return reduce(put, layers)


def override(base: DataFrame, private: DataFrame, key: str, columns: list[str], subset: DataFrame) -> DataFrame:
    """Columns of the keys in `subset` come from private, 0 where it lacks the key; others keep base's, 0 for null."""
    p = private.select(F.col(key).alias("_p"), *[F.col(c).alias(f"_p_{c}") for c in columns])
    s = subset.select(F.col(key).alias("_s"))
    out = base.join(p, F.col(key) == F.col("_p"), "left").join(s, F.col(key) == F.col("_s"), "left")
    picked = {c: F.when(F.col("_s").isNotNull(), F.coalesce(f"_p_{c}", F.lit(0))).otherwise(F.coalesce(c, F.lit(0))) for c in columns}
    return out.withColumns(picked).select(*base.columns)


class Catalog:
    def __init__(self, spark: SparkSession, root: str, read_only: bool = False) -> None:
        self.spark, self.root, self.read_only = spark, root.rstrip("/"), read_only
        self._seen: dict[str, DataFrame] = {}

    def source(self, namespace: str) -> Catalog:
        """Another namespace beside this one, for reading."""
        return Catalog(self.spark, f"{self.root.rsplit('/', 1)[0]}/{namespace}", read_only=True)

    def path(self, kind: str, name: str) -> str:
        return f"{self.root}/{kind}/{name}"

    def _guard(self) -> None:
        if self.read_only:
            raise CatalogError("another namespace can only be read")

    def read(self, kind: str, name: str) -> DataFrame:
        """The table's frame; one plan for each path, so repeated scans can be shared."""
        at = self.path(kind, name)
        if at not in self._seen:
            self._seen[at] = self.spark.read.parquet(at)
        return self._seen[at]

    def write(self, df: DataFrame, kind: str, name: str, partition: str | None = None) -> None:
        self._guard()
        w = df.write.mode("overwrite")
        (w.partitionBy(partition) if partition else w).parquet(self.path(kind, name))
        self._seen.pop(self.path(kind, name), None)

    def write_properties(self, df: DataFrame, unit: str, name: str, key: str | None = None) -> None:
        self.write(check_key(df, key or KEYS.get(unit, df.columns[0])), f"properties/{unit}", name)

    def read_properties(self, unit: str, *names: str) -> DataFrame:
        key = KEYS.get(unit)
        layers = [self.read(f"properties/{unit}", n) for n in names]
        return layered(layers, key or layers[0].columns[0])

    def write_network(self, nodes: DataFrame, edges: DataFrame, name: str) -> None:
        self.write(check_key(nodes, "node_id"), "networks", f"{name}/nodes")
        self.write(check_key(edges, "edge_id"), "networks", f"{name}/edges")

    def read_network(self, name: str) -> tuple[DataFrame, DataFrame]:
        return self.read("networks", f"{name}/nodes"), self.read("networks", f"{name}/edges")

    def write_od(self, tiers: dict[str, DataFrame], name: str) -> None:
        """tiers: tier -> (orig_id, dest_id, value).  A tier that is left out is none, not an empty one; one is needed at least."""
        if not tiers or set(tiers) - set(TIERS):
            raise CatalogError(f"a matrix needs at least one tier of {TIERS}")
        parts = [df.select(F.lit(t).alias("tier"), "orig_id", "dest_id", F.col("value").cast("float").alias("value")) for t, df in tiers.items()]
        long = reduce(DataFrame.unionByName, parts)
        if long.isEmpty():
            raise CatalogError("a matrix without any pair isn't written")
        self.write(long, "od", name, "tier")

    def read_od(self, name: str, tier: str | None = None) -> DataFrame | None:
        df = self.read("od", name).select("tier", "orig_id", "dest_id", "value")
        if tier is None:
            return df
        part = df.where(F.col("tier") == tier)
        return None if part.isEmpty() else part

    def check_od_nodes(self, name: str, nodes: DataFrame, destinations: bool = False) -> None:
        """Every origin, and on request every destination, must be a node."""
        od, known = self.read_od(name), nodes.select(F.col("node_id").alias("_n"))
        for column in ["orig_id", *(["dest_id"] if destinations else [])]:
            lost = od.select(column).distinct().join(known, F.col(column) == F.col("_n"), "left_anti").limit(1).collect()
            if lost:
                raise CatalogError(f"{column} {lost[0][0]} isn't in the network")

    def write_coefs(self, df: DataFrame, name: str, kind: str) -> None:
        if kind not in ("calibrated", "transferred"):
            raise CatalogError("coefficients are written as calibrated or transferred; manual ones are placed by hand")
        value = F.round("value", 4)
        self.write(df.withColumn("value", value).coalesce(1), f"coefs/{kind}", name)

    def read_coefs(self, name: str, kind: str) -> DataFrame:
        if kind not in KINDS:
            raise CatalogError(f"unknown kind {kind!r}")
        return self.read(f"coefs/{kind}", name)


def parse_coefs(text: str) -> list[tuple[str, str, str, float | None]]:
    """(param, profile, stat, value) of a wide coefficient table; its header has two rows if the second row's first value isn't a number."""
    rows = [r for r in csv.reader(io.StringIO(text)) if r]
    head = rows[0]

    def number(x: str) -> float | None:
        try:
            return float(x)
        except ValueError:
            return None

    two = len(rows) > 1 and len(rows[1]) > 1 and rows[1][1] != "" and number(rows[1][1]) is None
    stats = rows[1] if two else ["", *["coef"] * (len(head) - 1)]
    out, profile = [], ""
    names = []
    for h in head[1:]:
        profile = h or profile
        names.append(profile)
    for r in rows[2 if two else 1 :]:
        out += [(r[0], p, s, number(v)) for p, s, v in zip(names, stats[1:], r[1:], strict=False)]
    return out


def parse_result_name(name: str, metrics: tuple[str, ...] = ("counts", "nearest_k", "gravity")) -> tuple[str, str, str | None] | None:
    """(grid, metric, profile) of cells_access_<grid>_<metric>[_<profile>], by the last metric name in it."""
    stem = name.removeprefix("cells_access_")
    if stem == name:
        return None
    found = [(stem.rfind(f"_{m}"), m) for m in metrics if f"_{m}" in stem]
    if not found:
        return None
    at, metric = max(found)
    return stem[:at], metric, stem[at + len(metric) + 2 :] or None
