"""The domain's objects over the test tables, by expressions that Spark and DuckDB share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

#: object -> (table, expressions)
OBJECTS = {
    "cells": ("customer", ["c_custkey as cell_id", "c_nationkey as zone_id", "cast((c_custkey * 37) % 1000 as double) as x", "cast((c_custkey * 91) % 1000 as double) as y", "greatest(c_acctbal, cast(0 as double)) as population", "c_mktsegment as segment"]),
    "dests": ("supplier", ["s_suppkey as dest_id", "s_nationkey as dest_zone", "cast((s_suppkey * 53) % 1000 as double) as dx", "cast((s_suppkey * 71) % 1000 as double) as dy", "greatest(s_acctbal, cast(0 as double)) as weight", "s_suppkey % 3 as category"]),
    "zones": ("nation", ["n_nationkey as zone_id", "n_regionkey as region_id", "cast((n_nationkey * 137) % 1000 as double) as x", "cast((n_nationkey * 251) % 1000 as double) as y"]),
    "buildings": ("part", ["p_partkey as building_id", "p_type as tag", "p_brand as brand", "cast((p_partkey * 29) % 1000 as double) as x0", "cast((p_partkey * 83) % 1000 as double) as y0", "cast((p_partkey * 29) % 1000 + p_size as double) as x1", "cast((p_partkey * 83) % 1000 + p_size as double) as y1", "cast(p_size * p_size as double) as area"]),
    "edges": ("orders", ["o_orderkey as way_id", "o_custkey % 97 as u", "(o_custkey * 7 + o_orderkey) % 97 as v", "o_totalprice / 1000 as length", "o_orderpriority as priority", "o_orderkey % 8 as rank"]),
    "matrix": ("lineitem", ["l_suppkey % 25 as orig_id", "l_partkey % 25 as dest_id", "l_quantity as value"]),
    "events": ("events", ["event_id", "ts", "user_id", "event_type", "value"]),
    "legs": ("conversations", ["conv_id as trip_id", "turn", "role", "cast(length(text) as double) as dist"]),
    "docs": ("documents", ["doc_id", "lang", "source", "n_chars"]),
}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    table, exprs = OBJECTS[name]
    return spark.read.parquet(f"{sf_dir}/{table}.parquet").selectExpr(*exprs)


def ctes(*names: str) -> str:
    return "with " + ", ".join(f"{n}_ as (select {', '.join(OBJECTS[n][1])} from {OBJECTS[n][0]})" for n in names)


#: name -> (callable, SQL or None)
REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def query(name: str, sql: str | None = None):
    def put(f):
        REGISTRY[name] = (f, sql)
        return f

    return put
