"""Connected components as joins and combinable aggregates; nothing is collected.

Each round hooks every node to its smallest smaller neighbour, flattens the
resulting forest by pointer jumping, and contracts the edges to the roots.  The
joins read stored tables, so Spark may split a hub's partition; the minima are
combined before the shuffle, so a hub costs one row per map task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isoreach.llm.runtime import release, stash


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """edges (a, b) of any order, repeated or looping -> (node, component), component the smallest id.

    Only nodes whose component is another node are returned; null ends are ignored.
    """
    edges = edges.where("a is not null and b is not null and a <> b")
    edges = stash(spark, edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    roots = stash(spark, edges.select(F.col("a").alias("node"), F.col("a").alias("component")).limit(0), "roots")
    while not edges.isEmpty():
        hooks = stash(spark, edges.groupBy("b").agg(F.min("a").alias("p")), "hooks")
        while True:
            up = hooks.select(F.col("b").alias("via"), F.col("p").alias("pp"))
            jumped = hooks.join(up, hooks.p == up.via, "left").select("b", F.coalesce("pp", "p").alias("p"), F.col("pp").isNotNull().alias("moved"))
            jumped = stash(spark, jumped, "jumped")
            moved = not jumped.where("moved").isEmpty()
            release(spark, hooks)
            hooks = jumped
            if not moved:
                break
        to = hooks.select(F.col("b").alias("was"), F.col("p").alias("now"))
        old = roots.join(to, roots.component == to.was, "left").select("node", F.coalesce("now", "component").alias("component"))
        joined = stash(spark, old.unionByName(to.select(F.col("was").alias("node"), F.col("now").alias("component"))), "roots")
        left = edges.join(to, edges.a == to.was, "left").select(F.coalesce("now", "a").alias("a"), "b")
        both = left.join(to, left.b == to.was, "left").select("a", F.coalesce("now", "b").alias("b"))
        contracted = both.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        contracted = stash(spark, contracted, "edges")
        release(spark, edges, roots, hooks)
        edges, roots = contracted, joined
    return roots
