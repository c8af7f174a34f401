"""Mixing sources to target weights by hierarchical budgeting.

The token budget runs down a domain - language - source tree.  At each node it
is shared among the children by weight; a child whose subtree can't supply its
share (its tokens times the epochs allowed) gives what it lacks to its siblings
by their weights.  As a subtree's supply is known before its share is fixed, a
shortage is made up within the subtree first, and reaches the parent's siblings
only if the whole subtree lacks tokens.

A leaf with budget b and s tokens gives all documents for b // s epochs, and of
the next epoch the shortest prefix with b % s tokens, in an order seeded by the
epoch.  The prefix's end is found from token sums of 4,096 ranges of the order
key, then inside one range, so that no task sorts a hot source.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isoreach.llm.runtime import stash

#: Target weights of the query and the pipeline, whole numbers; a node that isn't named has weight 10.
WEIGHTS = {"domain0": 30, "domain1": 25, "domain2": 25, "domain3": 20, "en": 50, "de": 20, "fr": 20, "es": 15}
OTHER_WEIGHT = 10
#: The budget as a percentage of all tokens, the most epochs of a leaf, the seed of the orders.
PERCENT, EPOCHS, SEED = 80, 2, 17
LEVELS = ("domain", "lang", "source")


def domain_of(source: Column) -> Column:
    """The domain of a source of the documents table: its number modulo 4."""
    return F.concat(F.lit("domain"), F.pmod(F.coalesce(F.regexp_extract(source, "([0-9]+)", 1).try_cast("long"), F.lit(0)), F.lit(4)))


def _weight(column: str, weights: dict[str, int]) -> str:
    return f"case {column} " + " ".join(f"when '{k}' then {v}" for k, v in weights.items()) + f" else {OTHER_WEIGHT} end"


def budget_sql(leaves: str, weights: dict[str, int], percent: int, epochs: int) -> str:
    """SQL (the same for Spark and DuckDB) from (domain, lang, source, supply) to the budget of each leaf.

    At each level the children are taken by supply per weight: while a child
    can't use its share of what is left it gets all its supply; the others share
    the rest.  All arithmetic is in whole numbers.
    """
    steps = [f"lv0 as (select cast(sum(supply) * {percent} // 100 as bigint) as budget from {leaves})"]
    above, keys = "lv0", []
    for k, level in enumerate(LEVELS, 1):
        old = list(keys)
        keys.append(level)
        cols = ", ".join(keys)
        on = " and ".join(f"c.{x} = p.{x}" for x in old) or "1 = 1"
        part = f"partition by {', '.join(f'c.{x}' for x in old)}" if old else ""
        order = f"order by c.cap / cast(c.w as double), c.{level}"
        before = f"over ({part} {order} rows between unbounded preceding and 1 preceding)"
        steps.append(f"c{k} as (select {cols}, cast(sum(supply) * {epochs} as bigint) as cap, cast({_weight(level, weights)} as bigint) as w from {leaves} group by {cols})")
        steps.append(
            f"r{k} as (select {', '.join(f'c.{x}' for x in keys)}, c.cap, c.w, p.budget - coalesce(sum(c.cap) {before}, 0) as left_b, "
            f"sum(c.w) over ({part}) - coalesce(sum(c.w) {before}, 0) as left_w, row_number() over ({part} {order}) as pos from c{k} c join {above} p on {on})"
        )
        steps.append(f"f{k} as (select *, case when cap * left_w > w * left_b then pos end as open_pos from r{k})")
        first = f"over ({'partition by ' + ', '.join(old) if old else ''})"
        steps.append(f"g{k} as (select *, min(open_pos) {first} as first_open from f{k})")
        # the rest and the weights from the first child on that isn't short
        steps.append(f"h{k} as (select *, max(case when pos = first_open then left_b end) {first} as rest_b, max(case when pos = first_open then left_w end) {first} as rest_w from g{k})")
        steps.append(f"lv{k} as (select {cols}, cast(case when first_open is null or pos < first_open then cap else rest_b * w // rest_w end as bigint) as budget from h{k})")
        above = f"lv{k}"
    return "with " + ",\n".join(steps) + "\nselect domain, lang, source, budget from lv3"


def leaf_budgets(spark: SparkSession, leaves: DataFrame, weights: dict[str, int] | None = None, percent: int = PERCENT, epochs: int = EPOCHS) -> DataFrame:
    """leaves (domain, lang, source, supply) -> domain, lang, source, budget."""
    name = f"isoreach_mix_{uuid.uuid4().hex}"  # a name of its own, so that calls in one session don't meet
    leaves.createTempView(name)
    try:
        return spark.sql(budget_sql(name, weights or WEIGHTS, percent, epochs).replace("//", "div"))
    finally:
        spark.catalog.dropTempView(name)


def _order_key(seed: int, epoch: Column, doc: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), doc.cast("string")))


def mix(
    spark: SparkSession,
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    domain: Column | None = None,
    weights: dict[str, int] | None = None,
    percent: int = PERCENT,
    epochs: int = EPOCHS,
    seed: int = SEED,
) -> DataFrame:
    """Select documents so that the sources' tokens meet the target weights.

    Returns the input's rows, one for each epoch that takes them, with mix_domain,
    mix_lang, mix_source, mix_tokens (words without white space) and mix_epoch.
    A null language or source is the node 'unknown'; a null text has no tokens; a
    leaf without tokens gives nothing.  Columns of the input with these names are
    replaced.  Rows with equal ids, or with null ones, stand or fall together in a
    leaf.  An empty table gives an empty result.
    """
    dom = domain if domain is not None else domain_of(F.col(source_col))
    bare = F.btrim(F.col(text_col), F.lit(" \t\n\x0b\x0c\r"))
    tokens = F.when(F.length(bare) > 0, F.size(F.split(bare, "[ \t-\r]+"))).otherwise(0).cast("long")  # several times as fast as counting matches
    parts = [dom.alias("mix_domain"), F.coalesce(F.col(lang_col).cast("string"), F.lit("unknown")).alias("mix_lang"), F.coalesce(F.col(source_col).cast("string"), F.lit("unknown")).alias("mix_source")]
    slim = stash(spark, documents.select(F.col(id_col).alias("id"), *parts, tokens.alias("mix_tokens")), "mix-tokens")
    supply = slim.groupBy("mix_domain", "mix_lang", "mix_source").agg(F.sum("mix_tokens").alias("supply"))
    supply = stash(spark, supply.select(F.col("mix_domain").alias("domain"), F.col("mix_lang").alias("lang"), F.col("mix_source").alias("source"), "supply").where("supply > 0"), "mix-supply")
    budgets = leaf_budgets(spark, supply, weights, percent, epochs).withColumnsRenamed({"domain": "bd", "lang": "bl", "source": "bs"})
    budgets = budgets.join(supply, (F.col("bd") == F.col("domain")) & (F.col("bl") == F.col("lang")) & (F.col("bs") == F.col("source"))).drop("domain", "lang", "source")
    budgets = stash(spark, budgets.selectExpr("bd", "bl", "bs", "cast(budget div supply as int) as full", "budget % supply as rest"), "mix-budgets")
    leaf = ["bd", "bl", "bs"]

    def on_leaf(df: DataFrame, side: DataFrame) -> DataFrame:
        return df.join(side, (F.col("mix_domain") == F.col("bd")) & (F.col("mix_lang") == F.col("bl")) & (F.col("mix_source") == F.col("bs")))

    keyed = on_leaf(slim, budgets.where("rest > 0")).select(*leaf, "rest", "mix_tokens", _order_key(seed, F.col("full"), F.col("id")).alias("key"))
    keyed = keyed.withColumn("range", F.substring("key", 1, 3))
    ranges = keyed.groupBy(*leaf, "range", "rest").agg(F.sum("mix_tokens").alias("n"))
    running = "sum(n) over (partition by bd, bl, bs order by {0} rows between unbounded preceding and 1 preceding)"
    ends = ranges.withColumn("before", F.coalesce(F.expr(running.format("range")), F.lit(0))).where("before < rest")
    ends = ends.groupBy(*leaf, "rest").agg(F.max(F.struct("range", "before")).alias("e")).select(F.col("bd").alias("ed"), F.col("bl").alias("el"), F.col("bs").alias("es"), F.col("e.range").alias("er"), F.col("e.before").alias("ebefore"))
    ends = stash(spark, ends, "mix-ranges")
    inside = keyed.join(ends, (F.col("bd") == F.col("ed")) & (F.col("bl") == F.col("el")) & (F.col("bs") == F.col("es")) & (F.col("range") == F.col("er")))
    inside = inside.groupBy(*leaf, "rest", "ebefore", "key").agg(F.sum("mix_tokens").alias("n"))
    last = inside.withColumn("before", F.col("ebefore") + F.coalesce(F.expr(running.format("key")), F.lit(0))).where("before < rest")
    last = last.groupBy(*leaf).agg(F.max("key").alias("cut")).select(F.col("bd").alias("ld"), F.col("bl").alias("ll"), F.col("bs").alias("ls"), "cut")
    plan = budgets.join(last, (F.col("bd") == F.col("ld")) & (F.col("bl") == F.col("ll")) & (F.col("bs") == F.col("ls")), "left").select(*leaf, "full", "cut")
    plan = stash(spark, plan.where("full > 0 or cut is not null"), "mix-plan")

    own = {"domain": "bd", "lang": "bl", "source": "bs", "full": "full", "cut": "cut"}
    plan = plan.select(*[F.col(c).alias(f"_isoreach_{k}") for k, c in own.items()])  # names that a table's own columns don't have
    full = documents.drop("mix_domain", "mix_lang", "mix_source", "mix_tokens", "mix_epoch").select("*", *parts, tokens.alias("mix_tokens"))
    chosen = full.join(plan, (F.col("mix_domain") == F.col("_isoreach_domain")) & (F.col("mix_lang") == F.col("_isoreach_lang")) & (F.col("mix_source") == F.col("_isoreach_source")))
    last = F.col("_isoreach_full")
    takes = last + F.coalesce(_order_key(seed, last, F.col(id_col)) <= F.col("_isoreach_cut"), F.lit(False)).cast("int")
    chosen = chosen.withColumn("_isoreach_takes", takes).where("_isoreach_takes > 0")
    chosen = chosen.withColumn("mix_epoch", F.explode(F.sequence(F.lit(0), F.col("_isoreach_takes") - 1)))
    return chosen.drop(*plan.columns, "_isoreach_takes")


def sql(weights: dict[str, int] | None = None, percent: int = PERCENT, epochs: int = EPOCHS, seed: int = SEED) -> str:
    """DuckDB SQL for doc_id, domain, lang, source, n_tokens, epoch over documents."""
    budgets = budget_sql("supply_t", weights or WEIGHTS, percent, epochs)
    return f"""
    with slim as (
      select doc_id, 'domain' || (coalesce(try_cast(regexp_extract(source, '([0-9]+)', 1) as bigint), 0) % 4) as domain,
        coalesce(lang, 'unknown') as lang, coalesce(source, 'unknown') as source,
        coalesce(len(regexp_extract_all(text, '[^ \\x09-\\x0d]+')), 0)::bigint as n_tokens
      from documents),
    supply_t as (select domain, lang, source, sum(n_tokens)::bigint as supply from slim group by 1, 2, 3 having sum(n_tokens) > 0),
    budgets as ({budgets}),
    plan as (select b.*, s.supply, b.budget // s.supply as full_epochs, b.budget % s.supply as rest from budgets b join supply_t s using (domain, lang, source)),
    keyed as (select slim.*, full_epochs, rest, md5(concat_ws(':', '{seed}', full_epochs::varchar, doc_id::varchar)) as ord from slim join plan using (domain, lang, source)),
    per_key as (select domain, lang, source, rest, ord, sum(n_tokens) as n from keyed group by all),
    prefix as (select *, coalesce(sum(n) over (partition by domain, lang, source order by ord rows between unbounded preceding and 1 preceding), 0) as before from per_key),
    cuts as (select domain, lang, source, max(ord) as cut from prefix where before < rest group by all),
    takes as (select keyed.*, full_epochs + (case when cut is not null and ord <= cut then 1 else 0 end) as n_takes from keyed left join cuts using (domain, lang, source))
    select doc_id, domain, lang, source, n_tokens, unnest(range(n_takes))::int as epoch from takes"""
