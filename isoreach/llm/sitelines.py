"""Line dedup by site-relative frequency.

For every host the pages that contain a line are divided by the host's pages;
a line above the boilerplate ratio goes from all the host's pages.  A page
counts a line once, so counting needs (host, line hash) pairs only, which are
combined before the shuffle; a hot host or line costs one row per map task.
The lines above the ratio are few for each host (a page's mean number of lines,
divided by the ratio, at most), so the pages are joined with one array a host,
and Spark broadcasts that table only if its size allows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isoreach.llm.runtime import stash

#: A line on more than this share of a host's pages, and on at least so many pages, is boilerplate.
RATIO, MIN_PAGES = 0.1, 5


def _has_word(line: Column) -> Column:
    return F.length(F.regexp_replace(line, "[ \t-\r]+", "")) > 0


def boilerplate(spark: SparkSession, pages: DataFrame, ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """pages (host, lines) -> _isoreach_host, _isoreach_drop: the 64-bit hashes of each host's boilerplate lines."""
    totals = pages.groupBy("host").agg(F.count("*").alias("n_pages")).select(F.col("host").alias("thost"), "n_pages")
    hashes = F.array_distinct(F.transform(F.filter("lines", _has_word), lambda x: F.xxhash64(x)))
    seen = pages.select("host", F.explode(hashes).alias("line")).groupBy("host", "line").agg(F.count("*").alias("n")).where(F.col("n") >= min_pages)
    often = seen.join(totals, F.col("host").eqNullSafe(F.col("thost"))).where(F.col("n") > F.lit(ratio) * F.col("n_pages"))
    return stash(spark, often.groupBy(F.col("host").alias("_isoreach_host")).agg(F.collect_list("line").alias("_isoreach_drop")), "boilerplate")


def drop_boilerplate(spark: SparkSession, pages: DataFrame, host: str | Column = "source", text_col: str = "text", ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """Drop from each page the lines that are boilerplate on its host.

    Returns the input's columns with the text rewritten, and n_lines, n_dropped
    (lines before, lines that went); an input's columns of these names are replaced.  Lines end at \\n
    and are compared exactly.  Lines without a word are never counted or
    dropped.  A null host is a host of its own.  A null text stays null and has
    no lines but counts as a page; a text that loses all its lines is empty;
    repeated rows are pages of their own.  An empty table gives an empty result.
    """
    on = F.col(host) if isinstance(host, str) else host
    lines = F.split(F.col(text_col), "\n")
    drop = boilerplate(spark, pages.select(on.alias("host"), lines.alias("lines")), ratio, min_pages)
    lost = F.coalesce("_isoreach_drop", F.array().cast("array<bigint>"))
    kept = F.filter(lines, lambda x: ~(_has_word(x) & F.array_contains(lost, F.xxhash64(x))))
    joined = pages.join(drop, on.eqNullSafe(F.col("_isoreach_host")), "left")
    own = [F.when(F.col("_isoreach_drop").isNull(), F.col(text_col)).otherwise(F.array_join(kept, "\n")).alias(c) if c == text_col else F.col(c) for c in pages.columns if c not in ("n_lines", "n_dropped")]
    n = F.coalesce(F.size(lines), F.lit(0))
    n = F.when(F.col(text_col).isNull(), 0).otherwise(n)
    gone = F.when(F.col(text_col).isNull() | F.col("_isoreach_drop").isNull(), 0).otherwise(F.size(lines) - F.size(kept))
    return joined.select(*own, n.cast("long").alias("n_lines"), gone.cast("long").alias("n_dropped"))


def sql(ratio: float = RATIO, min_pages: int = MIN_PAGES) -> str:
    """DuckDB SQL for doc_id, source, text, n_lines, n_dropped over documents."""
    word = "length(regexp_replace(line, '[ \\x09-\\x0d]+', '', 'g')) > 0"
    return f"""
    with pages as (select row_number() over () as row_id, doc_id, source, text, string_split(text, chr(10)) as lines from documents),
    line_rows as (select row_id, source, unnest(lines) as line, unnest(range(len(lines))) as pos from pages),
    totals as (select source, count(*) as n_pages from pages group by source),
    seen as (select source, line, count(distinct row_id) as n from line_rows where {word} group by source, line),
    gone as (select seen.source, line from seen join totals on seen.source is not distinct from totals.source where n >= {min_pages} and n > {ratio}::double * n_pages),
    kept as (
      select l.row_id, count(*) as n_lines, count(g.line) as n_dropped,
        coalesce(string_agg(l.line, chr(10) order by l.pos) filter (where g.line is null), '') as text
      from line_rows l left join gone g on l.source is not distinct from g.source and l.line = g.line group by l.row_id)
    select p.doc_id, p.source, case when p.text is null then null else coalesce(k.text, p.text) end as text,
      coalesce(k.n_lines, 0)::bigint as n_lines, coalesce(k.n_dropped, 0)::bigint as n_dropped
    from pages p left join kept k on p.row_id = k.row_id"""
