"""Quality classifier by importance resampling of hashed n-grams.

Two generative models over hashed n-gram buckets are counted: one of target
text (documents labelled good, a bounded sample), one of all raw text.  A
document's log weight is the log ratio of its probabilities under the two, the
sum over its n-grams.  A token that repeats the one before it is read as a mark
of repetition, so that repeats of any word are one n-gram.  Documents are then drawn without replacement with odds in proportion to their
weights, by the Gumbel top-k trick: each log weight gets seeded Gumbel noise and
the k largest sums are taken.  k is the number of documents beyond the log weight
that best separates bounded samples of good documents that the target model
hasn't seen and of bad ones.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isoreach.llm.runtime import release, ship, stash
from isoreach.llm.textcore import U64, batches, mix, raw, word_hashes

BUCKETS = 1 << 14
#: Labelled good documents that the target model is counted on, and of either label that k is set by, those of the smallest id hashes.
TARGET_ROWS = 20_000
SEED = 29
#: Log weight of a text without n-grams, which the target model never writes.
NOTHING = -1e6
_TOKEN = re.compile(rb"[a-z0-9\x80-\xff]+|[^\sa-z0-9\x80-\xff]+")
#: Hash of the mark of repetition.
_AGAIN = U64(0x5851F42D4C957F2D)


def ngrams(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all unigrams and bigrams of the texts, and each text's number of n-grams; a text's come together."""
    tokens = [_TOKEN.findall(t.lower()) if t else [] for t in texts]
    sizes = np.array([len(t) for t in tokens], dtype=np.int64)
    out, counts = [], np.maximum(2 * sizes - 1, 0)
    for t in tokens:
        if not t:
            continue
        h = word_hashes(t)
        h[1:][h[1:] == h[:-1]] = _AGAIN
        one = mix(h) % U64(BUCKETS)
        two = mix(h[:-1] * U64(0x9E3779B97F4A7C15) + h[1:]) % U64(BUCKETS)
        out += [one, two]
    return (np.concatenate(out).astype(np.int64) if out else np.empty(0, dtype=np.int64)), counts


def _count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals = np.zeros((2, BUCKETS), dtype=np.int64)
    for b in batches(it):
        texts, good = raw(b.column(1)), b.column(2).to_pylist()
        grams, counts = ngrams(texts)
        totals[0] += np.bincount(grams, minlength=BUCKETS)
        target = np.repeat(np.array(good, dtype=bool), counts)
        totals[1] += np.bincount(grams[target], minlength=BUCKETS)
    kind, bucket = np.nonzero(totals)
    yield pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array(bucket, pa.int32()), pa.array(totals[kind, bucket])], names=["kind", "bucket", "n"])


def log_ratio(raw_counts: np.ndarray, target_counts: np.ndarray) -> np.ndarray:
    """log p(bucket | target) / p(bucket | raw), with one added to each target count in the raw model's proportions."""
    p = (raw_counts + 1.0) / (raw_counts.sum() + len(raw_counts))
    q = (target_counts + len(raw_counts) * p) / (target_counts.sum() + len(raw_counts))
    return np.log(q / p)


def gumbel(ids: list[int | None], seed: int) -> np.ndarray:
    """Gumbel noise fixed by the id and the seed; a null id has the noise of -1."""
    x = np.array([-1 if i is None else i for i in ids], dtype=np.int64).view(U64)
    u = ((mix(mix(x) ^ U64(seed)) >> U64(11)).astype(np.float64) + 0.5) / 2.0**53
    return -np.log(-np.log(u))


def weigh(ids: list[int | None], texts: list[bytes | None], ratio: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(n-grams, log weight, log weight plus noise) of each text; a text without n-grams has NOTHING."""
    grams, counts = ngrams(texts)
    weight, some = np.full(len(counts), NOTHING), counts > 0
    if some.any():  # each text is summed by itself, so its weight doesn't depend on its batch
        weight[some] = np.round(np.add.reduceat(ratio[grams], (np.cumsum(counts) - counts)[some]), 6)
    return counts, weight, weight + gumbel(ids, seed)


def _score(ratio: np.ndarray, seed: int):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(it):
            counts, weight, key = weigh(b.column(0).to_pylist(), raw(b.column(1)), ratio, seed)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(counts), pa.array(weight), pa.array(key)], names=["doc_id", "n_ngrams", "log_weight", "sample_key"])

    return run


def _labelled(labels: DataFrame, quality: int, half: int | None = None) -> DataFrame:
    """At most TARGET_ROWS ids with the label, of one half of the ids if so asked; the bound lets them be broadcast."""
    ids = labels.where((F.col("quality") == quality) & F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("label_id")).distinct()
    if half is not None:
        ids = ids.where(F.pmod(F.xxhash64("label_id", F.lit(SEED)), F.lit(2)) == half)
    return ids.orderBy(F.xxhash64("label_id"), "label_id").limit(TARGET_ROWS)


def best_cut(good: np.ndarray, bad: np.ndarray) -> float:
    """The weight, midway between two neighbours, with the largest share of good ones above plus bad ones below."""
    if not len(good) or not len(bad):
        return -np.inf
    values = np.unique(np.concatenate([good, bad]))
    cuts = np.concatenate([[values[0] - 1], (values[1:] + values[:-1]) / 2])
    above = 1 - np.searchsorted(np.sort(good), cuts) / len(good)
    below = np.searchsorted(np.sort(bad), cuts) / len(bad)
    total = above + below
    best = np.flatnonzero(total >= total.max() - 1e-12)
    return float(cuts[best[len(best) // 2]])


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> np.ndarray:
    """The log ratio of each bucket, from docs (doc_id, text) and labels (doc_id, quality)."""
    good = _labelled(labels, 1, 0).withColumnRenamed("label_id", "good_id")
    flagged = docs.join(F.broadcast(good), F.col("doc_id") == F.col("good_id"), "left").select("doc_id", "text", F.col("good_id").isNotNull().alias("good"))
    counts = flagged.mapInArrow(_count, "kind int, bucket int, n long").groupBy("kind", "bucket").agg(F.sum("n").alias("n"))
    table = np.zeros((2, BUCKETS))
    for r in counts.collect():  # at most two rows a bucket
        table[r.kind, r.bucket] = r.n
    return log_ratio(table[0], table[1])


def kth_largest(keys: DataFrame, column: str, k: int) -> float:
    """The exact k-th largest value, by counting ever finer bins; at most a few thousand values are fetched."""
    low, high = keys.agg(F.min(column), F.max(column)).first()
    while low < high:
        within = keys.where((F.col(column) >= low) & (F.col(column) <= high))
        width = (high - low) / 512
        bins = within.groupBy(F.least(F.lit(511), F.floor((F.col(column) - F.lit(low)) / F.lit(width))).alias("bin")).agg(F.count("*").alias("n"), F.min(column).alias("lo"), F.max(column).alias("hi"))
        for r in sorted(bins.collect(), key=lambda r: -r.bin):
            if k <= r.n:
                low, high, n = r.lo, r.hi, r.n
                break
            k -= r.n
        if n <= 4096:
            values = sorted((r[0] for r in keys.where((F.col(column) >= low) & (F.col(column) <= high)).select(column).collect()), reverse=True)
            return values[k - 1]
    return low


def _sampled(spark: SparkSession, docs: DataFrame, labels: DataFrame, seed: int) -> tuple[DataFrame, np.ndarray, float]:
    ship(spark)
    ratio = fit(spark, docs, labels)
    scored = stash(spark, docs.mapInArrow(_score(ratio, seed), "doc_id long, n_ngrams long, log_weight double, sample_key double"), "weights")
    seen = [scored.join(F.broadcast(_labelled(labels, q, half)), F.col("doc_id") == F.col("label_id")).select("log_weight").toPandas()["log_weight"].to_numpy() for q, half in ((1, 1), (0, None))]
    k = scored.where(F.col("log_weight") > F.lit(best_cut(*seen))).count()
    return scored, ratio, kth_largest(scored, "sample_key", k) if k else float("inf")


def resample(spark: SparkSession, documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED) -> DataFrame:
    """Weigh all documents and draw those that read like the labelled good ones.

    labels has doc_id and quality (1: good).  Returns a row per input row:
    doc_id, n_ngrams, log_weight, sample_key (with noise), kept.  A null or empty
    text has log weight NOTHING and is never drawn before others.  Equal ids have equal noise and equal keys stand
    or fall together.  Without labels of both kinds everything is kept; without
    documents the result is empty.
    """
    docs = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    scored, _, least = _sampled(spark, docs, labels, seed)
    return scored.withColumn("kept", F.col("sample_key") >= F.lit(least))


def keep_good(spark: SparkSession, documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED) -> DataFrame:
    """The rows of documents that resample() keeps, with all their columns; each text is weighed again where it lies."""
    docs = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    scored, ratio, least = _sampled(spark, docs, labels, seed)
    release(spark, scored)
    at_id, at_text = documents.columns.index(id_col), documents.columns.index(text_col)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(it):
            _, _, key = weigh(b.column(at_id).to_pylist(), raw(b.column(at_text)), ratio, seed)
            yield b.filter(pa.array(key >= least))

    return documents.mapInArrow(run, documents.schema)
