"""The corpus pipeline: five stages from documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written as
Parquet and read again as the next one's docs.  All but the last return the
columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isoreach.llm import mixing, packing, resampling, sitelines, supermin
from isoreach.llm.runtime import stash


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality classifier draws; the others go."""
    return resampling.keep_good(spark, docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def lines_of_their_own(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their source's boilerplate lines; n_chars follows the text.  Every document stays."""
    cleaned = sitelines.drop_boilerplate(spark, docs)
    length = F.when(F.col("n_dropped") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return cleaned.withColumn("n_chars", length).select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one of the smallest id.

    Only ids that go are joined back, against the ids as they are kept; of rows
    that repeat an id all stay or all go.
    """
    judged = supermin.near_duplicates(spark, docs)
    gone = stash(spark, judged.where(~F.col("kept")).select(F.col("doc_id").alias("gone_id")).distinct(), "gone")
    return docs.join(gone, docs.doc_id == gone.gone_id, "left_anti")


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn, some of them for several epochs, so that the sources meet their target weights."""
    return mixing.mix(spark, docs).select(*docs.columns)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents, each with its sequence and its offset there."""
    return packing.pack(spark, docs)


STAGES = [
    ("quality classifier", good_documents),
    ("line dedup", lines_of_their_own),
    ("MinHash near-dedup", one_of_each_group),
    ("mixing to target weights", mixed_sources),
    ("packing", packed_sequences),
]

#: The classifier's hashed n-gram sums and the tokenizer have no form in SQL; a brute-force version tests the run instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; each stage's rows are stored before the next one starts."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stash(spark, docs, f"stage{k}")
    return docs
