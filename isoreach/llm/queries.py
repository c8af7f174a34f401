"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from isoreach.llm.passages import repeated_passages

    return repeated_passages(spark, _table(spark, sf_dir, "documents"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from isoreach.llm.licenses import scan

    return scan(_table(spark, sf_dir, "documents")).drop("detections")


def op3_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from isoreach.llm.resampling import resample

    return resample(spark, _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op4_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    from isoreach.llm.cascade import judge

    return judge(spark, _table(spark, sf_dir, "documents")).drop("rejected_by")


def op5_masked_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    from isoreach.llm.maskedlm import pseudo_likelihood

    return pseudo_likelihood(spark, _table(spark, sf_dir, "documents"))


def op6_site_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from isoreach.llm.sitelines import drop_boilerplate

    return drop_boilerplate(spark, _table(spark, sf_dir, "documents")).select("doc_id", "source", "text", "n_lines", "n_dropped")


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from isoreach.llm.packing import pack

    return pack(spark, _table(spark, sf_dir, "documents"))


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from isoreach.llm.mixing import mix

    mixed = mix(spark, _table(spark, sf_dir, "documents"))
    return mixed.selectExpr("doc_id", "mix_domain as domain", "mix_lang as lang", "mix_source as source", "mix_tokens as n_tokens", "mix_epoch as epoch")


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from isoreach.llm.supermin import near_duplicates

    return near_duplicates(spark, _table(spark, sf_dir, "documents"))


def op10_itq_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from isoreach.llm.itq import similar_vectors

    return similar_vectors(spark, _table(spark, sf_dir, "embeddings"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = (op1_substring_dedup, op2_license_scan, op3_importance_resampling, op4_quality_cascade, op5_masked_lm, op6_site_line_dedup, op7_best_fit_packing, op8_source_mixing, op9_minhash_near_dedup, op10_itq_near_dedup, pipeline)


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in QUERIES}


def oracle_sql() -> dict[str, str]:
    from isoreach.llm import cascade, licenses, mixing, sitelines

    return {"op2_license_scan": licenses.sql(), "op4_quality_cascade": cascade.base_sql(), "op6_site_line_dedup": sitelines.sql(), "op8_source_mixing": mixing.sql()}
