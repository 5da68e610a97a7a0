"""The registered queries of this package: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import collocations, conversations, decontaminate, langid, lm, minmax, ngram_join, packing, pii, quality, substring_dedup, toxicity, weak_quality
from .sql import ORACLES


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(_documents(spark, sf_dir))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(spark, _documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(_documents(spark, sf_dir))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(spark, _documents(spark, sf_dir))


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.lm_scores(spark, _documents(spark, sf_dir))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weak_quality.classify(_documents(spark, sf_dir))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(spark, _documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_documents(spark, sf_dir))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(spark, _documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op11_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minmax.near_duplicates(spark, _documents(spark, sf_dir))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(spark, _documents(spark, sf_dir))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.audit(spark, conversations.damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v for k, v in globals().items() if k.startswith("op")}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
