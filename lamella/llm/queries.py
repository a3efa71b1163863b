"""Thin queries over the operators of this subpackage, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import language_id, minhash, mixing, order_minhash, packing, paragraphs, quality_classifier, quality_rules, surrogates, warc
from .common import table


def op1_paragraph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraphs.repeats(table(spark, sf_dir, "documents"))


def op2_crf_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2
    return language_id.languages(table(spark, sf_dir, "documents"), held_out)


def op3_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.fingerprints(table(spark, sf_dir, "documents"))


def op4_warc_index_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.round_trip(table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_surrogate_generation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogates.anonymised(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"))


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(table(spark, sf_dir, "documents"), k=4, percent=80)
    return found.withColumnRenamed("id", "doc_id")


def op9_weighted_fair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents")).drop("source")


def op8_perplexity_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def queries() -> dict:
    return {f.__name__: f for f in (op1_paragraph_dedup, op2_crf_language_id, op3_order_minhash, op4_warc_index_merge, op5_surrogate_generation, op6_best_fit_packing, op7_minhash_near_dedup, op8_perplexity_rules, op9_weighted_fair_mix, op10_quality_classifier)}


def oracle_sql() -> dict[str, str]:
    return {"op4_warc_index_merge": warc.SQL, "op9_weighted_fair_mix": mixing.SQL}
