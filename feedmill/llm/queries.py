"""Queries of the text-corpus operators on the given tables, and SQL for those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    embedding_neardup, hard_negatives, language_id, license_scan, line_dedup, merkle, mixing, packing, quality_classifier, quality_rules,
    simhash_neardup, token_output, winnowing,
)
from .oracle_sql import SQL


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(_table(spark, sf_dir, "documents"))


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(_table(spark, sf_dir, "documents"))


def op3_embedding_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_neardup.embedding_groups(_table(spark, sf_dir, "embeddings"))


def op4_simhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash_neardup.simhash_groups(_table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(_table(spark, sf_dir, "documents"))


def op7_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output.token_files(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify_languages(_table(spark, sf_dir, "documents"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.classify_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_report(_table(spark, sf_dir, "documents"), min_words=1)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings")
    rows = rows.withColumn("label", F.expr("CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END"))
    return hard_negatives.hard_negatives(rows, F.expr("vec_id % 100 = 0"))


def op12_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = winnowing.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["words"])
    items = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    return found.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), items.alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    more = F.when(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)) == 0, 1).otherwise(0)
    tampered = merkle.digest_of("doc_id", "source", "lang", F.col("n_chars") + more, "text")
    found = merkle.merkle_manifest(_table(spark, sf_dir, "documents"), carry={"claimed": tampered})
    found = found.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest().alias("proof_sha256"), merkle.folded("claimed").alias("folded_root"))
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality_rules, op2_source_mixing, op3_embedding_neardup, op4_simhash_neardup, op5_best_fit_packing, op6_license_scan,
        op7_token_output, op8_language_id, op9_quality_classifier, op10_line_dedup, op11_hard_negatives, op12_benchmark_decontamination,
        op13_merkle_manifest, pipeline,
    )
}
