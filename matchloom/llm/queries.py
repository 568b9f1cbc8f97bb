"""Queries of the operators in this folder, and their SQL where there is one."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import archives, exact_dedup, filter_audit, line_dedup, merkle, minhash, mixing, ngram_join, packing, quality_model, quality_rules, secret_scan, sharding
from .oracles import ORACLES  # noqa: F401


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.linked(_table(spark, sf_dir, "documents")).drop("uid", "leads", "text_key")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.packed(_table(spark, sf_dir, "documents"), path, 4096, whole=False).drop("uid", "ids")


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archives.round_trip(_table(spark, sf_dir, "pages"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_dedup.deduplicated(_table(spark, sf_dir, "documents"), with_text=False)
    return rows.withColumn("kept_lines", F.array_join("kept", ",")).drop("kept")


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    return quality_model.judged(docs, labels, F.col("source"), F.col("lang"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(_table(spark, sf_dir, "documents")).drop("uid")


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.shard_rows(_table(spark, sf_dir, "documents"), 8)
    law, none = F.lit("bytes").alias("law"), F.lit(None).cast("int").alias("grown_shard")
    return rows.select("doc_id", "size", "text_crc32", law, "shard", "slot", none)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judged(_table(spark, sf_dir, "documents")).drop("uid", "host", "text_key")


def op9_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scanned(_table(spark, sf_dir, "documents"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(_table(spark, sf_dir, "documents")).drop("uid", "whole", "extra", "source")


def op11_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents")).drop("uid", "text_key")


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audited(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.tampered(_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_ngram_jaccard_join, op2_packing, op3_warc, op4_line_dedup, op5_quality_classifier, op6_exact_dedup, op7_sharding, op8_quality_rules, op9_secret_scans, op10_mixing, op11_minhash_near_dedup, op12_filter_audit, op13_merkle_manifest)}
