"""Documents to packed training sequences.

Stages, in order: quality rules (rejected documents and boilerplate lines go), exact dedup (one of equal texts stays), n-gram Jaccard join (one document of each
near-duplicate component stays), mixing of sources (documents are repeated or left out), packing. Each takes (spark, docs, sf_dir) and
returns a DataFrame that is written and read again as the next one's docs.

Nulls and repeats: a null text counts as empty in all stages, and documents without words fail the first; a null source is a source of its own; a null doc_id
stays null and ranks below any other where copies compete. Repeated rows are rows of their own in quality rules, mixing and packing, and copies of one another in both
dedup stages. Texts are taken whole at any length, other columns are handed on as they are (n_chars follows a changed text), and no documents give no rows.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from matchloom.llm import exact_dedup, mixing, ngram_join, packing, quality_rules
from matchloom.llm.shared import drop_paths, noted, stored


def by_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.accepted(docs)


def by_exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.keep_one(docs)


def by_ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_leads(docs)


def by_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.repeated(docs)


def by_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed(docs, public_tokenizers.path("word_bpe_49k.json"), 4096, whole=False).drop("uid", "ids")


STAGES = [
    ("quality_rules", by_quality_rules),
    ("exact_dedup", by_exact_dedup),
    ("ngram_jaccard_join", by_ngram_join),
    ("mixing", by_mixing),
    ("packing", by_packing),
]

#: Packing needs a tokenizer, which SQL does not have; tests/llm/test_pipeline.py holds the rows against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces. Of the stages' intermediate tables those are deleted that nothing reads any more: all of a stage but its result, and that once the next stage
    is done."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in STAGES[:-1]:
        with noted() as made:
            docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
        drop_paths(spark, before + made[:-1])
        before = made[-1:]
    return STAGES[-1][1](spark, docs, sf_dir)
