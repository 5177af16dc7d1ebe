"""From raw documents to packed training sequences: five stages, each on all that the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from scorewatch.llm import jaccard_join, packing, quality, suffix_dedup, toxicity
from scorewatch.llm.common import pin


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.keep(docs, _labels(spark, sf_dir))


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic."""
    return toxicity.drop_toxic(docs, _labels(spark, sf_dir))


def near_duplicate_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near duplicates."""
    return jaccard_join.keep_first(docs)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the strings that an earlier document has."""
    return suffix_dedup.without_repeats(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return packing.pack_documents(docs, ranks, public_tokenizers.PATTERN, {"<|endoftext|>": 50256})


STAGES = [
    ("quality_rules", quality_rules),
    ("toxicity", toxicity_filter),
    ("ngram_jaccard_join", near_duplicate_filter),
    ("suffix_array_dedup", repeated_strings),
    ("packing", pack),
]

#: The learned scores of the first stages cannot be written in SQL; tests run it on empty tables only.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``; each stage's output is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = pin(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
