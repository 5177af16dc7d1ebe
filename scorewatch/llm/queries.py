"""Registered queries of the text operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from scorewatch.llm import (
    bilinear_lm,
    bpe,
    extraction,
    jaccard_join,
    langid,
    packing,
    quality,
    resampling,
    simhash,
    spelling,
    suffix_dedup,
    target_resampling,
    toxicity,
)

BYTE_BPE = "byte_bpe_50k.tiktoken"
WORD_BPE = "word_bpe_49k.json"
END_OF_TEXT = {"<|endoftext|>": 50256}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract(_table(spark, sf_dir, "pages"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedupe_bytes(_table(spark, sf_dir, "documents"))


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(_table(spark, sf_dir, "documents"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.with_near(simhash.fingerprint_documents(_table(spark, sf_dir, "documents")))


def op5_simhash_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_documents(_table(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return packing.pack_documents(docs, public_tokenizers.path(BYTE_BPE), public_tokenizers.PATTERN, END_OF_TEXT)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_quality_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_table(spark, sf_dir, "documents"))


def op11_bilinear_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bilinear_lm.score(_table(spark, sf_dir, "documents"))


def op12_target_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return target_resampling.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_html_extraction,
        op2_quality_rules,
        op3_suffix_dedup,
        op4_ngram_jaccard_join,
        op5_simhash,
        op5_simhash_pairs,
        op6_packing,
        op7_toxicity,
        op8_quality_resampling,
        op9_bpe,
        op10_language_id,
        op11_bilinear_lm,
        op12_target_resampling,
        op13_spelling_variants,
    )
} | {"pipeline": corpus_pipeline.run}
