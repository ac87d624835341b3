"""The corpus pipeline: stages over documents, each written as Parquet and read again by the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tallyloom.llm import exact, jaccard, mixing, packing, toxicity
from tallyloom.llm.common import bounded_batches, stage_table

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def toxic_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression model scores as toxic go; it learns from the labelled ones among ``docs``."""
    return toxicity.keep_clean(docs, bounded_batches(spark).read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts the one with the smallest id stays."""
    bounded_batches(spark)
    return exact.keep_one(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links of five-word shingles at 0.75 connect, the one with the smallest id stays."""
    bounded_batches(spark)
    return jaccard.keep_representatives(docs)


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; the one at a source's cut is shortened the last time."""
    return mixing.mixed_documents(docs, chars_col="n_chars")


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, each with its place in a sequence of 4096 tokens."""
    bounded_batches(spark)
    return packing.pack_documents(docs, TOKENIZER, 4096)


STAGES = [("toxicity", toxic_filter), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("mixing", mixing_sources), ("packing", best_fit_packing)]

# A tokenizer and learned scores are beyond SQL; the stages are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stage_table(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
