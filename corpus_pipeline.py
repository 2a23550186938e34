"""A corpus from raw documents to packed sequences, one operator a stage.

Each stage reads what the one before has written to the shared folder, so a lost executor costs one stage's
work at most. All stages but the last hand on the columns of ``documents``, whatever these are.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.llm import compression_quality, config_packing, hyperminhash, leak_align, line_winnow
from salesmart.llm.queries import find_package
from salesmart.session import settle

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return compression_quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without runs of 50 words or more that occurred before; those of which nothing is left go."""
    left = line_winnow.drop_repeated_runs(docs, drop_emptied=True)
    if "n_chars" not in left.columns:
        return left
    return left.withColumn("n_chars", F.length("text").cast(left.schema["n_chars"].dataType))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, similarity 0.8 or more)."""
    return hyperminhash.keep_one(docs, hyperminhash.Settings(shingle=5, percent=80))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, whole or edited."""
    return leak_align.drop_leaking(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their ids (little-endian, 32 bits each) and their places in sequences of 4096."""
    return config_packing.pack_documents(docs, VOCABULARY, ids=True)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("pack", pack),
]

#: Compression, alignment and packing have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; returns the last one's rows."""
    find_package(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), name)
    return docs
