"""The corpus pipeline: documents pass one stage after another, each written and read again.

Quality rules reject documents; of near copies (word 5-grams, Jaccard 0.8) the first stays; passages
that repeat an earlier document are cut out of the later ones; documents that hold a benchmark
passage go; the rest is encoded to piece ids, which are decoded again as a check.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starling.llm.common import saved
from starling.llm.decontaminate import clean_documents
from starling.llm.jaccard import one_per_group
from starling.llm.quality import kept_documents
from starling.llm.sentencepiece import encode
from starling.llm.substring import dedup_substrings

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def piece_model() -> str:
    """The vocabulary file: PIECE_MODEL of the environment, or that of the installed tokenizers."""
    if "PIECE_MODEL" in os.environ:
        return os.environ["PIECE_MODEL"]
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return kept_documents(docs.select(*COLUMNS))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of every group of near copies."""
    return one_per_group(docs.select(*COLUMNS), n=5, num=80, den=100)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without the passages that an earlier one holds."""
    cut = dedup_substrings(docs.select(*COLUMNS))
    chars = F.when(F.col("n_removed") > 0, F.char_length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return cut.withColumn("n_chars", chars).select(*COLUMNS)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return clean_documents(docs.select(*COLUMNS), benchmark)


def sentencepiece_codes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_ids, ids, round_trip): the piece ids of every document."""
    coded = encode(docs.select("doc_id", "text"), piece_model(), decoded="decoded")
    return coded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_ids"),
        "ids",
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"),
    )


STAGES = [
    ("quality_rules", quality_rules),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("substring_dedup", substring_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("sentencepiece", sentencepiece_codes),
]

#: SQL cannot express the Viterbi paths; tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage on what the one before it kept."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for position, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if position < len(STAGES) - 1:
            docs = saved(docs, f"pipeline-{name}")
    return docs
