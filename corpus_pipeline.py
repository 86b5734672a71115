"""The corpus pipeline: stages over ``documents``, each written and read again.

All stages read whole texts, take further columns along, and give no rows for an empty table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from fleetlake.llm import bpe_sql, pairwise_quality, positional_index, prob_minhash, skip_chain
from fleetlake.sources.scratch import materialised


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the pairwise ranking scores 0.5 or more. Null and empty texts have the score of a
    text without words; repeated rows fare alike; without labels of both kinds all stay."""
    return pairwise_quality.kept(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the smallest doc_id, nulls last. Repeated rows are
    copies. Rows with null texts all stay; of the rows with an equal text without words one stays."""
    return prob_minhash.deduplicated(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item. Null and empty texts hold none; an empty
    benchmark takes nothing; repeated rows fare alike."""
    return positional_index.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data masked in the text and n_chars counted anew; a null text stays null."""
    return skip_chain.redacted(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, tokens of every document left. A null text is empty."""
    coded = bpe_sql.encode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                           public_tokenizers.PATTERN)
    return coded.select(
        "doc_id", F.size("tokens").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("tokens").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"), "tokens")


STAGES = [
    ("quality_classifier", quality),
    ("minhash_near_dedup", deduplicate),
    ("benchmark_decontamination", decontaminate),
    ("pii", redact),
    ("byte_bpe", tokenize),
]

# Scores are learnt and similarities sketched: SQL cannot express the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table; a stage reads what the last one wrote."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialised(stage(spark, docs, sf_dir), name)
    return docs
