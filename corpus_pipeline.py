"""The corpus pipeline: quality rules, near-duplicates, personal data, mixing, piece encoding.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor kept and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``. All but the last return the columns of ``documents``.
Null texts count as empty, so the quality rules reject them; rows without a doc_id are judged like others, are no
near-duplicate of anything and are encoded. Empty tables pass through every stage.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attesta.llm import minhash, mixing, pieces, pii, quality
from attesta.llm.common import ready, table
from attesta.session import checkpoint_folder

SHINGLE_WORDS = 5
SIMILARITY = 0.8
MODEL = "piece_bpe_32k.model"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    ready(spark)
    return quality.keep(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    ready(spark)
    return minhash.keep_one(docs, size=SHINGLE_WORDS, similarity=SIMILARITY)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with personal data masked and their lengths counted again."""
    ready(spark)
    masked = pii.redact(docs)
    if "n_chars" not in docs.columns:
        return masked
    return masked.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document copies that the mix trains, in training order."""
    ready(spark)
    return mixing.training_order(docs).select(*docs.columns)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document copy."""
    ready(spark)
    encoded = pieces.encode(docs, public_tokenizers.path(MODEL))
    return encoded.select(F.col("id").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_dedup),
    ("personal data", personal_data),
    ("mixing", mix_sources),
    ("piece encoding", encode_pieces),
]

# Segmentation and belief propagation have no SQL form; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    folder = f"{checkpoint_folder(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
