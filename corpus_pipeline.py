"""The corpus pipeline: documents to token ids, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run``
writes it as Parquet to the shared folder and gives the reread table to the
next.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saletrace.llm import bpe, decontam, quality_rules, secret_scan, simhash
from saletrace.llm.common import materialize, read, ship


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality rules reject go."""
    ship(spark)
    return quality_rules.keep_good(docs, read(spark, sf_dir, "labels"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays."""
    ship(spark)
    return simhash.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    ship(spark)
    return decontam.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret found is masked; all documents stay."""
    ship(spark)
    return secret_scan.redact(docs, secret_scan.train(docs)).withColumn(
        "n_chars", F.length("text").cast("bigint"))


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document."""
    ship(spark)
    encoded = bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return encoded.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids")


STAGES = [
    ("quality rules", quality_stage),
    ("SimHash near-dedup", near_dedup_stage),
    ("benchmark decontamination", decontamination_stage),
    ("secret scans", secrets_stage),
    ("BPE encoding and decoding", encode_stage),
]

#: SQL cannot express XXH64 fingerprints or the learned parts.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = read(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{number}")
    return docs
