"""The queries of this package: one per operator over its whole table.  Each
derives the contract's columns from the operator's own outputs."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bpe,
    conversation_repair,
    decontam,
    language_id,
    line_dedup,
    prefix_trie,
    pu_quality,
    quality_rules,
    secret_scan,
    simhash,
    token_files,
    token_group_join,
    url_rules,
)
from .common import read, ship

BYTE_BPE, WORD_BPE = "byte_bpe_50k.json", "word_bpe_49k.json"


def op1_bpe_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded, digested, decoded, digested."""
    ship(spark)
    path = public_tokenizers.path(BYTE_BPE)
    decoded = bpe.decode(bpe.encode(read(spark, sf_dir, "documents"), path), path)
    return decoded.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
                          F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256)
                          .alias("ids_sha256"),
                          F.sha2("text", 256).alias("decoded_sha256"))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's secrets: base spans, and those the network adds."""
    ship(spark)
    docs = read(spark, sf_dir, "documents")
    found = secret_scan.scan(docs, secret_scan.train(docs))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")

    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in secret_scan.KINDS],
                        F.sha2(_joined(F.filter("spans", lambda s: s["kind"] != "network")), 256)
                        .alias("base_sha256"),
                        _joined(F.col("spans")).alias("spans"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positive-unlabelled quality score of every document."""
    ship(spark)
    return pu_quality.quality_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every repeated line or run of sentences to remove, with its offsets."""
    ship(spark)
    return line_dedup.repeated_passages(read(spark, sf_dir, "documents"))


def op4_all_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every repeated line to remove, however short, with its offsets."""
    ship(spark)
    return line_dedup.repeated_lines(read(spark, sf_dir, "documents"), min_words=1)


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids as read back from the written files."""
    ship(spark)
    back = token_files.tokenized(spark, read(spark, sf_dir, "documents"),
                                 public_tokenizers.path(WORD_BPE))
    return back.select(F.col("id").alias("doc_id"), "start",
                       F.expr("CAST(octet_length(ids) DIV 4 AS BIGINT)").alias("n_tokens"),
                       F.crc32("ids").alias("ids_crc32"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Curated rule and verdict of every page's URL."""
    ship(spark)
    return url_rules.url_verdicts(read(spark, sf_dir, "pages"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base rule and risk-controlled verdict of every document."""
    ship(spark)
    judged = quality_rules.quality_verdicts(read(spark, sf_dir, "documents"),
                                            read(spark, sf_dir, "labels"))
    return judged.selectExpr("id AS doc_id", "s.n_words", "s.word_chars", "s.n_symbols",
                             "s.n_dup_lines", "s.n_repeat_words", "base_failed", "kept")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    ship(spark)
    docs = read(spark, sf_dir, "documents")
    return language_id.languages(docs, language_id.fit(docs)).select(
        "doc_id", "held_out", "lang_pred", "score", F.size("spans").cast("bigint").alias("n_spans"))


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and benchmark item it contains."""
    ship(spark)
    return decontam.contained_items(read(spark, sf_dir, "documents"),
                                    read(spark, sf_dir, "benchmark"))


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    ship(spark)
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest edits and repaired digest of every conversation."""
    ship(spark)
    return conversation_repair.repaired(read(spark, sf_dir, "conversations"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of rebuilt conversations."""
    ship(spark)
    return prefix_trie.trie(read(spark, sf_dir, "conversations"))


def op13_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingles and component of linked texts of every document."""
    ship(spark)
    return token_group_join.linked_documents(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_bpe_encode_decode, op2_secret_scan, op3_quality_classifier, op4_line_dedup,
    op4_all_lines, op5_token_files, op6_url_filter, op7_quality_rules, op8_language_id,
    op9_benchmark_decontamination, op10_simhash_near_dedup, op11_conversation_repair,
    op12_prefix_trie, op13_ngram_jaccard_join)}

ORACLES: dict[str, str] = {
    "op4_line_dedup": line_dedup.repeated_passages_sql(),
    "op4_all_lines": line_dedup.repeated_lines_sql(min_words=1),
    "op9_benchmark_decontamination": decontam.containment_sql(),
    "op12_prefix_trie": prefix_trie.trie_sql(),
    "op13_ngram_jaccard_join": token_group_join.links_sql(),
}
