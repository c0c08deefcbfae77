"""Registered queries of the training-data operators, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from camadas.llm import (
    decontaminate, divergence, language, lines, mixing, neardup, packing, prefixes, quality, substrings, tokens, topk, toxicity)
from camadas.llm.common import fold, table

Query = Callable[[SparkSession, str], DataFrame]

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components over two-word shingles."""
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), size=2)


def op2_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, one row per pair."""
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document."""
    return language.identify(table(spark, sf_dir, "documents"), fold("doc_id", 4, 2), PIECES)


def op4_repeated_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without repeated 100-byte strings."""
    return substrings.digest(table(spark, sf_dir, "documents"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents, written to and read from fixed-size-list files."""
    return tokens.encode(table(spark, sf_dir, "documents"), BYTE_BPE)


def op6_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best rows of every hundredth vector."""
    found = topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)
    return found.withColumn("rank", F.col("rank").cast("int"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of every document."""
    held = fold("doc_id", 4, 2)
    scored = quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), held, 0.7)
    return scored.select("doc_id", held.alias("held_out"), "score", "predicted")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of every document."""
    held = fold("doc_id", 5, 0)
    scored = toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), held, 0.5)
    return scored.select("doc_id", held.alias("held_out"), "score", "predicted", F.size("passages").cast("long").alias("n_passages"))


def op9_boilerplate_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the lines found on five sources or more."""
    cleaned = lines.drop_boilerplate(table(spark, sf_dir, "documents"), least_sites=5)
    return cleaned.select("doc_id", "n_lines", "n_removed", F.md5(F.coalesce("text", F.lit(""))).alias("kept_md5"))


def op10_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much of every document the mixture takes."""
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the sources of a language are apart, and the terms that stand out in each."""
    return divergence.audit(table(spark, sf_dir, "documents"), least_docs=30, top=50)


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where every piece of every document stands in sequences of 2048 ids."""
    pieces = packing.pack(table(spark, sf_dir, "documents"), WORD_BPE, end_id=1, length=2048)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every shared beginning of the rebuilt conversations."""
    return prefixes.prefix_trie(table(spark, sf_dir, "conversations"), family=5, heads=9)


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_near_duplicates, op2_benchmark_leaks, op3_language, op4_repeated_substrings, op5_token_files, op6_top_k,
    op7_quality, op8_toxicity, op9_boilerplate_lines, op10_mixture, op11_source_divergence, op12_packing, op13_prefix_trie)}
