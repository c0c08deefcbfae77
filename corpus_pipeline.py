"""A training corpus from the documents table: score, de-duplicate, decontaminate, mix, tokenise.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again
as the next one's documents. All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from camadas.llm import decontaminate, mixing, neardup, quality, tokens
from camadas.llm.common import fold, table, unused, with_row_key
from camadas.llm.queries import BYTE_BPE
from camadas.session import materialize


def _columns(docs: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in docs.columns]


def _keyed(docs: DataFrame, *more: str) -> tuple[DataFrame, DataFrame, str]:
    """The rows with a key of their own, the documents an operator sees under that key, and its name."""
    key = unused("row_key", docs)
    rows = with_row_key(docs, key)
    return rows, rows.select(F.col(key).alias("doc_id"), "text", *more), key


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject; all of them where it has nothing to learn from.

    Every row is judged by its own text; null and empty texts have the score of no statistics.
    """
    return quality.keep_good(docs, table(spark, sf_dir, "labels"), fold("doc_id", 4, 2), 0.7)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id, once.

    Different texts with one id, and texts without an id, are documents of their own; rows that agree in id
    and text are one. Texts without words are in no group.
    """
    rows, texts, key = _keyed(docs)
    kept = neardup.near_duplicates(texts).where("kept").select(F.col("doc_id").alias(key)).distinct()
    return rows.join(kept, key, "left_semi").dropDuplicates([key]).select(*_columns(docs))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, row by row; null and empty texts hold none."""
    rows, texts, key = _keyed(docs)
    leaks = decontaminate.find_leaks(texts, table(spark, sf_dir, "benchmark")).select(F.col("doc_id").alias(key)).distinct()
    return rows.join(leaks, key, "left_anti").select(*_columns(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mixture takes it; documents without words are never taken."""
    rows, texts, key = _keyed(docs, "source")
    copies, number = unused("mix_copies", rows), unused("mix_number", rows)
    taken = mixing.mix(texts).where("taken > 0").groupBy(F.col("doc_id").alias(key)).agg(F.max("copies").alias(copies))
    times = F.sequence(F.lit(1), F.col(copies).cast("int"))
    return rows.join(taken, key).withColumn(number, F.explode(times)).select(*_columns(docs))


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mixture, and where each document is in them."""
    return tokens.encode(docs, BYTE_BPE)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("mixture", mix_sources),
    ("tokens", write_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


# Classifier, latent retrieval and tokenizer are beyond SQL; tests/llm/test_pipeline.py has a plain twin.
ORACLE_SQL = None
