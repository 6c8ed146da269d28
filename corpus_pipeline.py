"""From raw documents to packed token sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next stage's documents:

1. language ID (PPM): documents without a letter, or whose language is doubtful, go;
2. line dedup: lines that equal or match an earlier line go, and documents left empty by that;
3. n-gram Jaccard join (five words, 0.8): one document of each group stays;
4. substring dedup: sentences of passages seen before go, and documents left empty by that;
5. best-fit packing: the remaining documents as token sequences.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playmart.llm import line_dedup, packing, parity_join, ppm_langid, span_dedup
from playmart.llm.common import importable, materialise, read_table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def recount(docs: DataFrame) -> DataFrame:
    """The column n_chars after the texts have changed."""
    return docs.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else docs


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    return ppm_langid.keep_known(docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    return recount(line_dedup.remove(docs))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    return parity_join.keep_one(docs, 5, 80)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    return recount(span_dedup.remove(docs))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("line_dedup", line_dedup_stage),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("substring_dedup", substring_dedup),
    ("best_fit_packing", best_fit_packing),
]

#: Byte context trees and packing can't be said in SQL; tests/llm holds the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the whole documents table."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
