"""The registered queries of this subpackage: each applies its operator to the whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import (ctw, embedding_dedup, line_dedup, manifest, merkle, packing, parity_join, ppm_langid, quality_rules,
               sharding, span_dedup, token_alignment, trie_bpe)
from .common import read_table
from .oracle import EMBEDDING_NEAR_DEDUP, MERKLE_MANIFEST

TOKENIZER = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"


def op1_extendible_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(read_table(spark, sf_dir, "documents"))


def op2_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return span_dedup.report(read_table(spark, sf_dir, "documents"))


def op3_parity_sketch_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parity_join.join(read_table(spark, sf_dir, "documents"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op5_trie_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie_bpe.encode_decode(read_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op6_context_tree_weighting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctw.score(read_table(spark, sf_dir, "documents"))


def op7_ppm_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm_langid.identify(read_table(spark, sf_dir, "documents"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(read_table(spark, sf_dir, "documents"))


def op10_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.fingerprints(read_table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.audit(read_table(spark, sf_dir, "documents"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.compare(read_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER),
                                   public_tokenizers.path(PIECES))


def op13_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(read_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_extendible_sharding, op2_sentence_spans, op3_parity_sketch_join, op4_best_fit_packing,
                              op5_trie_bpe, op6_context_tree_weighting, op7_ppm_langid, op8_quality_rules, op9_line_dedup, op10_merkle,
                              op11_merkle_manifest, op12_token_alignment, op13_embedding_near_dedup)
}
ORACLE: dict[str, str] = {"op11_merkle_manifest": MERKLE_MANIFEST, "op13_embedding_near_dedup": EMBEDDING_NEAR_DEDUP}
