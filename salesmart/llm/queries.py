"""The registered queries of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.llm import (
    bpe,
    brown_lm,
    conversation_repair,
    fm_dedup,
    llr_quality,
    odd_sketch,
    pivotal_grams,
    ppm_langid,
    signature_trees,
    simhash_decontam,
    style_tree,
    suffix_dedup,
    token_counts,
)
from salesmart.llm.common import crc_mod, table
from salesmart.llm.oracle import ORACLE

__all__ = ["ORACLE", "QUERIES"]

Query = Callable[[SparkSession, str], DataFrame]
VOCABULARY = "word_bpe_49k.json"


def op1_brown_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = crc_mod(F.col("doc_id"), 7) == 2
    return brown_lm.score(docs, brown_lm.fit(docs, ~held_out)).withColumn("held_out", held_out)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = crc_mod(F.col("doc_id"), 3) == 1
    return ppm_langid.predict(docs, ppm_langid.fit(docs, ~held_out)).withColumn("held_out", held_out)


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return style_tree.extract(table(spark, sf_dir, "pages"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeated_bytes(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fm_dedup.remove_repeated_words(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", "kept_sha256")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return llr_quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return odd_sketch.near_duplicates(table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY),
                      ("n_tokens", "ids_sha256", "decoded_sha256"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivotal_grams.variants(table(spark, sf_dir, "documents"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return conversation_repair.summary(conversations, conversation_repair.damage(conversations))


def op13_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signature_trees.linked(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_brown_lm": op1_brown_lm,
    "op2_language_id": op2_language_id,
    "op3_token_counts": op3_token_counts,
    "op4_main_text": op4_main_text,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_quality_rules": op7_quality_rules,
    "op8_near_duplicates": op8_near_duplicates,
    "op9_decontamination": op9_decontamination,
    "op10_bpe": op10_bpe,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_jaccard_join": op13_jaccard_join,
}
