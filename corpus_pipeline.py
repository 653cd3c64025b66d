"""The corpus pipeline: the dealt operators applied to ``documents`` in a fixed order.

Each stage takes what its predecessor kept, written as Parquet and read again, and its
decisions take effect: texts of no language, all but one of a group of near-duplicates and
contaminated documents go, repeated passages are cut from the texts, and the rest is encoded.
All stages but the last return the columns of ``documents``, whatever else these hold and however they are named.
An empty table stays empty through all stages.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.llm import bpe, fm_dedup, odd_sketch, ppm_langid, simhash_decontam
from salesmart.llm.common import table
from salesmart.session import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep texts whose language is found; the model learns from a bounded sample of the stage's own input.

    Null, empty and letterless texts go; where no row has a language all go. Ties go to the first language by name.
    """
    return ppm_langid.keep_identified(docs, ppm_langid.fit(docs, F.lit(True)))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of every group of near-duplicates: a row of its least id, and one of rows with the same id and text.

    Null and blank texts are near nothing and stay; a null id is less than none.
    """
    return odd_sketch.without_duplicates(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut passages that a document with a smaller id holds too; ``n_chars`` follows the text.

    A document of which nothing is left stays, with the empty text; a null text becomes the empty one. Rows without an id
    and rows with the same id are not cut for one another.
    """
    cut = fm_dedup.remove_repeated_words(docs, carry=True)
    columns = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast(docs.schema["n_chars"].dataType)}
    return cut.select(*(columns.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents without a passage like a benchmark item; all rows of a contaminated id go.

    Null and blank texts stay, and all do where the benchmark is empty.
    """
    return simhash_decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode and decode every text, null as the empty one; one row per row, of the id and what encoding gives."""
    return bpe.encode(docs, public_tokenizers.path("word_bpe_49k.json"),
                      ("n_tokens", "ids_sha256", "decoded_sha256"))


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("encoding", encoding),
]
# No stage but the last step of some can be said in SQL; the tests hold each against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


REGISTERED: dict[str, dict] = {
    "QUERIES": {"pipeline": run},
    "ORACLE": {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL},
}
