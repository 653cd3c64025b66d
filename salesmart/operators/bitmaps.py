"""Exact sets of integer ids as rows of 64-bit words.

A set is a table of (keys, word, bits): ``word`` is the id without its last six bits, ``bits`` has one bit
for each of the 64 ids of that word. Ids that stand close together (order numbers of a month) cost
a fraction of a byte each, scattered ones a row each; nothing is lost. Sets merge by OR, so distinct
ids can be counted for any grouping from the sets of a finer one, and the keys that hold some
ids are found by a join on ``word`` alone, without reading the rows that the ids came from.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _bit(id_: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), id_.bitwiseAND(F.lit(63).cast("long")).cast("int"))


def id_sets(df: DataFrame, keys: list[str], id_col: str) -> DataFrame:
    """(keys, word, bits) of the non-null ids of every combination of keys; combined on the map side."""
    id_ = F.col(id_col).cast("long")
    return df.where(id_.isNotNull()).groupBy(*keys, F.shiftright(id_, 6).alias("word")).agg(F.bit_or(_bit(id_)).alias("bits"))


def merged(sets: DataFrame, keys: list[str]) -> DataFrame:
    """The sets of a coarser grouping."""
    return sets.groupBy(*keys, "word").agg(F.bit_or("bits").alias("bits"))


def distinct_count(sets: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Number of distinct ids for each combination of ``keys`` (some or none of the sets' keys)."""
    n = F.coalesce(F.sum(F.bit_count("bits")), F.lit(0)).cast("bigint").alias(name)
    return merged(sets, keys).groupBy(*keys).agg(n)


def holders(sets: DataFrame, ids: DataFrame, keys: list[str]) -> DataFrame:
    """The distinct ``keys`` of ``sets`` that hold some id of ``ids`` (word, bits)."""
    a, b = sets.alias("a"), ids.alias("b")
    met = a.join(b, (F.col("a.word") == F.col("b.word")) & (F.col("a.bits").bitwiseAND(F.col("b.bits")) != 0), "left_semi")
    return met.select(*keys).distinct()
