"""Keep one row per key: ``ROW_NUMBER() OVER (PARTITION BY key ORDER BY ...) = 1``.

Spark plans the ``= 1`` filter as a ``WindowGroupLimit`` on both sides of the shuffle,
so every map task keeps at most one row per key before anything is sent: a key that
holds a third of the input still moves only one row per map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, key: list[str], ordering: list[Column],
                  rank_col: str = "_row_num") -> DataFrame:
    """Rows ranked 1 within ``key`` by ``ordering``; make ``ordering`` total for a
    deterministic result."""
    w = Window.partitionBy(*key).orderBy(*ordering)
    return (df.withColumn(rank_col, F.row_number().over(w))
            .where(F.col(rank_col) == 1)
            .drop(rank_col))


def duplicate_keys(df: DataFrame, key: list[str], min_count: int = 2) -> DataFrame:
    """``GROUP BY key HAVING COUNT(*) >= min_count`` with the count as ``N_ROWS``."""
    return (df.groupBy(*key).agg(F.count(F.lit(1)).alias("N_ROWS"))
            .where(F.col("N_ROWS") >= min_count))
