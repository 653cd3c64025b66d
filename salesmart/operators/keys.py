"""Surrogate keys: ``ROW_NUMBER() OVER (ORDER BY natural key)`` without a hot task.

A window with no ``PARTITION BY`` runs in one task. That is fine for a set known to be
small; beyond ``single_task_max_rows`` the set is range-partitioned on the key, each
partition is sorted and numbered locally, and per-partition offsets (one row per
partition, so their size is bounded by the partition count) turn local numbers into
global ones. Both paths give the same numbers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

SINGLE_TASK_MAX_ROWS = 1_000_000


def _sort_cols(order_cols):
    return [F.col(c).asc_nulls_first() if isinstance(c, str) else c for c in order_cols]


def assign_row_numbers(df: DataFrame, order_cols: list, id_col: str,
                       single_task_max_rows: int = SINGLE_TASK_MAX_ROWS,
                       num_partitions: int | None = None) -> DataFrame:
    """Add ``id_col`` = 1..n in ``order_cols`` order (ties: any order, as in SQL)."""
    ordering = _sort_cols(order_cols)
    rows = df.count()
    if rows <= single_task_max_rows:
        return df.withColumn(id_col, F.row_number().over(Window.orderBy(*ordering)).cast("int"))

    parts = num_partitions or max(2, rows // single_task_max_rows + 1)
    ranged = (df.repartitionByRange(int(parts), *ordering)
              .sortWithinPartitions(*ordering)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_pos", F.monotonically_increasing_id()))
    # Written once so the numbering and the offsets see the same rows in the same order.
    ranged = materialize(ranged, f"rownum-{id_col}")
    stats = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_pos").alias("_first"))
    offsets = stats.withColumn(
        "_offset",
        F.coalesce(F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)))
    # ``offsets`` has one row per partition: a bounded broadcast.
    numbered = ranged.join(F.broadcast(offsets.select("_pid", "_first", "_offset")), "_pid")
    return numbered.select(
        *[c for c in df.columns],
        (F.col("_offset") + (F.col("_pos") - F.col("_first")) + 1).cast("int").alias(id_col))
