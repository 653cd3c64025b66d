"""Star joins against dimensions whose size is checked before they are broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A dimension is broadcast only if it has at most this many rows (checked by a count
# of the materialized dimension); beyond it the join is left to a shuffle join.
BROADCAST_MAX_ROWS = 2_000_000


# Bounded row counts already taken, by (plan, input files, bound). Spark names every file it
# writes uniquely, so the same plan over the same files is the same data.
_COUNTED: dict[tuple, int] = {}


def bounded_count(df: DataFrame, limit: int) -> int:
    """``min(rows of df, limit + 1)``; one job per distinct file-based plan."""
    files = tuple(sorted(df.inputFiles()))
    key = (df.semanticHash(), files, limit) if files else None
    if key is None or key not in _COUNTED:
        n = df.limit(limit + 1).count()
        if key is None:
            return n
        if len(_COUNTED) >= 256:
            _COUNTED.clear()
        _COUNTED[key] = n
    return _COUNTED[key]


def checked_broadcast(dim: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """``broadcast(dim)`` if ``dim`` has at most ``max_rows`` rows, else ``dim``.

    ``dim`` should be materialized (or tiny to compute): the check runs a count, once
    per plan and set of files.
    """
    n = bounded_count(dim, max_rows)
    return F.broadcast(dim) if n <= max_rows else dim


def anti_join(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose non-NULL key has no parent (``LEFT JOIN … WHERE p.key IS NULL``)."""
    keys = parent.select(F.col(parent_key).alias("_parent_key")).distinct()
    return (child.where(F.col(child_key).isNotNull())
            .join(keys, F.col(child_key) == F.col("_parent_key"), "left_anti"))
