"""Declared columns, enforced when a table is written.

Types are compared before anything runs. Lengths and required values are counted by an
``Observation`` of the write itself, so they cost no pass of their own; a write with a violation is
not committed (see ``sources.loads``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Refused(ValueError):
    """Rows that the declared columns do not admit; ``counts`` tells how many by rule."""

    def __init__(self, message: str, counts: dict[str, int] | None = None):
        super().__init__(message)
        self.counts = counts or {}


def check_types(df: DataFrame, declared: T.StructType) -> None:
    """The columns are the declared ones, in order and type."""
    have = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    want = [(f.name, f.dataType.simpleString()) for f in declared.fields]
    if have != want:
        wrong = [f"{n}: {t}" for n, t in have if (n, t) not in want] + [f"{n}: missing" for n, _ in want if n not in dict(have)]
        raise Refused(f"columns differ from the declared ones: {', '.join(wrong) or 'their order'}")


def rules(declared: T.StructType, max_length: dict[str, int]) -> dict[str, Column]:
    """By name, a condition that holds where a row breaks the rule."""
    out = {f"{f.name}: missing": F.col(f.name).isNull() for f in declared.fields if not f.nullable}
    return out | {f"{c}: longer than {n}": F.length(c) > n for c, n in max_length.items()}


def counted(broken: dict[str, Column], where: Column) -> list[Column]:
    """An aggregate for each rule: the rows among ``where`` that break it."""
    return [F.count(F.when(where & rule, 1)).alias(name) for name, rule in broken.items()]
