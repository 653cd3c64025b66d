"""Numeric helpers: exact decimal totals, safe division, rounded percentages, formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import TOTAL


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def total(c: Column | str) -> Column:
    """``SUM`` of a money column, in the widest decimal."""
    return F.sum(_col(c)).cast(TOTAL)


def mean(c: Column | str) -> Column:
    """Average as a double: exact sum, then one division (NULLs ignored)."""
    x = _col(c)
    return F.sum(x).cast("double") / F.count(x)


def nullif_zero(c: Column) -> Column:
    return F.when(c != 0, c)


def pct(numerator: Column, denominator: Column) -> Column:
    """``ROUND(n / NULLIF(d, 0) * 100, 2)`` of amounts, half away from zero.

    In whole units of 1e-8 and by integer division, so amounts of up to eight decimals (and below 1e25)
    give the exact percentage: a quotient of wide decimals would lose digits.
    """
    n, d = ((F.abs(x) * F.lit(10 ** 8)).cast("decimal(38,0)") for x in (numerator, denominator))
    hundredths = F.call_function("div", n * 20000 + d, nullif_zero(d * 2))
    negative = (numerator < 0) != (denominator < 0)
    signed = F.when(negative, -hundredths).otherwise(hundredths)
    return (signed.cast("decimal(20,0)") * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(18,2)")


def divide(numerator: Column, denominator: Column, alternate: Column | float | None = 0.0) -> Column:
    """``DIVIDE(a, b, alt)``: ``alt`` when ``b`` is NULL or 0, else ``a / b`` as double."""
    alt = alternate if isinstance(alternate, Column) else F.lit(alternate).cast("double")
    return (F.when(denominator.isNull() | (denominator == 0), alt)
            .otherwise(numerator.cast("double") / denominator.cast("double")))


def _one_decimal(c: Column) -> Column:
    """One decimal with thousands separators, halves away from zero: rounded as a decimal, since
    ``format_number`` alone rounds halves to the even digit."""
    return F.format_number(F.round(c.cast("decimal(30,10)"), 1), 1)


def format_percent(c: Column) -> Column:
    """``FORMAT(x, "0.0%")``: one decimal, no group separator."""
    return F.when(c.isNotNull(), F.concat(F.regexp_replace(_one_decimal(c * 100), ",", ""), F.lit("%")))


def format_millions(c: Column) -> Column:
    """``FORMAT(x / 1e6, "#,##0.0") & "M"``."""
    return F.when(c.isNotNull(), F.concat(_one_decimal(c / 1_000_000), F.lit("M")))
