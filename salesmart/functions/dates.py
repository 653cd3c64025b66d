"""Date functions as native column expressions (no Python UDFs)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Accepted text date formats, tried in this order; the first match wins:
# month/day/year, year-month-day, day/month/year (one- or two-digit month and day).
SLASH_SHAPE = r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$"
DASH_SHAPE = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"
# The characters Python's str.strip() removes (Unicode whitespace).
WHITESPACE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003"
              "\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")
# Fixed value: sentinel for a missing date in staging.
SENTINEL_DATE = "1900-01-01"
# Fixed value: width of blank-padded month and day names.
NAME_WIDTH = 9


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c: Column | str) -> Column:
    """Remove leading and trailing whitespace of any kind (not only spaces)."""
    return F.trim(_col(c), F.lit(WHITESPACE))


def _checked_date(y: Column, m: Column, d: Column) -> Column:
    """The date y-m-d, or NULL if it does not exist (month 13, 30 February, ...).

    Built without any call that can fail: January 1 of the year, plus m-1 months, plus
    d-1 days; the result is the requested date exactly when its month and day come back
    unchanged.
    """
    candidate = F.date_add(F.add_months(F.make_date(y, F.lit(1), F.lit(1)), m - 1), d - 1)
    ok = (y >= 1) & (m >= 1) & (d >= 1) & (F.month(candidate) == m) & (F.dayofmonth(candidate) == d)
    return F.when(ok, candidate)


def date_from_parts(parts: Column, slash: Column, dash: Column) -> Column:
    """Date from the split text ``parts`` and its shape flags, formats in priority order."""
    a, b, c = [F.when(slash | dash, parts.getItem(i)).cast("int") for i in range(3)]
    return F.coalesce(F.when(slash, _checked_date(c, a, b)),    # month/day/year
                      F.when(dash, _checked_date(a, b, c)),     # year-month-day
                      F.when(slash, _checked_date(c, b, a)))    # day/month/year


def with_parsed_dates(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add one parsed date per ``{name: text column}``, in three small projections.

    Stripping, the shape tests and the split are separate steps so every generated
    method stays small enough for the JIT; a single expression that re-derives them
    inline grows past the JVM's compile limit and runs interpreted.
    """
    names = list(columns)
    step = df.select("*", *[strip_ws(columns[n]).alias(f"__t_{n}") for n in names])
    step = step.select("*", *[x for n in names for x in (
        F.col(f"__t_{n}").rlike(SLASH_SHAPE).alias(f"__s_{n}"),
        F.col(f"__t_{n}").rlike(DASH_SHAPE).alias(f"__d_{n}"),
        F.split(F.col(f"__t_{n}"), "[/-]").alias(f"__p_{n}"))])
    step = step.select("*", *[date_from_parts(F.col(f"__p_{n}"), F.col(f"__s_{n}"), F.col(f"__d_{n}")).alias(n)
                              for n in names])
    return step.drop(*[f"__{k}_{n}" for n in names for k in ("t", "s", "d", "p")])


def parse_date_multi(c: Column | str) -> Column:
    """Single-expression form of the parser (for ad-hoc use on one column)."""
    text = strip_ws(c)
    return date_from_parts(F.split(text, "[/-]"), text.rlike(SLASH_SHAPE), text.rlike(DASH_SHAPE))


def date_key(c: Column | str) -> Column:
    """YYYYMMDD as an integer."""
    return F.date_format(_col(c), "yyyyMMdd").cast("int")


def month_name(c: Column | str) -> Column:
    """Full month name blank-padded to 9 characters."""
    return F.rpad(F.date_format(_col(c), "MMMM"), NAME_WIDTH, " ")


def day_name(c: Column | str) -> Column:
    """Full weekday name blank-padded to 9 characters."""
    return F.rpad(F.date_format(_col(c), "EEEE"), NAME_WIDTH, " ")


def day_of_week(c: Column | str) -> Column:
    """0 = Sunday ... 6 = Saturday."""
    return (F.dayofweek(_col(c)) - 1).cast("int")


def iso_week(c: Column | str) -> Column:
    return F.weekofyear(_col(c)).cast("int")


def year_quarter(c: Column | str) -> Column:
    d = _col(c)
    return F.concat(F.year(d).cast("string"), F.lit("-Q"), F.quarter(d).cast("string"))


def year_month(c: Column | str) -> Column:
    d = _col(c)
    return F.concat(F.year(d).cast("string"), F.lit("-"),
                    F.lpad(F.month(d).cast("string"), 2, "0"))


def as_of_date(as_of: str | _dt.date | None) -> Column:
    """The run date as a literal; ``None`` means today."""
    if as_of is None:
        return F.current_date()
    return F.lit(str(as_of)).cast("date")


def days_before_key(as_of: str | _dt.date | None, days: int) -> Column:
    """``TO_CHAR(as_of - days, 'YYYYMMDD')::INT`` as a column."""
    return date_key(F.date_sub(as_of_date(as_of), days))
