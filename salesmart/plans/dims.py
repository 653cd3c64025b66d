"""The five dimensions built from staging, plus the full calendar.

Each dimension is a ``DISTINCT`` over one or two staging columns (partial aggregation
on the map side, so only distinct values cross the network) and a surrogate id from
``assign_row_numbers`` in natural-key order.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates as D
from ..operators.keys import assign_row_numbers

# Priority codes, their labels and sort order; unknown codes keep their
# own text as label and sort last.
PRIORITY_LABELS = {"C": "Critical", "H": "High", "M": "Medium", "L": "Low"}
PRIORITY_SORT = {"C": 1, "H": 2, "M": 3, "L": 4}
PRIORITY_SORT_OTHER = 99
# Span of the full reporting calendar.
CALENDAR_START = _dt.date(2020, 1, 1)
CALENDAR_END = _dt.date(2026, 12, 31)


def _present(c: str) -> Column:
    return F.col(c).isNotNull() & (F.col(c) != "")


def date_spine(stg: DataFrame) -> DataFrame:
    """Distinct order and ship dates (``UNION``), as ``date_col``."""
    orders = stg.where(F.col("order_date").isNotNull()).select(F.col("order_date").alias("date_col"))
    ships = stg.where(F.col("ship_date").isNotNull()).select(F.col("ship_date").alias("date_col"))
    return orders.union(ships).distinct()


def date_attributes(dates: DataFrame, date_col: str = "date_col") -> DataFrame:
    d = F.col(date_col)
    dow = D.day_of_week(d)
    return dates.select(
        D.date_key(d).alias("DATE_KEY"),
        d.alias("FULL_DATE"),
        F.dayofmonth(d).cast("int").alias("DAY"),
        F.month(d).cast("int").alias("MONTH"),
        D.month_name(d).alias("MONTH_NAME"),
        F.quarter(d).cast("int").alias("QUARTER"),
        F.year(d).cast("int").alias("YEAR"),
        D.iso_week(d).alias("WEEK_OF_YEAR"),
        dow.alias("DAY_OF_WEEK"),
        D.day_name(d).alias("DAY_NAME"),
        dow.isin(0, 6).alias("IS_WEEKEND"),
        D.year_quarter(d).alias("YEAR_QUARTER"),
        D.year_month(d).alias("YEAR_MONTH"),
    )


def build_dim_date(stg: DataFrame) -> DataFrame:
    return date_attributes(date_spine(stg))


def geography_keys(stg: DataFrame) -> DataFrame:
    return (stg.where(_present("region") & _present("country"))
            .select("region", "country").distinct())


def product_keys(stg: DataFrame) -> DataFrame:
    return stg.where(_present("item_type")).select("item_type").distinct()


def channel_keys(stg: DataFrame) -> DataFrame:
    return stg.where(_present("sales_channel")).select("sales_channel").distinct()


def priority_keys(stg: DataFrame) -> DataFrame:
    return stg.where(_present("order_priority")).select("order_priority").distinct()


def number_geography(keys: DataFrame) -> DataFrame:
    return (assign_row_numbers(keys, ["region", "country"], "GEOGRAPHY_ID")
            .select("GEOGRAPHY_ID", F.col("region").alias("REGION"), F.col("country").alias("COUNTRY")))


def number_product(keys: DataFrame) -> DataFrame:
    return (assign_row_numbers(keys, ["item_type"], "PRODUCT_ID")
            .select("PRODUCT_ID", F.col("item_type").alias("PRODUCT_CATEGORY")))


def number_channel(keys: DataFrame) -> DataFrame:
    return (assign_row_numbers(keys, ["sales_channel"], "CHANNEL_ID")
            .select("CHANNEL_ID", F.col("sales_channel").alias("SALES_CHANNEL")))


def priority_label(c: Column) -> Column:
    expr = c
    for code, label in reversed(list(PRIORITY_LABELS.items())):
        expr = F.when(c == code, F.lit(label)).otherwise(expr)
    return expr


def priority_sort(c: Column) -> Column:
    expr = F.lit(PRIORITY_SORT_OTHER)
    for code, rank in reversed(list(PRIORITY_SORT.items())):
        expr = F.when(c == code, F.lit(rank)).otherwise(expr)
    return expr.cast("int")


def number_priority(keys: DataFrame) -> DataFrame:
    p = F.col("order_priority")
    return (assign_row_numbers(keys, ["order_priority"], "PRIORITY_ID")
            .select("PRIORITY_ID", p.alias("ORDER_PRIORITY"),
                    priority_label(p).alias("PRIORITY_LABEL"),
                    priority_sort(p).alias("PRIORITY_SORT_ORDER")))


def build_dim_geography(stg: DataFrame) -> DataFrame:
    return number_geography(geography_keys(stg))


def build_dim_product(stg: DataFrame) -> DataFrame:
    return number_product(product_keys(stg))


def build_dim_channel(stg: DataFrame) -> DataFrame:
    return number_channel(channel_keys(stg))


def build_dim_priority(stg: DataFrame) -> DataFrame:
    return number_priority(priority_keys(stg))


def calendar(spark: SparkSession, start: _dt.date = CALENDAR_START,
             end: _dt.date = CALENDAR_END) -> DataFrame:
    """Every day from ``start`` to ``end`` with the ``dim_date`` attributes.

    Generated from a distributed ``range`` of day offsets, not a driver-side list.
    """
    days = (end - start).days + 1
    offsets = spark.range(0, days)
    dates = offsets.select(F.date_add(F.lit(str(start)).cast("date"), F.col("id").cast("int")).alias("date_col"))
    return date_attributes(dates)
