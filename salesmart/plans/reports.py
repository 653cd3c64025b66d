"""Report datasets behind the five dashboard pages, built from the monthly mart."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.numeric import divide, mean, total
from . import dims as DM
from . import measures as MS

TOP_MARKETS = 5
MONTHS = list(range(1, 13))


def executive_kpis(perf: DataFrame) -> DataFrame:
    """Revenue, profit, margin and MoM trend per month."""
    return perf.groupBy("YEAR", "MONTH").agg(
        total("TOTAL_REVENUE").alias("TOTAL_REVENUE"),
        total("TOTAL_PROFIT").alias("TOTAL_PROFIT"),
        divide(F.sum("TOTAL_PROFIT"), F.sum("TOTAL_REVENUE"), 0.0).alias("GROSS_MARGIN"),
        mean("MOM_REVENUE_GROWTH_PCT").alias("MOM_REVENUE_GROWTH"))


def top_markets(perf: DataFrame, n: int = TOP_MARKETS) -> DataFrame:
    """The ``n`` countries with the highest revenue (ties broken by name)."""
    return (perf.groupBy("COUNTRY").agg(total("TOTAL_REVENUE").alias("TOTAL_REVENUE"))
            .orderBy(F.col("TOTAL_REVENUE").desc(), "COUNTRY").limit(n))


def geographic(perf: DataFrame) -> DataFrame:
    """Per country: revenue, profit, margin and share of its region's revenue."""
    g = perf.groupBy("REGION", "COUNTRY").agg(
        total("TOTAL_REVENUE").alias("TOTAL_REVENUE"), total("TOTAL_PROFIT").alias("TOTAL_PROFIT"))
    region_total = F.sum("TOTAL_REVENUE").over(Window.partitionBy("REGION"))
    return g.select("REGION", "COUNTRY", "TOTAL_REVENUE", "TOTAL_PROFIT",
                    divide(F.col("TOTAL_PROFIT"), F.col("TOTAL_REVENUE"), 0.0).alias("GROSS_MARGIN"),
                    divide(F.col("TOTAL_REVENUE"), region_total, 0.0).alias("SHARE_OF_REGION"))


def product(perf: DataFrame) -> DataFrame:
    """Per category: revenue, profit, margin and the channel mix."""
    online = F.coalesce(F.sum(F.when(F.col("SALES_CHANNEL") == MS.ONLINE_CHANNEL, F.col("TOTAL_REVENUE"))), F.lit(0))
    return perf.groupBy("PRODUCT_CATEGORY").agg(
        total("TOTAL_REVENUE").alias("TOTAL_REVENUE"), total("TOTAL_PROFIT").alias("TOTAL_PROFIT"),
        divide(F.sum("TOTAL_PROFIT"), F.sum("TOTAL_REVENUE"), 0.0).alias("GROSS_MARGIN"),
        divide(online, F.sum("TOTAL_REVENUE"), 0.0).alias("ONLINE_SHARE"))


def time_heatmap(perf: DataFrame) -> DataFrame:
    """Year x month revenue matrix; the month list is fixed, so the pivot needs no
    extra pass to discover its columns."""
    p = perf.groupBy("YEAR").pivot("MONTH", MONTHS).agg(total("TOTAL_REVENUE"))
    return p.select("YEAR", *[F.col(str(m)).alias(f"M{m:02d}") for m in MONTHS])


def channel_priority(perf: DataFrame) -> DataFrame:
    """Revenue per channel and priority with its share of the total."""
    g = perf.groupBy("SALES_CHANNEL", "ORDER_PRIORITY", "PRIORITY_LABEL").agg(
        total("TOTAL_REVENUE").alias("TOTAL_REVENUE"))
    # The grouped result has one row per (channel, priority): a bounded single window.
    grand = F.sum("TOTAL_REVENUE").over(Window.partitionBy(F.lit(1)))
    return g.select("*", divide(F.col("TOTAL_REVENUE"), grand, 0.0).alias("SHARE_OF_TOTAL"))


def calendar_for_data(stg: DataFrame) -> DataFrame:
    """Full calendar from 1 January of the first order year to 31 December of the last:
    one ``sequence`` per data set, exploded on the executors."""
    bounds = stg.agg(F.min("order_date").alias("_lo"), F.max("order_date").alias("_hi"))
    days = bounds.select(F.explode(F.sequence(
        F.make_date(F.year("_lo"), F.lit(1), F.lit(1)),
        F.make_date(F.year("_hi"), F.lit(12), F.lit(31)),
        F.expr("INTERVAL 1 DAY"))).alias("date_col"))
    return DM.date_attributes(days)


def reporting_calendar(spark: SparkSession) -> DataFrame:
    """The fixed 2020-2026 reporting calendar of the semantic model."""
    return DM.calendar(spark)
