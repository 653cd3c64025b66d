"""``sales_performance``: the monthly mart with rolling, growth and rank windows.

Plan shape: fact -> broadcast star join (five checked dimensions) -> hash aggregate on
13 columns (partial aggregation before the shuffle, so the shuffle carries at most one
row per group per map task) -> windows over the aggregate. The windows only ever see
the aggregate, whose size is bounded by the product of the dimension cardinalities
and months, not by the order volume.

Windows whose ``ORDER BY`` is not unique inside the partition get the mart's total
order as tie-break, so a rolling frame counted in rows or a ``LAG`` picks the same
neighbour in every engine and on every run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import mean, pct, total
from ..operators.joins import checked_broadcast
from ..schemas import PERF_GROUP, PERF_TOTAL_ORDER, TOTAL


ENRICHED_COLUMNS = ["ORDER_ID", "UNITS_SOLD", "UNIT_PRICE", "UNIT_COST", "TOTAL_REVENUE",
                    "TOTAL_COST", "TOTAL_PROFIT", "SHIPPING_DAYS", "PRODUCT_CATEGORY", "REGION",
                    "COUNTRY", "SALES_CHANNEL", "ORDER_PRIORITY", "PRIORITY_LABEL",
                    "PRIORITY_SORT_ORDER", "YEAR", "MONTH", "MONTH_NAME", "QUARTER",
                    "YEAR_QUARTER", "YEAR_MONTH", "IS_WEEKEND"]


def enrich(fact: DataFrame, dim_product: DataFrame, dim_geography: DataFrame,
           dim_channel: DataFrame, dim_priority: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Fact rows with the descriptive attributes of their dimensions (inner joins)."""
    dd = dim_date.select("DATE_KEY", "YEAR", "MONTH", "MONTH_NAME", "QUARTER",
                         "YEAR_QUARTER", "YEAR_MONTH", "IS_WEEKEND")
    f = fact.select("ORDER_ID", "UNITS_SOLD", "UNIT_PRICE", "UNIT_COST", "TOTAL_REVENUE",
                    "TOTAL_COST", "TOTAL_PROFIT", "SHIPPING_DAYS", "PRODUCT_ID",
                    "GEOGRAPHY_ID", "CHANNEL_ID", "PRIORITY_ID", "ORDER_DATE_KEY")
    joined = (f
              .join(checked_broadcast(dim_product), "PRODUCT_ID")
              .join(checked_broadcast(dim_geography), "GEOGRAPHY_ID")
              .join(checked_broadcast(dim_channel), "CHANNEL_ID")
              .join(checked_broadcast(dim_priority), "PRIORITY_ID")
              .join(checked_broadcast(dd), f.ORDER_DATE_KEY == dd.DATE_KEY))
    return joined.select(*ENRICHED_COLUMNS)


def aggregate_monthly(enriched: DataFrame, orders_unique: bool = True) -> DataFrame:
    """The 13-column monthly aggregate.

    ``ORDER_COUNT`` is ``COUNT(DISTINCT ORDER_ID)``. The fact has one row per ORDER_ID
    (staging keeps one row per id, every dimension key is unique, and a declared unique
    test guards it), so on the fact grain a plain count is the same number; with
    ``orders_unique`` it is computed that way, which lets the aggregate combine on the
    map side instead of shuffling every order id.
    """
    order_count = F.count("ORDER_ID") if orders_unique else F.countDistinct("ORDER_ID")
    return enriched.groupBy(*PERF_GROUP).agg(
        order_count.alias("ORDER_COUNT"),
        F.sum("UNITS_SOLD").cast("bigint").alias("TOTAL_UNITS_SOLD"),
        total("TOTAL_REVENUE").alias("TOTAL_REVENUE"),
        total("TOTAL_COST").alias("TOTAL_COST"),
        total("TOTAL_PROFIT").alias("TOTAL_PROFIT"),
        mean("UNIT_PRICE").alias("AVG_UNIT_PRICE"),
        mean("UNIT_COST").alias("AVG_UNIT_COST"),
        mean("SHIPPING_DAYS").alias("AVG_SHIPPING_DAYS"),
        pct(F.sum("TOTAL_PROFIT"), F.sum("TOTAL_REVENUE")).alias("GROSS_MARGIN_PCT"),
    )


#: The window partitions whose frames look back over rows, and by how many.
WINDOW_REACH = [(["PRODUCT_CATEGORY"], 11), (["REGION"], 2), (["PRODUCT_CATEGORY", "REGION", "SALES_CHANNEL"], 1)]


def _ordered(partition: list[str]) -> Window:
    return Window.partitionBy(*partition).orderBy(*PERF_TOTAL_ORDER)


def rolling_rows_sum(value: str, partition: list[str], rows: int) -> F.Column:
    """``SUM(value) OVER (PARTITION BY … ORDER BY total order ROWS rows-1 PRECEDING)``."""
    return F.sum(value).over(_ordered(partition).rowsBetween(-(rows - 1), 0)).cast(TOTAL)


def lag_growth_pct(value: str, partition: list[str]) -> F.Column:
    prev = F.lag(value, 1).over(_ordered(partition))
    return pct(F.col(value) - prev, prev)


def rank_desc(value: str, partition: list[str]) -> F.Column:
    return F.rank().over(Window.partitionBy(*partition).orderBy(F.col(value).desc())).cast("int")


def add_window_metrics(agg: DataFrame) -> DataFrame:
    return agg.select(
        "*",
        rolling_rows_sum("TOTAL_REVENUE", ["PRODUCT_CATEGORY"], 12).alias("ROLLING_12M_REVENUE"),
        rolling_rows_sum("TOTAL_PROFIT", ["REGION"], 3).alias("ROLLING_3M_PROFIT"),
        lag_growth_pct("TOTAL_REVENUE", ["PRODUCT_CATEGORY", "REGION", "SALES_CHANNEL"])
        .alias("MOM_REVENUE_GROWTH_PCT"),
        rank_desc("TOTAL_REVENUE", ["YEAR", "MONTH"]).alias("MONTHLY_REVENUE_RANK"),
        rank_desc("TOTAL_PROFIT", ["YEAR", "MONTH"]).alias("MONTHLY_PROFIT_RANK"),
    )


def build_performance(enriched: DataFrame) -> DataFrame:
    return add_window_metrics(aggregate_monthly(enriched))


def calendar_rolling(perf: DataFrame, value: str, by: str, months: int, out_col: str) -> DataFrame:
    """Rolling sum over the last ``months`` calendar months (missing months count as
    nothing), per ``by``: monthly pre-aggregate, then a range frame on a month index."""
    monthly = (perf.groupBy(by, "YEAR", "MONTH").agg(F.sum(value).alias("_v"))
               .withColumn("_month_index", F.col("YEAR") * 12 + F.col("MONTH") - 1))
    w = Window.partitionBy(by).orderBy("_month_index").rangeBetween(-(months - 1), 0)
    return monthly.select(by, "YEAR", "MONTH", F.sum("_v").over(w).cast(TOTAL).alias(out_col))
