"""BI measures over the monthly mart, evaluated in a filter context.

A measure is ``f(perf, by) -> DataFrame`` with one row per distinct value of ``by``
(the filter context). Aggregate first, then divide. ``ALL(column)`` (remove one column
from the context) becomes a window over the grouped result partitioned by the other
``by`` columns, so no second pass over the mart is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import divide, format_millions, format_percent, mean, total
from ..schemas import TOTAL

# Badge colours for month-over-month growth (non-negative, negative).
MOM_COLOR_UP = "#2E7D32"
MOM_COLOR_DOWN = "#C62828"
# Filters used inside measures.
ONLINE_CHANNEL = "Online"
CRITICAL_PRIORITY = "C"
TOP_N_PRODUCTS = 5


def _by(by: list[str] | None) -> list[str]:
    return list(by or [])


def _group(perf: DataFrame, by: list[str] | None, *aggs: Column) -> DataFrame:
    by = _by(by)
    return perf.groupBy(*by).agg(*aggs) if by else perf.agg(*aggs)


def total_revenue(perf, by=None):
    return _group(perf, by, total("TOTAL_REVENUE").alias("TOTAL_REVENUE"))


def total_cost(perf, by=None):
    return _group(perf, by, total("TOTAL_COST").alias("TOTAL_COST"))


def total_profit(perf, by=None):
    return _group(perf, by, total("TOTAL_PROFIT").alias("TOTAL_PROFIT"))


def gross_margin(perf, by=None):
    """DIVIDE(profit, revenue, 0): a ratio, not a percentage."""
    return _group(perf, by, divide(F.sum("TOTAL_PROFIT"), F.sum("TOTAL_REVENUE"), 0.0)
                  .alias("GROSS_MARGIN"))


def total_orders(perf, by=None):
    return _group(perf, by, F.sum("ORDER_COUNT").cast("bigint").alias("TOTAL_ORDERS"))


def total_units(perf, by=None):
    return _group(perf, by, F.sum("TOTAL_UNITS_SOLD").cast("bigint").alias("TOTAL_UNITS"))


# The time attributes of the mart. Within a comparison of periods only YEAR, QUARTER and MONTH
# name the period; the others are labels of it and take no part in joins or windows.
TIME_COLUMNS = ["YEAR", "QUARTER", "MONTH", "MONTH_NAME", "YEAR_QUARTER", "YEAR_MONTH"]


def _period(by: list[str]) -> list[str]:
    """The columns that name the finest period of a context: year, and quarter or month where given."""
    if {"MONTH", "MONTH_NAME", "YEAR_MONTH"} & set(by):
        return ["YEAR", "MONTH"]
    return ["YEAR", "QUARTER"] if {"QUARTER", "YEAR_QUARTER"} & set(by) else ["YEAR"]


def _others(by: list[str]) -> list[str]:
    return [c for c in by if c not in TIME_COLUMNS]


def yoy_revenue_growth(perf, by=None):
    """Revenue against the same period a year earlier (BLANK = NULL when none).

    The context must name the year. The period compared is its finest one (month, quarter or
    year), found by a join on (YEAR - 1, period, other columns), so missing months never
    shift the comparison and labels such as YEAR_MONTH do not prevent it.
    """
    by = _by(by) or ["YEAR", "MONTH"]
    if not {"YEAR", "YEAR_QUARTER", "YEAR_MONTH"} & set(by):
        raise ValueError("yoy_revenue_growth needs the year in the context")
    period = _period(by)
    keys = list(dict.fromkeys(by + period))
    cur = _group(perf, keys, total("TOTAL_REVENUE").alias("TOTAL_REVENUE"))
    prior = _group(perf, period + _others(by), total("TOTAL_REVENUE").alias("PRIOR_YEAR_REVENUE")).withColumn(
        "YEAR", F.col("YEAR") + 1)
    out = cur.join(prior, period + _others(by), "left")
    growth = F.when(F.col("PRIOR_YEAR_REVENUE").isNotNull() & (F.col("PRIOR_YEAR_REVENUE") != 0),
                    (F.col("TOTAL_REVENUE") - F.col("PRIOR_YEAR_REVENUE")).cast("double")
                    / F.col("PRIOR_YEAR_REVENUE").cast("double"))
    return out.select(*by, "TOTAL_REVENUE", "PRIOR_YEAR_REVENUE", growth.alias("YOY_REVENUE_GROWTH"))


def mom_revenue_growth(perf, by=None):
    """AVERAGE of the row-level MoM percentages (NULLs ignored)."""
    return _group(perf, by, mean("MOM_REVENUE_GROWTH_PCT").alias("MOM_REVENUE_GROWTH"))


def rolling_12m_revenue(perf, by=None):
    return _group(perf, by, mean("ROLLING_12M_REVENUE").alias("ROLLING_12M_REVENUE"))


def rolling_3m_profit(perf, by=None):
    return _group(perf, by, mean("ROLLING_3M_PROFIT").alias("ROLLING_3M_PROFIT"))


def _to_date(perf, by, period: list[str], out: str):
    """Running revenue within ``period`` (YEAR, or YEAR + QUARTER), ordered by MONTH.

    One row per month of the context; only ``period`` restarts the sum, whatever time
    attributes the context holds besides."""
    by = _by(by)
    keys = list(dict.fromkeys(by + period + ["MONTH"]))
    monthly = _group(perf, keys, total("TOTAL_REVENUE").alias("TOTAL_REVENUE"))
    part = _others(by) + period
    w = Window.partitionBy(*part).orderBy("MONTH").rowsBetween(Window.unboundedPreceding, 0)
    return monthly.select(*keys, "TOTAL_REVENUE", F.sum("TOTAL_REVENUE").over(w).cast(TOTAL).alias(out))


def ytd_revenue(perf, by=None):
    return _to_date(perf, by, ["YEAR"], "YTD_REVENUE")


def qtd_revenue(perf, by=None):
    return _to_date(perf, by, ["YEAR", "QUARTER"], "QTD_REVENUE")


def avg_revenue_per_order(perf, by=None):
    return _group(perf, by, divide(F.sum("TOTAL_REVENUE"), F.sum("ORDER_COUNT"), 0.0)
                  .alias("AVG_REVENUE_PER_ORDER"))


def avg_shipping_days(perf, by=None):
    """Unweighted mean of the mart rows' averages (as the measure is defined), to 6
    decimals: a sum of doubles depends on the order of addition in the last bits."""
    return _group(perf, by, F.round(mean("AVG_SHIPPING_DAYS"), 6).alias("AVG_SHIPPING_DAYS"))


def top_products(perf, by=None, n: int = TOP_N_PRODUCTS):
    """Dense rank of category revenue with the category filter removed: one row per
    (context, category), flagged when the rank is within ``n``."""
    by = [c for c in _by(by) if c != "PRODUCT_CATEGORY"]
    per_cat = _group(perf, by + ["PRODUCT_CATEGORY"], total("TOTAL_REVENUE").alias("TOTAL_REVENUE"))
    w = Window.partitionBy(*by).orderBy(F.col("TOTAL_REVENUE").desc()) if by else \
        Window.orderBy(F.col("TOTAL_REVENUE").desc())
    rank = F.dense_rank().over(w).cast("int")
    return per_cat.select(*by, "PRODUCT_CATEGORY", "TOTAL_REVENUE", rank.alias("REVENUE_RANK"),
                          (rank <= n).alias("IS_TOP_PRODUCT"))


def _share_of(perf, by, condition: Column, out: str):
    part = F.sum(F.when(condition, F.col("TOTAL_REVENUE")))
    return _group(perf, by, divide(F.coalesce(part, F.lit(0)), F.sum("TOTAL_REVENUE"), 0.0).alias(out))


def online_revenue_share(perf, by=None):
    return _share_of(perf, by, F.col("SALES_CHANNEL") == ONLINE_CHANNEL, "ONLINE_REVENUE_SHARE")


def critical_revenue_share(perf, by=None):
    return _share_of(perf, by, F.col("ORDER_PRIORITY") == CRITICAL_PRIORITY, "CRITICAL_REVENUE_SHARE")


def gross_margin_display(perf, by=None):
    return gross_margin(perf, by).select(
        *_by(by), format_percent(F.col("GROSS_MARGIN")).alias("GROSS_MARGIN_DISPLAY"))


def revenue_millions(perf, by=None):
    return total_revenue(perf, by).select(
        *_by(by), format_millions(F.col("TOTAL_REVENUE").cast("double")).alias("REVENUE_M"))


def mom_color(perf, by=None):
    """Green when the MoM measure is >= 0, red otherwise; BLANK counts as 0."""
    g = F.coalesce(F.col("MOM_REVENUE_GROWTH"), F.lit(0.0))
    return mom_revenue_growth(perf, by).select(
        *_by(by), "MOM_REVENUE_GROWTH",
        F.when(g >= 0, F.lit(MOM_COLOR_UP)).otherwise(F.lit(MOM_COLOR_DOWN)).alias("MOM_COLOR"))


def region_revenue_share(perf, by=None):
    """Revenue over the total with REGION removed from the context (other filters kept)."""
    by = _by(by)
    if "REGION" not in by:
        by = by + ["REGION"]
    grouped = _group(perf, by, total("TOTAL_REVENUE").alias("TOTAL_REVENUE"))
    others = [c for c in by if c != "REGION"]
    w = Window.partitionBy(*others) if others else Window.partitionBy(F.lit(1))
    return grouped.select(*by, "TOTAL_REVENUE",
                          divide(F.col("TOTAL_REVENUE"), F.sum("TOTAL_REVENUE").over(w), 0.0)
                          .alias("REGION_REVENUE_SHARE"))


MEASURES = {
    "M1": total_revenue, "M2": total_cost, "M3": total_profit, "M4": gross_margin,
    "M5": total_orders, "M6": total_units, "M7": yoy_revenue_growth, "M8": mom_revenue_growth,
    "M9": rolling_12m_revenue, "M10": rolling_3m_profit, "M11": ytd_revenue, "M12": qtd_revenue,
    "M13": avg_revenue_per_order, "M14": avg_shipping_days, "M15": top_products,
    "M16": online_revenue_share, "M17": gross_margin_display, "M18": revenue_millions,
    "M19": mom_color, "M20": region_revenue_share, "M21": critical_revenue_share,
}

# The drill paths of the suggested hierarchies.
GEOGRAPHY_PATH = ["REGION", "COUNTRY"]
TIME_PATH = ["YEAR", "YEAR_QUARTER", "YEAR_MONTH", "MONTH"]


def kpi_panel(perf, by=None) -> DataFrame:
    """Several measures for one context in a single aggregation pass."""
    return _group(
        perf, by,
        total("TOTAL_REVENUE").alias("TOTAL_REVENUE"),
        total("TOTAL_COST").alias("TOTAL_COST"),
        total("TOTAL_PROFIT").alias("TOTAL_PROFIT"),
        divide(F.sum("TOTAL_PROFIT"), F.sum("TOTAL_REVENUE"), 0.0).alias("GROSS_MARGIN"),
        F.sum("ORDER_COUNT").cast("bigint").alias("TOTAL_ORDERS"),
        F.sum("TOTAL_UNITS_SOLD").cast("bigint").alias("TOTAL_UNITS"),
        mean("MOM_REVENUE_GROWTH_PCT").alias("MOM_REVENUE_GROWTH"),
    )


def drill(perf, path: list[str], depth: int, measure=kpi_panel) -> DataFrame:
    """A measure at ``depth`` levels down a hierarchy path (1 = top level)."""
    return measure(perf, path[:depth])
