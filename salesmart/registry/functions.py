"""Scalar functions F1-F21, each applied to a real column of the model."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import oracle as O
from ..functions import dates as D
from ..functions.numeric import divide, format_millions, format_percent, pct
from ..plans import measures as MS
from ..schemas import AMOUNT
from .core import AS_OF, AS_OF_MINUS_30, W, _cnt_sql, _count_if, model, register


@register("f01_trim", W("SELECT DISTINCT TRIM(COUNTRY) AS COUNTRY_TRIMMED FROM raw_sales"))
def f01(spark, sf):
    return model(spark, sf).raw().select(F.trim("COUNTRY").alias("COUNTRY_TRIMMED")).distinct()


@register("f02_coalesce_sentinel", W(f"""
SELECT DISTINCT COALESCE(SHIP_DATE, {O.SENTINEL}) AS SHIP_DATE_OR_SENTINEL FROM raw_sales"""))
def f02(spark, sf):
    return (model(spark, sf).raw()
            .select(F.coalesce("SHIP_DATE", F.lit(D.SENTINEL_DATE).cast("date")).alias("SHIP_DATE_OR_SENTINEL"))
            .distinct())


@register("f03_nullif_ratio", W(f"""
SELECT PRODUCT_CATEGORY, SALES_CHANNEL,
       {O.pct_sql("SUM(TOTAL_PROFIT)", "SUM(TOTAL_REVENUE)")} AS MARGIN_PCT
FROM sales_performance GROUP BY PRODUCT_CATEGORY, SALES_CHANNEL"""))
def f03(spark, sf):
    return (model(spark, sf).perf().groupBy("PRODUCT_CATEGORY", "SALES_CHANNEL")
            .agg(pct(F.sum("TOTAL_PROFIT"), F.sum("TOTAL_REVENUE")).alias("MARGIN_PCT")))


@register("f04_round_line_total", W("""
SELECT order_id, CAST(ROUND(units_sold * unit_price, 2) AS DECIMAL(14,2)) AS LINE_TOTAL,
       CAST(ROUND(unit_price * 0.175, 2) AS DECIMAL(14,2)) AS PRICE_SHARE
FROM stg_sales"""))
def f04(spark, sf):
    s = model(spark, sf).stg()
    return s.select("order_id",
                    F.round(F.col("units_sold") * F.col("unit_price"), 2).cast(AMOUNT).alias("LINE_TOTAL"),
                    F.round(F.col("unit_price") * F.lit("0.175").cast("decimal(4,3)"), 2).cast(AMOUNT)
                    .alias("PRICE_SHARE"))


@register("f05_greatest", W("SELECT order_id, GREATEST(order_date, ship_date) AS LATEST_DATE FROM stg_sales"))
def f05(spark, sf):
    return model(spark, sf).stg().select("order_id", F.greatest("order_date", "ship_date").alias("LATEST_DATE"))


@register("f06_date_key", W("""
SELECT DISTINCT order_date, CAST(strftime(order_date, '%Y%m%d') AS INTEGER) AS ORDER_DATE_KEY FROM stg_sales"""))
def f06(spark, sf):
    return (model(spark, sf).stg()
            .select("order_date", D.date_key("order_date").alias("ORDER_DATE_KEY")).distinct())


@register("f07_month_name_padded", W("""
SELECT DISTINCT CAST(month(order_date) AS INTEGER) AS MONTH, rpad(monthname(order_date), 9, ' ') AS MONTH_NAME
FROM stg_sales"""))
def f07(spark, sf):
    s = model(spark, sf).stg()
    return s.select(F.month("order_date").cast("int").alias("MONTH"),
                    D.month_name("order_date").alias("MONTH_NAME")).distinct()


@register("f08_day_name_padded", W("""
SELECT DISTINCT CAST(dayofweek(ship_date) AS INTEGER) AS DAY_OF_WEEK, rpad(dayname(ship_date), 9, ' ') AS DAY_NAME
FROM stg_sales"""))
def f08(spark, sf):
    s = model(spark, sf).stg()
    return s.select(D.day_of_week("ship_date").alias("DAY_OF_WEEK"),
                    D.day_name("ship_date").alias("DAY_NAME")).distinct()


@register("f09_extract_parts", W("""
SELECT DISTINCT order_date, CAST(day(order_date) AS INTEGER) AS DAY, CAST(month(order_date) AS INTEGER) AS MONTH,
       CAST(quarter(order_date) AS INTEGER) AS QUARTER, CAST(year(order_date) AS INTEGER) AS YEAR
FROM stg_sales"""))
def f09(spark, sf):
    d = F.col("order_date")
    return model(spark, sf).stg().select(
        d, F.dayofmonth(d).cast("int").alias("DAY"), F.month(d).cast("int").alias("MONTH"),
        F.quarter(d).cast("int").alias("QUARTER"), F.year(d).cast("int").alias("YEAR")).distinct()


@register("f10_iso_week", W("""
SELECT DISTINCT ship_date, CAST(weekofyear(ship_date) AS INTEGER) AS WEEK_OF_YEAR FROM stg_sales"""))
def f10(spark, sf):
    return model(spark, sf).stg().select("ship_date", D.iso_week("ship_date").alias("WEEK_OF_YEAR")).distinct()


@register("f11_day_of_week", W("""
SELECT CAST(dayofweek(order_date) AS INTEGER) AS DAY_OF_WEEK, COUNT(*) AS ORDERS
FROM stg_sales GROUP BY 1"""))
def f11(spark, sf):
    return (model(spark, sf).stg().groupBy(D.day_of_week("order_date").alias("DAY_OF_WEEK"))
            .agg(F.count(F.lit(1)).alias("ORDERS")))


@register("f12_lpad_month", W("""
SELECT DISTINCT lpad(CAST(month(order_date) AS VARCHAR), 2, '0') AS MONTH_2 FROM stg_sales"""))
def f12(spark, sf):
    return (model(spark, sf).stg()
            .select(F.lpad(F.month("order_date").cast("string"), 2, "0").alias("MONTH_2")).distinct())


@register("f13_concat_periods", W("""
SELECT DISTINCT CAST(year(order_date) AS VARCHAR) || '-Q' || CAST(quarter(order_date) AS VARCHAR) AS YEAR_QUARTER,
       CAST(year(order_date) AS VARCHAR) || '-' || lpad(CAST(month(order_date) AS VARCHAR), 2, '0') AS YEAR_MONTH
FROM stg_sales"""))
def f13(spark, sf):
    return (model(spark, sf).stg()
            .select(D.year_quarter("order_date").alias("YEAR_QUARTER"),
                    D.year_month("order_date").alias("YEAR_MONTH")).distinct())


@register("f14_date_difference", W("""
SELECT order_id, CAST(ship_date - order_date AS INTEGER) AS SHIPPING_DAYS FROM stg_sales"""))
def f14(spark, sf):
    return model(spark, sf).stg().select(
        "order_id", F.datediff("ship_date", "order_date").cast("int").alias("SHIPPING_DAYS"))


@register("f15_as_of_interval", W(f"""
SELECT {_cnt_sql(f"order_date >= {AS_OF_MINUS_30}")} AS ORDERS_LAST_30_DAYS,
       {_cnt_sql(f"ship_date >= {AS_OF_MINUS_30}")} AS SHIPMENTS_LAST_30_DAYS
FROM stg_sales"""))
def f15(spark, sf):
    cut = F.date_sub(D.as_of_date(AS_OF), 30)
    return model(spark, sf).stg().agg(_count_if(F.col("order_date") >= cut).alias("ORDERS_LAST_30_DAYS"),
                                      _count_if(F.col("ship_date") >= cut).alias("SHIPMENTS_LAST_30_DAYS"))


@register("f16_decimal_arithmetic", W("""
SELECT order_id, CAST(units_sold * unit_price AS DECIMAL(14,2)) AS LINE_REVENUE,
       CAST(units_sold * unit_price - units_sold * unit_cost AS DECIMAL(14,2)) AS LINE_PROFIT
FROM stg_sales"""))
def f16(spark, sf):
    u, p, c = F.col("units_sold"), F.col("unit_price"), F.col("unit_cost")
    return model(spark, sf).stg().select(
        "order_id", (u * p).cast(AMOUNT).alias("LINE_REVENUE"), (u * p - u * c).cast(AMOUNT).alias("LINE_PROFIT"))


def _divide_sql(a: str, b: str, alt: str = "0.0") -> str:
    return f"(CASE WHEN ({b}) IS NULL OR ({b}) = 0 THEN {alt} ELSE CAST({a} AS DOUBLE) / CAST({b} AS DOUBLE) END)"


@register("f17_divide", W(f"""
SELECT REGION, {_divide_sql("SUM(TOTAL_REVENUE)", "SUM(ORDER_COUNT)")} AS REVENUE_PER_ORDER
FROM sales_performance GROUP BY REGION"""))
def f17(spark, sf):
    return (model(spark, sf).perf().groupBy("REGION")
            .agg(divide(F.sum("TOTAL_REVENUE"), F.sum("ORDER_COUNT"), 0.0).alias("REVENUE_PER_ORDER")))


def _tenths_sql(x: str, group: str) -> str:
    """``x`` as text with one decimal, halves away from zero: from whole tenths of a decimal."""
    tenths = f"CAST(ROUND(CAST({x} AS DECIMAL(30,10)) * 10, 0) AS BIGINT)"
    return (f"(CASE WHEN {tenths} < 0 THEN '-' ELSE '' END || format('{{{{:{group}}}}}', abs({tenths}) // 10) "
            f"|| '.' || CAST(abs({tenths}) % 10 AS VARCHAR))").replace("{{", "{").replace("}}", "}")


def _fmt_pct_sql(x: str) -> str:
    return f"(CASE WHEN {x} IS NULL THEN NULL ELSE {_tenths_sql(f'({x}) * 100', 'd')} || '%' END)"


def _fmt_millions_sql(x: str) -> str:
    return (f"(CASE WHEN {x} IS NULL THEN NULL ELSE {_tenths_sql(f'CAST({x} AS DOUBLE) / 1000000', ',')} "
            f"|| 'M' END)")


@register("f18_format_percent", W(f"""
SELECT REGION, {_fmt_pct_sql(_divide_sql("SUM(TOTAL_PROFIT)", "SUM(TOTAL_REVENUE)"))} AS MARGIN_DISPLAY
FROM sales_performance GROUP BY REGION"""))
def f18(spark, sf):
    return (model(spark, sf).perf().groupBy("REGION")
            .agg(format_percent(divide(F.sum("TOTAL_PROFIT"), F.sum("TOTAL_REVENUE"), 0.0))
                 .alias("MARGIN_DISPLAY")))


@register("f19_format_millions", W(f"""
SELECT COUNTRY, {_fmt_millions_sql("SUM(TOTAL_REVENUE)")} AS REVENUE_M
FROM sales_performance GROUP BY COUNTRY"""))
def f19(spark, sf):
    return (model(spark, sf).perf().groupBy("COUNTRY")
            .agg(format_millions(F.sum("TOTAL_REVENUE").cast("double")).alias("REVENUE_M")))


@register("f20_if_color", W(f"""
SELECT PRODUCT_CATEGORY, CASE WHEN COALESCE({O.mean_sql("MOM_REVENUE_GROWTH_PCT")}, 0) >= 0
       THEN '{MS.MOM_COLOR_UP}' ELSE '{MS.MOM_COLOR_DOWN}' END AS MOM_COLOR
FROM sales_performance GROUP BY PRODUCT_CATEGORY"""))
def f20(spark, sf):
    return MS.mom_color(model(spark, sf).perf(), ["PRODUCT_CATEGORY"]).select("PRODUCT_CATEGORY", "MOM_COLOR")


@register("f21_format_year_month", W("""
SELECT DISTINCT strftime(FULL_DATE, '%Y-%m') AS YEAR_MONTH FROM dim_date"""))
def f21(spark, sf):
    return model(spark, sf).dim_date().select(F.date_format("FULL_DATE", "yyyy-MM").alias("YEAR_MONTH")).distinct()

