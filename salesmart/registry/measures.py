"""Measures M1-M21 (each in one filter context), calendars D1, drill paths D2, reports R1-R5."""

from __future__ import annotations

from .. import oracle as O
from ..plans import measures as MS
from ..plans import reports as R
from .core import W, model, register
from .functions import _divide_sql, _fmt_millions_sql, _fmt_pct_sql

SP = "sales_performance"
REV = "CAST(SUM(TOTAL_REVENUE) AS DECIMAL(18,2))"


def _perf(spark, sf):
    return model(spark, sf).perf_shared()


def _measure(name: str, fn, by: list[str], sql: str):
    register(name, W(sql))(lambda spark, sf: fn(_perf(spark, sf), by))


def _grouped(by: list[str], select: str) -> str:
    cols = ", ".join(by)
    lead = f"{cols}, " if by else ""
    tail = f" GROUP BY {cols}" if by else ""
    return f"SELECT {lead}{select} FROM {SP}{tail}"


def _share_sql(cond: str) -> str:
    return _divide_sql(f"COALESCE(SUM(CASE WHEN {cond} THEN TOTAL_REVENUE END), 0)", "SUM(TOTAL_REVENUE)")


_measure("m01_total_revenue", MS.total_revenue, ["REGION"], _grouped(["REGION"], f"{REV} AS TOTAL_REVENUE"))
_measure("m02_total_cost", MS.total_cost, ["PRODUCT_CATEGORY"],
         _grouped(["PRODUCT_CATEGORY"], "CAST(SUM(TOTAL_COST) AS DECIMAL(18,2)) AS TOTAL_COST"))
_measure("m03_total_profit", MS.total_profit, ["YEAR"],
         _grouped(["YEAR"], "CAST(SUM(TOTAL_PROFIT) AS DECIMAL(18,2)) AS TOTAL_PROFIT"))
_measure("m04_gross_margin", MS.gross_margin, ["SALES_CHANNEL"],
         _grouped(["SALES_CHANNEL"], _divide_sql("SUM(TOTAL_PROFIT)", "SUM(TOTAL_REVENUE)") + " AS GROSS_MARGIN"))
_measure("m05_total_orders", MS.total_orders, ["ORDER_PRIORITY"],
         _grouped(["ORDER_PRIORITY"], "CAST(SUM(ORDER_COUNT) AS BIGINT) AS TOTAL_ORDERS"))
_measure("m06_total_units", MS.total_units, ["YEAR", "QUARTER"],
         _grouped(["YEAR", "QUARTER"], "CAST(SUM(TOTAL_UNITS_SOLD) AS BIGINT) AS TOTAL_UNITS"))
_measure("m07_yoy_revenue_growth", MS.yoy_revenue_growth, ["YEAR", "MONTH"], f"""
SELECT c.YEAR, c.MONTH, c.TOTAL_REVENUE, p.TOTAL_REVENUE AS PRIOR_YEAR_REVENUE,
       CASE WHEN p.TOTAL_REVENUE IS NOT NULL AND p.TOTAL_REVENUE <> 0
            THEN CAST(c.TOTAL_REVENUE - p.TOTAL_REVENUE AS DOUBLE) / CAST(p.TOTAL_REVENUE AS DOUBLE) END
            AS YOY_REVENUE_GROWTH
FROM (SELECT YEAR, MONTH, {REV} AS TOTAL_REVENUE FROM {SP} GROUP BY YEAR, MONTH) c
LEFT JOIN (SELECT YEAR, MONTH, {REV} AS TOTAL_REVENUE FROM {SP} GROUP BY YEAR, MONTH) p
  ON p.YEAR = c.YEAR - 1 AND p.MONTH = c.MONTH""")
_measure("m08_mom_revenue_growth", MS.mom_revenue_growth, ["PRODUCT_CATEGORY", "REGION"],
         _grouped(["PRODUCT_CATEGORY", "REGION"], f"{O.mean_sql('MOM_REVENUE_GROWTH_PCT')} AS MOM_REVENUE_GROWTH"))
_measure("m09_rolling_12m_revenue", MS.rolling_12m_revenue, ["PRODUCT_CATEGORY"],
         _grouped(["PRODUCT_CATEGORY"], f"{O.mean_sql('ROLLING_12M_REVENUE')} AS ROLLING_12M_REVENUE"))
_measure("m10_rolling_3m_profit", MS.rolling_3m_profit, ["REGION"],
         _grouped(["REGION"], f"{O.mean_sql('ROLLING_3M_PROFIT')} AS ROLLING_3M_PROFIT"))
_measure("m11_ytd_revenue", MS.ytd_revenue, ["REGION"], f"""
SELECT REGION, YEAR, MONTH, TOTAL_REVENUE,
       CAST(SUM(TOTAL_REVENUE) OVER (PARTITION BY REGION, YEAR ORDER BY MONTH
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DECIMAL(18,2)) AS YTD_REVENUE
FROM (SELECT REGION, YEAR, MONTH, {REV} AS TOTAL_REVENUE FROM {SP} GROUP BY REGION, YEAR, MONTH) m""")
_measure("m12_qtd_revenue", MS.qtd_revenue, [], f"""
SELECT YEAR, QUARTER, MONTH, TOTAL_REVENUE,
       CAST(SUM(TOTAL_REVENUE) OVER (PARTITION BY YEAR, QUARTER ORDER BY MONTH
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DECIMAL(18,2)) AS QTD_REVENUE
FROM (SELECT YEAR, QUARTER, MONTH, {REV} AS TOTAL_REVENUE FROM {SP} GROUP BY YEAR, QUARTER, MONTH) m""")
_measure("m13_avg_revenue_per_order", MS.avg_revenue_per_order, ["COUNTRY"],
         _grouped(["COUNTRY"], _divide_sql("SUM(TOTAL_REVENUE)", "SUM(ORDER_COUNT)") + " AS AVG_REVENUE_PER_ORDER"))
_measure("m14_avg_shipping_days", MS.avg_shipping_days, ["SALES_CHANNEL"],
         _grouped(["SALES_CHANNEL"], f"ROUND({O.mean_sql('AVG_SHIPPING_DAYS')}, 6) AS AVG_SHIPPING_DAYS"))
_measure("m15_top5_products", MS.top_products, [], f"""
SELECT PRODUCT_CATEGORY, TOTAL_REVENUE, REVENUE_RANK, REVENUE_RANK <= 5 AS IS_TOP_PRODUCT
FROM (SELECT PRODUCT_CATEGORY, TOTAL_REVENUE,
             CAST(DENSE_RANK() OVER (ORDER BY TOTAL_REVENUE DESC) AS INTEGER) AS REVENUE_RANK
      FROM (SELECT PRODUCT_CATEGORY, {REV} AS TOTAL_REVENUE FROM {SP} GROUP BY PRODUCT_CATEGORY) g) r""")
_measure("m16_online_revenue_share", MS.online_revenue_share, ["REGION"],
         _grouped(["REGION"], _share_sql(f"SALES_CHANNEL = '{MS.ONLINE_CHANNEL}'") + " AS ONLINE_REVENUE_SHARE"))
_measure("m17_gross_margin_display", MS.gross_margin_display, ["PRODUCT_CATEGORY"],
         _grouped(["PRODUCT_CATEGORY"],
                  _fmt_pct_sql(_divide_sql("SUM(TOTAL_PROFIT)", "SUM(TOTAL_REVENUE)")) + " AS GROSS_MARGIN_DISPLAY"))
_measure("m18_revenue_millions", MS.revenue_millions, ["YEAR"],
         _grouped(["YEAR"], _fmt_millions_sql(REV) + " AS REVENUE_M"))
_measure("m19_mom_color", MS.mom_color, ["REGION"], _grouped(["REGION"], f"""
{O.mean_sql('MOM_REVENUE_GROWTH_PCT')} AS MOM_REVENUE_GROWTH,
CASE WHEN COALESCE({O.mean_sql('MOM_REVENUE_GROWTH_PCT')}, 0) >= 0 THEN '{MS.MOM_COLOR_UP}'
     ELSE '{MS.MOM_COLOR_DOWN}' END AS MOM_COLOR"""))
_measure("m20_region_revenue_share", MS.region_revenue_share, ["YEAR"], f"""
SELECT YEAR, REGION, TOTAL_REVENUE,
       {_divide_sql("TOTAL_REVENUE", "SUM(TOTAL_REVENUE) OVER (PARTITION BY YEAR)")} AS REGION_REVENUE_SHARE
FROM (SELECT YEAR, REGION, {REV} AS TOTAL_REVENUE FROM {SP} GROUP BY YEAR, REGION) g""")
_measure("m21_critical_revenue_share", MS.critical_revenue_share, ["COUNTRY"],
         _grouped(["COUNTRY"], _share_sql(f"ORDER_PRIORITY = '{MS.CRITICAL_PRIORITY}'") + " AS CRITICAL_REVENUE_SHARE"))


# D1: full calendar over the data's years; D2: the two drill paths.

@register("d1_full_calendar", W(O.date_attrs_sql("""(
  SELECT CAST(unnest(generate_series(make_date(year(MIN(order_date)), 1, 1),
                                     make_date(year(MAX(order_date)), 12, 31), INTERVAL 1 DAY)) AS DATE) AS date_col
  FROM stg_sales) days""")))
def d1(spark, sf):
    return R.calendar_for_data(model(spark, sf).stg())


def _kpi_sql(by: list[str]) -> str:
    return _grouped(by, f"""{REV} AS TOTAL_REVENUE,
       CAST(SUM(TOTAL_COST) AS DECIMAL(18,2)) AS TOTAL_COST,
       CAST(SUM(TOTAL_PROFIT) AS DECIMAL(18,2)) AS TOTAL_PROFIT,
       {_divide_sql("SUM(TOTAL_PROFIT)", "SUM(TOTAL_REVENUE)")} AS GROSS_MARGIN,
       CAST(SUM(ORDER_COUNT) AS BIGINT) AS TOTAL_ORDERS,
       CAST(SUM(TOTAL_UNITS_SOLD) AS BIGINT) AS TOTAL_UNITS,
       {O.mean_sql('MOM_REVENUE_GROWTH_PCT')} AS MOM_REVENUE_GROWTH""")


for _depth in (1, 2):
    _by = MS.GEOGRAPHY_PATH[:_depth]
    register(f"d2_geography_drill_level{_depth}", W(_kpi_sql(_by)))(
        (lambda d: lambda spark, sf: MS.drill(_perf(spark, sf), MS.GEOGRAPHY_PATH, d))(_depth))
for _depth in (1, 2, 3, 4):
    _by = MS.TIME_PATH[:_depth]
    register(f"d2_time_drill_level{_depth}", W(_kpi_sql(_by)))(
        (lambda d: lambda spark, sf: MS.drill(_perf(spark, sf), MS.TIME_PATH, d))(_depth))

# The time measures at every level of the time path. The SQL looks each value up in the months of
# the mart by definition: the same period a year before, and all months since the period began.
_MONTHS = f"""months AS (SELECT YEAR, QUARTER, MONTH, YEAR_QUARTER, YEAR_MONTH, SUM(TOTAL_REVENUE) AS R
                 FROM {SP} GROUP BY YEAR, QUARTER, MONTH, YEAR_QUARTER, YEAR_MONTH)"""
_PERIOD = {1: "b.YEAR = a.YEAR - 1", 2: "b.YEAR = a.YEAR - 1 AND b.QUARTER = a.QUARTER",
           3: "b.YEAR = a.YEAR - 1 AND b.MONTH = a.MONTH", 4: "b.YEAR = a.YEAR - 1 AND b.MONTH = a.MONTH"}


def _yoy_sql(depth: int) -> str:
    by = MS.TIME_PATH[:depth]
    finest = {1: "", 2: ", QUARTER", 3: ", MONTH", 4: ""}[depth]
    return f"""
SELECT {", ".join(by)}, TOTAL_REVENUE, PRIOR_YEAR_REVENUE,
       CASE WHEN PRIOR_YEAR_REVENUE <> 0 THEN CAST(TOTAL_REVENUE - PRIOR_YEAR_REVENUE AS DOUBLE)
            / CAST(PRIOR_YEAR_REVENUE AS DOUBLE) END AS YOY_REVENUE_GROWTH
FROM (SELECT a.*, CAST((SELECT SUM(b.R) FROM months b WHERE {_PERIOD[depth]}) AS DECIMAL(18,2)) AS PRIOR_YEAR_REVENUE
      FROM (SELECT {", ".join(by)}{finest}, CAST(SUM(R) AS DECIMAL(18,2)) AS TOTAL_REVENUE FROM months
            GROUP BY {", ".join(by)}{finest}) a) c"""


def _since_sql(depth: int, period: str, out: str) -> str:
    columns = list(dict.fromkeys(MS.TIME_PATH[:depth] + (["YEAR", "QUARTER"] if "QUARTER" in period else ["YEAR"]) + ["MONTH"]))
    return f"""
SELECT {", ".join(columns)}, CAST(R AS DECIMAL(18,2)) AS TOTAL_REVENUE,
       CAST((SELECT SUM(b.R) FROM months b WHERE {period} AND b.MONTH <= a.MONTH) AS DECIMAL(18,2)) AS {out}
FROM months a"""


for _depth in (1, 2, 3, 4):
    for _key, _fn, _sql in (
            ("m07_yoy", MS.yoy_revenue_growth, _yoy_sql(_depth)),
            ("m11_ytd", MS.ytd_revenue, _since_sql(_depth, "b.YEAR = a.YEAR", "YTD_REVENUE")),
            ("m12_qtd", MS.qtd_revenue, _since_sql(_depth, "b.YEAR = a.YEAR AND b.QUARTER = a.QUARTER", "QTD_REVENUE"))):
        register(f"{_key}_time_drill_level{_depth}", W(_sql, extra_ctes=_MONTHS))(
            (lambda f, d: lambda spark, sf: f(_perf(spark, sf), MS.TIME_PATH[:d]))(_fn, _depth))


# R1-R5: report datasets.

@register("r1_executive_kpis", W(f"""
SELECT YEAR, MONTH, {REV} AS TOTAL_REVENUE, CAST(SUM(TOTAL_PROFIT) AS DECIMAL(18,2)) AS TOTAL_PROFIT,
       {_divide_sql("SUM(TOTAL_PROFIT)", "SUM(TOTAL_REVENUE)")} AS GROSS_MARGIN,
       {O.mean_sql('MOM_REVENUE_GROWTH_PCT')} AS MOM_REVENUE_GROWTH
FROM {SP} GROUP BY YEAR, MONTH"""))
def r1(spark, sf):
    return R.executive_kpis(_perf(spark, sf))


@register("r1_top_markets", W(f"""
SELECT COUNTRY, {REV} AS TOTAL_REVENUE FROM {SP} GROUP BY COUNTRY
ORDER BY TOTAL_REVENUE DESC, COUNTRY LIMIT 5"""))
def r1_top(spark, sf):
    return R.top_markets(_perf(spark, sf))


@register("r2_geographic", W(f"""
SELECT REGION, COUNTRY, TOTAL_REVENUE, TOTAL_PROFIT,
       {_divide_sql("TOTAL_PROFIT", "TOTAL_REVENUE")} AS GROSS_MARGIN,
       {_divide_sql("TOTAL_REVENUE", "SUM(TOTAL_REVENUE) OVER (PARTITION BY REGION)")} AS SHARE_OF_REGION
FROM (SELECT REGION, COUNTRY, {REV} AS TOTAL_REVENUE, CAST(SUM(TOTAL_PROFIT) AS DECIMAL(18,2)) AS TOTAL_PROFIT
      FROM {SP} GROUP BY REGION, COUNTRY) g"""))
def r2(spark, sf):
    return R.geographic(_perf(spark, sf))


@register("r3_product", W(f"""
SELECT PRODUCT_CATEGORY, {REV} AS TOTAL_REVENUE, CAST(SUM(TOTAL_PROFIT) AS DECIMAL(18,2)) AS TOTAL_PROFIT,
       {_divide_sql("SUM(TOTAL_PROFIT)", "SUM(TOTAL_REVENUE)")} AS GROSS_MARGIN,
       {_share_sql(f"SALES_CHANNEL = '{MS.ONLINE_CHANNEL}'")} AS ONLINE_SHARE
FROM {SP} GROUP BY PRODUCT_CATEGORY"""))
def r3(spark, sf):
    return R.product(_perf(spark, sf))


@register("r4_time_heatmap", W("SELECT YEAR, " + ", ".join(
    f"CAST(SUM(CASE WHEN MONTH = {m} THEN TOTAL_REVENUE END) AS DECIMAL(18,2)) AS M{m:02d}" for m in R.MONTHS)
    + f" FROM {SP} GROUP BY YEAR"))
def r4(spark, sf):
    return R.time_heatmap(_perf(spark, sf))


@register("r5_channel_priority", W(f"""
SELECT SALES_CHANNEL, ORDER_PRIORITY, PRIORITY_LABEL, TOTAL_REVENUE,
       {_divide_sql("TOTAL_REVENUE", "SUM(TOTAL_REVENUE) OVER ()")} AS SHARE_OF_TOTAL
FROM (SELECT SALES_CHANNEL, ORDER_PRIORITY, PRIORITY_LABEL, {REV} AS TOTAL_REVENUE
      FROM {SP} GROUP BY SALES_CHANNEL, ORDER_PRIORITY, PRIORITY_LABEL) g"""))
def r5(spark, sf):
    return R.channel_priority(_perf(spark, sf))

