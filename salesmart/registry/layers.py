"""Model layers, projections, joins, aggregates, windows, sorts and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import oracle as O
from ..functions import dates as D
from ..functions.numeric import mean, pct, total
from ..operators import quality as Q
from ..operators.dedup import duplicate_keys
from ..operators.joins import anti_join, checked_broadcast
from ..operators.upsert import above_watermark
from ..plans import dims as DM
from ..plans import measures as MS
from ..plans.fact import recent_slice
from ..plans.mart import aggregate_monthly, calendar_rolling
from ..plans.staging import build_staging, dedup_ordering, staging_base
from ..schemas import PERF_KEY
from ..sources.testdata import flawed_layers
from .core import (AS_OF, AS_OF_MINUS_30, AS_OF_SQL, ORACLE, W, X, _cnt_sql, _count_if, alias,
                   flawed, layers_of, model, register)


# =======================================================================================
# Model layers (T-*), S13 table scan, S18 BI read
# =======================================================================================

@register("s13_raw_sales", W("SELECT * FROM raw_sales"))
def s13_raw_sales(spark, sf):
    return model(spark, sf).raw()


@register("t_stg_sales", W("SELECT * FROM stg_sales"))
def t_stg_sales(spark, sf):
    return model(spark, sf).stg()


@register("t_dim_date", W("SELECT * FROM dim_date"))
def t_dim_date(spark, sf):
    return model(spark, sf).dim_date()


@register("t_dim_geography", W("SELECT * FROM dim_geography"))
def t_dim_geography(spark, sf):
    return model(spark, sf).dim_geography()


@register("t_dim_product", W("SELECT * FROM dim_product"))
def t_dim_product(spark, sf):
    return model(spark, sf).dim_product()


@register("t_dim_channel", W("SELECT * FROM dim_channel"))
def t_dim_channel(spark, sf):
    return model(spark, sf).dim_channel()


@register("t_dim_priority", W("SELECT * FROM dim_priority"))
def t_dim_priority(spark, sf):
    return model(spark, sf).dim_priority()


@register("t_fact_sales", W("SELECT * FROM fact_sales"))
def t_fact_sales(spark, sf):
    return model(spark, sf).fact()


@register("t_sales_performance", W("SELECT * FROM sales_performance"))
def t_sales_performance(spark, sf):
    return model(spark, sf).perf()


# The columns the BI semantic model reads from the mart.
SEMANTIC_COLUMNS = ["YEAR", "MONTH", "YEAR_MONTH", "YEAR_QUARTER", "REGION", "COUNTRY",
                    "PRODUCT_CATEGORY", "SALES_CHANNEL", "ORDER_PRIORITY", "PRIORITY_LABEL",
                    "ORDER_COUNT", "TOTAL_UNITS_SOLD", "TOTAL_REVENUE", "TOTAL_COST",
                    "TOTAL_PROFIT", "AVG_UNIT_PRICE", "AVG_SHIPPING_DAYS", "ROLLING_12M_REVENUE",
                    "ROLLING_3M_PROFIT", "MOM_REVENUE_GROWTH_PCT", "MONTHLY_REVENUE_RANK",
                    "MONTHLY_PROFIT_RANK"]


@register("s18_bi_read", W(f"SELECT {', '.join(SEMANTIC_COLUMNS)} FROM sales_performance"))
def s18_bi_read(spark, sf):
    """The semantic model's read of the written mart."""
    return model(spark, sf).perf_shared().select(*SEMANTIC_COLUMNS)


@register("s16_staging_view", W("SELECT * FROM stg_sales"))
def s16_staging_view(spark, sf):
    """S16: staging as a view. The plan is registered under a name, nothing is stored;
    every query on the name re-plans it from the raw table (filters and pruning reach
    the raw scan)."""
    build_staging(model(spark, sf).raw()).createOrReplaceTempView("stg_sales_view")
    return spark.sql("SELECT * FROM stg_sales_view")


# =======================================================================================
# P: projection and filter
# =======================================================================================

def _fact_source(stg: DataFrame) -> DataFrame:
    return stg.select("*", D.date_key("order_date").alias("order_date_key"),
                      D.date_key("ship_date").alias("ship_date_key"))


@register("p1_fact_source_projection", W("""
SELECT *, strftime(order_date, '%Y%m%d')::INTEGER AS order_date_key,
       strftime(ship_date, '%Y%m%d')::INTEGER AS ship_date_key FROM stg_sales"""))
def p1(spark, sf):
    return _fact_source(model(spark, sf).stg())


def ranked_base(raw: DataFrame) -> DataFrame:
    w = Window.partitionBy("order_id").orderBy(*dedup_ordering())
    return staging_base(raw).select("*", F.row_number().over(w).alias("row_num"))


@register("p2_ranked_staging_rows", W("SELECT * REPLACE (CAST(row_num AS INTEGER) AS row_num) FROM stg_ranked"))
def p2(spark, sf):
    return ranked_base(model(spark, sf).raw())


@register("p3_typed_base", W("SELECT * FROM stg_base"))
def p3(spark, sf):
    return staging_base(model(spark, sf).raw())


@register("p4_defaulted_values", X(f"""
SELECT {_cnt_sql("region = ''")} AS EMPTY_REGION, {_cnt_sql("country = ''")} AS EMPTY_COUNTRY,
       {_cnt_sql("item_type = ''")} AS EMPTY_ITEM_TYPE,
       {_cnt_sql(f"order_date = {O.SENTINEL}")} AS SENTINEL_ORDER_DATE,
       {_cnt_sql(f"ship_date = {O.SENTINEL}")} AS SENTINEL_SHIP_DATE,
       {_cnt_sql("order_id = 0")} AS ZERO_ORDER_ID, {_cnt_sql("units_sold = 0")} AS ZERO_UNITS,
       {_cnt_sql("unit_price = 0")} AS ZERO_UNIT_PRICE
FROM stg_base"""))
def p4(spark, sf):
    b = staging_base(flawed(spark, sf).raw())
    sentinel = F.lit(D.SENTINEL_DATE).cast("date")
    return b.agg(_count_if(F.col("region") == "").alias("EMPTY_REGION"),
                 _count_if(F.col("country") == "").alias("EMPTY_COUNTRY"),
                 _count_if(F.col("item_type") == "").alias("EMPTY_ITEM_TYPE"),
                 _count_if(F.col("order_date") == sentinel).alias("SENTINEL_ORDER_DATE"),
                 _count_if(F.col("ship_date") == sentinel).alias("SENTINEL_SHIP_DATE"),
                 _count_if(F.col("order_id") == 0).alias("ZERO_ORDER_ID"),
                 _count_if(F.col("units_sold") == 0).alias("ZERO_UNITS"),
                 _count_if(F.col("unit_price") == 0).alias("ZERO_UNIT_PRICE"))


@register("p5_staging_filter_effect", W(f"""
SELECT CAST(COUNT(*) AS BIGINT) AS RAW_ROWS, {_cnt_sql("row_num > 1")} AS DUPLICATES_DROPPED,
       {_cnt_sql("row_num = 1 AND order_id <= 0")} AS NONPOSITIVE_ID_DROPPED,
       {_cnt_sql(f"row_num = 1 AND order_id > 0 AND order_date <= {O.SENTINEL}")} AS NO_DATE_DROPPED,
       {_cnt_sql(f"row_num = 1 AND order_id > 0 AND order_date > {O.SENTINEL}")} AS STAGED_ROWS
FROM stg_ranked"""))
def p5(spark, sf):
    r = ranked_base(model(spark, sf).raw())
    first, pos = F.col("row_num") == 1, F.col("order_id") > 0
    dated = F.col("order_date") > F.lit(D.SENTINEL_DATE).cast("date")
    return r.agg(F.count(F.lit(1)).cast("bigint").alias("RAW_ROWS"),
                 _count_if(F.col("row_num") > 1).alias("DUPLICATES_DROPPED"),
                 _count_if(first & ~pos).alias("NONPOSITIVE_ID_DROPPED"),
                 _count_if(first & pos & ~dated).alias("NO_DATE_DROPPED"),
                 _count_if(first & pos & dated).alias("STAGED_ROWS"))


@register("p6_missing_natural_keys", X(f"""
SELECT {_cnt_sql("region IS NULL OR region = ''")} AS MISSING_REGION,
       {_cnt_sql("country IS NULL OR country = ''")} AS MISSING_COUNTRY,
       {_cnt_sql("item_type IS NULL OR item_type = ''")} AS MISSING_ITEM_TYPE,
       {_cnt_sql("sales_channel IS NULL OR sales_channel = ''")} AS MISSING_SALES_CHANNEL,
       {_cnt_sql("order_priority IS NULL OR order_priority = ''")} AS MISSING_ORDER_PRIORITY
FROM stg_sales"""))
def p6(spark, sf):
    s = flawed(spark, sf).stg()
    miss = lambda c: F.col(c).isNull() | (F.col(c) == "")
    return s.agg(*[_count_if(miss(c)).alias(f"MISSING_{c.upper()}")
                   for c in ["region", "country", "item_type", "sales_channel", "order_priority"]])


@register("p7_priority_case", W("""
SELECT order_priority AS ORDER_PRIORITY,
       CASE order_priority WHEN 'C' THEN 'Critical' WHEN 'H' THEN 'High' WHEN 'M' THEN 'Medium'
            WHEN 'L' THEN 'Low' ELSE order_priority END AS PRIORITY_LABEL,
       CAST(CASE order_priority WHEN 'C' THEN 1 WHEN 'H' THEN 2 WHEN 'M' THEN 3 WHEN 'L' THEN 4
            ELSE 99 END AS INTEGER) AS PRIORITY_SORT_ORDER,
       COUNT(*) AS ORDERS
FROM stg_sales GROUP BY 1, 2, 3"""))
def p7(spark, sf):
    p = F.col("order_priority")
    return (model(spark, sf).stg()
            .groupBy(p.alias("ORDER_PRIORITY"), DM.priority_label(p).alias("PRIORITY_LABEL"),
                     DM.priority_sort(p).alias("PRIORITY_SORT_ORDER"))
            .agg(F.count(F.lit(1)).alias("ORDERS")))


@register("p8_weekend_orders", W("""
SELECT IS_WEEKEND, COUNT(*) AS ORDERS, CAST(SUM(TOTAL_REVENUE) AS DECIMAL(18,2)) AS TOTAL_REVENUE
FROM enriched GROUP BY IS_WEEKEND"""))
def p8(spark, sf):
    return (model(spark, sf).enriched().groupBy("IS_WEEKEND")
            .agg(F.count(F.lit(1)).alias("ORDERS"), total("TOTAL_REVENUE").alias("TOTAL_REVENUE")))


@register("p9_orders_dropped_by_star_join", X("""
SELECT COUNT(*) AS DROPPED_ORDERS FROM stg_sales s
WHERE NOT EXISTS (SELECT 1 FROM fact_sales f WHERE f.ORDER_ID = s.order_id)"""))
def p9(spark, sf):
    m = flawed(spark, sf)
    dropped = m.stg().join(m.fact().select(F.col("ORDER_ID").alias("order_id")), "order_id", "left_anti")
    return dropped.agg(F.count(F.lit(1)).alias("DROPPED_ORDERS"))


@register("p10_raw_totals_inconsistent", X(f"""
SELECT {_cnt_sql(O.identity_broken_sql())} AS FAILING_ROWS, CAST(COUNT(*) AS BIGINT) AS CHECKED_ROWS
FROM raw_sales"""))
def p10(spark, sf):
    raw = flawed(spark, sf).raw()
    u = F.col("UNITS_SOLD")
    ok = ((F.round("TOTAL_REVENUE", 2) == F.round(u * F.col("UNIT_PRICE"), 2))
          & (F.round("TOTAL_COST", 2) == F.round(u * F.col("UNIT_COST"), 2))
          & (F.round("TOTAL_PROFIT", 2) == F.round(F.col("TOTAL_REVENUE") - F.col("TOTAL_COST"), 2)))
    return raw.agg(_count_if(~ok).alias("FAILING_ROWS"), F.count(F.lit(1)).cast("bigint").alias("CHECKED_ROWS"))


@register("p11_recent_orders", W(f"""
SELECT * FROM stg_sales WHERE GREATEST(order_date, ship_date) >= {AS_OF_MINUS_30}"""))
def p11(spark, sf):
    return recent_slice(model(spark, sf).stg(), AS_OF, 30)


@register("p12_recent_fact_rows", W(f"""
SELECT * FROM fact_sales
WHERE ORDER_DATE_KEY >= CAST(strftime({AS_OF_MINUS_30}, '%Y%m%d') AS INTEGER)"""))
def p12(spark, sf):
    return model(spark, sf).fact().where(F.col("ORDER_DATE_KEY") >= D.days_before_key(AS_OF, 30))


@register("p13_dates_above_watermark")
def p13(spark, sf):
    s = flawed(spark, sf).stg()
    first = s.where(F.col("order_date") <= D.as_of_date(AS_OF))
    existing = DM.date_spine(first).select(F.col("date_col").alias("FULL_DATE"))
    return above_watermark(DM.date_spine(s), "date_col", existing, "FULL_DATE")


ORACLE["p13_dates_above_watermark"] = X(f"""
SELECT date_col FROM date_spine
WHERE date_col > (SELECT COALESCE(MAX(FULL_DATE), DATE '1900-01-01') FROM existing_dates)""",
    extra_ctes=f"""
first_load AS (SELECT * FROM stg_sales WHERE order_date <= {AS_OF_SQL}),
existing_dates AS (
  SELECT order_date AS FULL_DATE FROM first_load UNION SELECT ship_date FROM first_load)""")


# =======================================================================================
# J: joins
# =======================================================================================

@register("j1_product_lookup", W("""
SELECT s.order_id, s.item_type, dp.PRODUCT_ID FROM stg_sales s
LEFT JOIN dim_product dp ON s.item_type = dp.PRODUCT_CATEGORY"""))
def j1(spark, sf):
    m = model(spark, sf)
    dp = checked_broadcast(m.dim_product())
    s = m.stg()
    return s.join(dp, s.item_type == dp.PRODUCT_CATEGORY, "left").select("order_id", "item_type", "PRODUCT_ID")


@register("j2_geography_lookup", W("""
SELECT s.order_id, s.region, s.country, dg.GEOGRAPHY_ID FROM stg_sales s
LEFT JOIN dim_geography dg ON s.country = dg.COUNTRY AND s.region = dg.REGION"""))
def j2(spark, sf):
    m = model(spark, sf)
    dg = checked_broadcast(m.dim_geography())
    s = m.stg()
    return (s.join(dg, (s.country == dg.COUNTRY) & (s.region == dg.REGION), "left")
            .select(s.order_id, s.region, s.country, dg.GEOGRAPHY_ID))


@register("j3_role_playing_dates", W("""
SELECT f.ORDER_ID, o.YEAR_MONTH AS ORDER_YEAR_MONTH, o.IS_WEEKEND AS ORDER_ON_WEEKEND,
       s.YEAR_MONTH AS SHIP_YEAR_MONTH, s.IS_WEEKEND AS SHIP_ON_WEEKEND
FROM fact_sales f JOIN dim_date o ON f.ORDER_DATE_KEY = o.DATE_KEY
JOIN dim_date s ON f.SHIP_DATE_KEY = s.DATE_KEY"""))
def j3(spark, sf):
    m = model(spark, sf)
    dd = m.dim_date()
    o = checked_broadcast(dd.select(F.col("DATE_KEY").alias("_ok"), F.col("YEAR_MONTH").alias("ORDER_YEAR_MONTH"),
                                    F.col("IS_WEEKEND").alias("ORDER_ON_WEEKEND")))
    s = checked_broadcast(dd.select(F.col("DATE_KEY").alias("_sk"), F.col("YEAR_MONTH").alias("SHIP_YEAR_MONTH"),
                                    F.col("IS_WEEKEND").alias("SHIP_ON_WEEKEND")))
    f = m.fact()
    return (f.join(o, f.ORDER_DATE_KEY == o._ok).join(s, f.SHIP_DATE_KEY == s._sk)
            .select("ORDER_ID", "ORDER_YEAR_MONTH", "ORDER_ON_WEEKEND", "SHIP_YEAR_MONTH", "SHIP_ON_WEEKEND"))


alias("j4_star_join_fact", "t_fact_sales")


@register("j5_mart_star_join", W("SELECT * FROM enriched"))
def j5(spark, sf):
    return model(spark, sf).enriched()


@register("j6_orphan_product_fk", X("""
SELECT COUNT(*) AS ORPHANS FROM x_fact_sales f LEFT JOIN dim_product p ON f.PRODUCT_ID = p.PRODUCT_ID
WHERE p.PRODUCT_ID IS NULL"""))
def j6(spark, sf):
    m = flawed(spark, sf)
    f = flawed_layers(layers_of(m))["fact_sales"]
    orphans = anti_join(f, m.dim_product(), "PRODUCT_ID", "PRODUCT_ID").select("PRODUCT_ID") \
        .unionByName(f.where(F.col("PRODUCT_ID").isNull()).select("PRODUCT_ID"))
    return orphans.agg(F.count(F.lit(1)).alias("ORPHANS"))


REL_SQL = " UNION ALL ".join(
    f"""SELECT '{t.name}' AS TEST_NAME, '{t.model}' AS MODEL, '{t.column}' AS COLUMN_NAME,
       'relationships' AS KIND, CAST(COUNT(*) AS BIGINT) AS FAILURES
FROM x_{t.model} c WHERE c.{t.column} IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM x_{t.parent} p WHERE p.{t.parent_column} = c.{t.column})"""
    for t in Q.DECLARED_TESTS if t.kind == "relationships")


@register("j7_relationship_tests", X(f"SELECT *, FAILURES = 0 AS PASSED FROM ({REL_SQL}) r"))
def j7(spark, sf):
    return Q.run_data_tests(flawed_layers(layers_of(flawed(spark, sf))), kinds={"relationships"})


# =======================================================================================
# A: aggregation and distinct
# =======================================================================================

@register("a1_group_by_13", W("SELECT * FROM aggregated"))
def a1(spark, sf):
    return aggregate_monthly(model(spark, sf).enriched())


@register("a2_count_distinct_orders", W("""
SELECT YEAR, MONTH, COUNT(DISTINCT ORDER_ID) AS ORDER_COUNT FROM enriched GROUP BY YEAR, MONTH"""))
def a2(spark, sf):
    return model(spark, sf).enriched().groupBy("YEAR", "MONTH").agg(F.countDistinct("ORDER_ID").alias("ORDER_COUNT"))


@register("a3_sums_by_region", W("""
SELECT REGION, CAST(SUM(UNITS_SOLD) AS BIGINT) AS TOTAL_UNITS_SOLD,
       CAST(SUM(TOTAL_REVENUE) AS DECIMAL(18,2)) AS TOTAL_REVENUE,
       CAST(SUM(TOTAL_COST) AS DECIMAL(18,2)) AS TOTAL_COST,
       CAST(SUM(TOTAL_PROFIT) AS DECIMAL(18,2)) AS TOTAL_PROFIT
FROM enriched GROUP BY REGION"""))
def a3(spark, sf):
    return model(spark, sf).enriched().groupBy("REGION").agg(
        F.sum("UNITS_SOLD").cast("bigint").alias("TOTAL_UNITS_SOLD"),
        total("TOTAL_REVENUE").alias("TOTAL_REVENUE"), total("TOTAL_COST").alias("TOTAL_COST"),
        total("TOTAL_PROFIT").alias("TOTAL_PROFIT"))


@register("a4_averages_by_category", W(f"""
SELECT PRODUCT_CATEGORY, {O.mean_sql("UNIT_PRICE")} AS AVG_UNIT_PRICE,
       {O.mean_sql("UNIT_COST")} AS AVG_UNIT_COST, {O.mean_sql("SHIPPING_DAYS")} AS AVG_SHIPPING_DAYS
FROM enriched GROUP BY PRODUCT_CATEGORY"""))
def a4(spark, sf):
    return model(spark, sf).enriched().groupBy("PRODUCT_CATEGORY").agg(
        mean("UNIT_PRICE").alias("AVG_UNIT_PRICE"), mean("UNIT_COST").alias("AVG_UNIT_COST"),
        mean("SHIPPING_DAYS").alias("AVG_SHIPPING_DAYS"))


@register("a5_margin_pct_by_year", W(f"""
SELECT YEAR, {O.pct_sql("SUM(TOTAL_PROFIT)", "SUM(TOTAL_REVENUE)")} AS GROSS_MARGIN_PCT
FROM enriched GROUP BY YEAR"""))
def a5(spark, sf):
    return model(spark, sf).enriched().groupBy("YEAR").agg(
        pct(F.sum("TOTAL_PROFIT"), F.sum("TOTAL_REVENUE")).alias("GROSS_MARGIN_PCT"))


@register("a6_select_distinct", W("""
SELECT DISTINCT region, country FROM stg_sales
WHERE region IS NOT NULL AND region <> '' AND country IS NOT NULL AND country <> ''"""))
def a6(spark, sf):
    return DM.geography_keys(model(spark, sf).stg())


@register("a7_global_counts", W("""
SELECT (SELECT COUNT(*) FROM raw_sales) AS RAW_ROWS, (SELECT COUNT(*) FROM stg_sales) AS STG_ROWS,
       (SELECT COUNT(*) FROM fact_sales) AS FACT_ROWS,
       (SELECT COUNT(*) FROM sales_performance) AS PERF_ROWS"""))
def a7(spark, sf):
    m = model(spark, sf)
    counts = [m.raw().agg(F.count(F.lit(1)).alias("RAW_ROWS")),
              m.stg().agg(F.count(F.lit(1)).alias("STG_ROWS")),
              m.fact().agg(F.count(F.lit(1)).alias("FACT_ROWS")),
              aggregate_monthly(m.enriched()).agg(F.count(F.lit(1)).alias("PERF_ROWS"))]
    out = counts[0]
    for c in counts[1:]:
        out = out.crossJoin(c)  # one-row aggregates
    return out


RAW_CHECKED = ["ORDER_ID", "REGION", "COUNTRY", "ITEM_TYPE", "SALES_CHANNEL", "ORDER_PRIORITY",
               "ORDER_DATE", "SHIP_DATE", "UNITS_SOLD", "UNIT_PRICE", "UNIT_COST"]
A8_SQL = "SELECT " + ", ".join(f"{_cnt_sql(f'{c} IS NULL')} AS NULL_{c}" for c in RAW_CHECKED) + " FROM raw_sales"


@register("a8_conditional_null_counts", X(A8_SQL))
def a8(spark, sf):
    return flawed(spark, sf).raw().agg(*[_count_if(F.col(c).isNull()).alias(f"NULL_{c}") for c in RAW_CHECKED])


@register("a9_scalar_max", W("""
SELECT (SELECT MAX(FULL_DATE) FROM dim_date) AS MAX_FULL_DATE,
       (SELECT MAX(order_date) FROM stg_sales) AS MAX_ORDER_DATE,
       (SELECT MAX(_ingested_at) FROM raw_sales) AS MAX_INGESTED_AT"""))
def a9(spark, sf):
    m = model(spark, sf)
    return m.dim_date().agg(F.max("FULL_DATE").alias("MAX_FULL_DATE")).select(
        "MAX_FULL_DATE",
        m.stg().agg(F.max("order_date")).scalar().alias("MAX_ORDER_DATE"),
        m.raw().agg(F.max("_ingested_at")).scalar().alias("MAX_INGESTED_AT"))


@register("a10_duplicate_order_ids", W("""
SELECT ORDER_ID, COUNT(*) AS N_ROWS FROM raw_sales GROUP BY ORDER_ID HAVING COUNT(*) >= 2"""))
def a10(spark, sf):
    return duplicate_keys(model(spark, sf).raw(), ["ORDER_ID"])


# =======================================================================================
# W: windows
# =======================================================================================

alias("w1_dedup_latest_per_order", "t_stg_sales")
alias("w2_surrogate_ids", "t_dim_geography")

KEY_SQL = ", ".join(PERF_KEY)


def _perf_cols(spark, sf, *cols):
    return model(spark, sf).perf().select(*PERF_KEY, *cols)


@register("w3_rolling_12_rows", W(f"SELECT {KEY_SQL}, TOTAL_REVENUE, ROLLING_12M_REVENUE FROM sales_performance"))
def w3(spark, sf):
    return _perf_cols(spark, sf, "TOTAL_REVENUE", "ROLLING_12M_REVENUE")


@register("w4_rolling_3_rows", W(f"SELECT {KEY_SQL}, TOTAL_PROFIT, ROLLING_3M_PROFIT FROM sales_performance"))
def w4(spark, sf):
    return _perf_cols(spark, sf, "TOTAL_PROFIT", "ROLLING_3M_PROFIT")


@register("w5_lag_growth_pct", W(f"SELECT {KEY_SQL}, TOTAL_REVENUE, MOM_REVENUE_GROWTH_PCT FROM sales_performance"))
def w5(spark, sf):
    return _perf_cols(spark, sf, "TOTAL_REVENUE", "MOM_REVENUE_GROWTH_PCT")


@register("w6_monthly_revenue_rank", W(f"SELECT {KEY_SQL}, TOTAL_REVENUE, MONTHLY_REVENUE_RANK FROM sales_performance"))
def w6(spark, sf):
    return _perf_cols(spark, sf, "TOTAL_REVENUE", "MONTHLY_REVENUE_RANK")


@register("w7_monthly_profit_rank", W(f"SELECT {KEY_SQL}, TOTAL_PROFIT, MONTHLY_PROFIT_RANK FROM sales_performance"))
def w7(spark, sf):
    return _perf_cols(spark, sf, "TOTAL_PROFIT", "MONTHLY_PROFIT_RANK")


def _calendar_sql(value: str, by: str, months: int, out: str) -> str:
    return W(f"""
SELECT {by}, YEAR, MONTH, CAST(SUM(v) OVER (PARTITION BY {by} ORDER BY idx
       RANGE BETWEEN {months - 1} PRECEDING AND CURRENT ROW) AS DECIMAL(18,2)) AS {out}
FROM (SELECT {by}, YEAR, MONTH, SUM({value}) AS v, YEAR * 12 + MONTH - 1 AS idx
      FROM aggregated GROUP BY {by}, YEAR, MONTH) m""")


@register("w8_calendar_rolling_12m_revenue",
          _calendar_sql("TOTAL_REVENUE", "PRODUCT_CATEGORY", 12, "CAL_ROLLING_12M_REVENUE"))
def w8a(spark, sf):
    return calendar_rolling(aggregate_monthly(model(spark, sf).enriched()), "TOTAL_REVENUE",
                            "PRODUCT_CATEGORY", 12, "CAL_ROLLING_12M_REVENUE")


@register("w8_calendar_rolling_3m_profit",
          _calendar_sql("TOTAL_PROFIT", "REGION", 3, "CAL_ROLLING_3M_PROFIT"))
def w8b(spark, sf):
    return calendar_rolling(aggregate_monthly(model(spark, sf).enriched()), "TOTAL_PROFIT",
                            "REGION", 3, "CAL_ROLLING_3M_PROFIT")


# =======================================================================================
# O: sort, limit, top-k; U: set operations
# =======================================================================================

@register("o1_sorted_mart", W("SELECT * FROM sales_performance ORDER BY YEAR, MONTH, PRODUCT_CATEGORY, REGION"))
def o1(spark, sf):
    return model(spark, sf).perf().orderBy("YEAR", "MONTH", "PRODUCT_CATEGORY", "REGION")


@register("o2_duplicate_finder_limit", W("""
SELECT ORDER_ID, COUNT(*) AS N_ROWS FROM raw_sales GROUP BY ORDER_ID HAVING COUNT(*) > 1
ORDER BY N_ROWS DESC, ORDER_ID LIMIT 20"""))
def o2(spark, sf):
    """The diagnostic's first 20 duplicated ids (the limit is the feature), most copies first."""
    return (duplicate_keys(model(spark, sf).raw(), ["ORDER_ID"])
            .orderBy(F.col("N_ROWS").desc(), "ORDER_ID").limit(20))


@register("o3_top5_products_per_year", W("""
SELECT * FROM (
  SELECT YEAR, PRODUCT_CATEGORY, TOTAL_REVENUE,
         CAST(DENSE_RANK() OVER (PARTITION BY YEAR ORDER BY TOTAL_REVENUE DESC) AS INTEGER) AS REVENUE_RANK
  FROM (SELECT YEAR, PRODUCT_CATEGORY, CAST(SUM(TOTAL_REVENUE) AS DECIMAL(18,2)) AS TOTAL_REVENUE
        FROM sales_performance GROUP BY YEAR, PRODUCT_CATEGORY) g) r
WHERE REVENUE_RANK <= 5"""))
def o3(spark, sf):
    t = MS.top_products(model(spark, sf).perf(), ["YEAR"])
    return t.where("IS_TOP_PRODUCT").select("YEAR", "PRODUCT_CATEGORY", "TOTAL_REVENUE", "REVENUE_RANK")


@register("o4_top5_markets", W("""
SELECT COUNTRY, CAST(SUM(TOTAL_REVENUE) AS DECIMAL(18,2)) AS TOTAL_REVENUE FROM sales_performance
GROUP BY COUNTRY ORDER BY TOTAL_REVENUE DESC, COUNTRY LIMIT 5"""))
def o4(spark, sf):
    return (model(spark, sf).perf().groupBy("COUNTRY").agg(total("TOTAL_REVENUE").alias("TOTAL_REVENUE"))
            .orderBy(F.col("TOTAL_REVENUE").desc(), "COUNTRY").limit(5))


@register("u1_date_union", W("SELECT * FROM date_spine"))
def u1(spark, sf):
    return DM.date_spine(model(spark, sf).stg())
