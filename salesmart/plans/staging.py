"""``stg_sales``: typed, trimmed, defaulted and deduplicated view of ``raw.sales``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import SENTINEL_DATE
from ..operators.dedup import first_per_key
from ..schemas import AMOUNT, PRICE

# Dedup order: latest order date first (the defined rule), then every other column so
# equal dates pick the same row in every engine and on every run (fixed values).
DEDUP_ORDER = [
    ("order_date", "desc"), ("ship_date", "desc"), ("units_sold", "desc"),
    ("unit_price", "desc"), ("unit_cost", "desc"),
    ("item_type", "asc"), ("region", "asc"), ("country", "asc"),
    ("sales_channel", "asc"), ("order_priority", "asc"),
    ("total_revenue", "desc"), ("total_cost", "desc"), ("total_profit", "desc"),
]


def dedup_ordering() -> list:
    return [F.col(c).desc() if d == "desc" else F.col(c).asc() for c, d in DEDUP_ORDER]


def staging_base(raw: DataFrame) -> DataFrame:
    """Typed and defaulted rows, one per raw row (before dedup)."""
    sentinel = F.lit(SENTINEL_DATE).cast("date")
    return raw.select(
        F.coalesce(F.trim("REGION"), F.lit("")).alias("region"),
        F.coalesce(F.trim("COUNTRY"), F.lit("")).alias("country"),
        F.coalesce(F.trim("ITEM_TYPE"), F.lit("")).alias("item_type"),
        F.coalesce(F.trim("SALES_CHANNEL"), F.lit("")).alias("sales_channel"),
        F.coalesce(F.trim("ORDER_PRIORITY"), F.lit("")).alias("order_priority"),
        F.coalesce(F.col("ORDER_DATE").cast("date"), sentinel).alias("order_date"),
        F.coalesce(F.col("ORDER_ID").cast("bigint"), F.lit(0).cast("bigint")).alias("order_id"),
        F.coalesce(F.col("SHIP_DATE").cast("date"), sentinel).alias("ship_date"),
        F.coalesce(F.col("UNITS_SOLD").cast("int"), F.lit(0)).alias("units_sold"),
        F.coalesce(F.col("UNIT_PRICE").cast(PRICE), F.lit(0).cast(PRICE)).alias("unit_price"),
        F.coalesce(F.col("UNIT_COST").cast(PRICE), F.lit(0).cast(PRICE)).alias("unit_cost"),
        F.coalesce(F.col("TOTAL_REVENUE").cast(AMOUNT), F.lit(0).cast(AMOUNT)).alias("total_revenue"),
        F.coalesce(F.col("TOTAL_COST").cast(AMOUNT), F.lit(0).cast(AMOUNT)).alias("total_cost"),
        F.coalesce(F.col("TOTAL_PROFIT").cast(AMOUNT), F.lit(0).cast(AMOUNT)).alias("total_profit"),
    )


def staged_rows(raw: DataFrame) -> DataFrame:
    """Typed rows with a positive order id and a real order date, before dedup.

    Both filters run before the dedup: the id filter is on the dedup key, and the kept
    row always carries the latest order date of its id, so an id whose latest date is
    the sentinel is exactly an id whose every row has it. Filtering first shrinks the
    shuffle and gives the same rows as filtering after.
    """
    return staging_base(raw).where(
        (F.col("order_id") > 0) & (F.col("order_date") > F.lit(SENTINEL_DATE).cast("date")))


def _less_expected(rows: DataFrame) -> DataFrame:
    """Totals as what they differ by from what units and prices make, so that agreeing ones are zero.

    The differences are exact, and among rows of equal units and prices they order like the totals.
    """
    units, revenue, cost = F.col("units_sold"), F.col("total_revenue"), F.col("total_cost")
    return rows.withColumns({"total_revenue": revenue - units * F.col("unit_price"),
                             "total_cost": cost - units * F.col("unit_cost"),
                             "total_profit": F.col("total_profit") - (revenue - cost)})


def _plus_expected(rows: DataFrame) -> DataFrame:
    """The totals again."""
    units, revenue, cost = F.col("units_sold"), F.col("total_revenue"), F.col("total_cost")
    summed = rows.withColumns({"total_revenue": (revenue + units * F.col("unit_price")).cast(AMOUNT),
                               "total_cost": (cost + units * F.col("unit_cost")).cast(AMOUNT)})
    return summed.withColumn("total_profit", (F.col("total_profit") + (revenue - cost)).cast(AMOUNT))


def build_staging(raw: DataFrame) -> DataFrame:
    """One row per positive order id with a real order date.

    The dedup's shuffle is the widest of the model, so totals are sent as differences, which are zero
    (and compress to nothing) wherever a row's totals agree with its units and prices.
    """
    return _plus_expected(first_per_key(_less_expected(staged_rows(raw)), ["order_id"], dedup_ordering()))
