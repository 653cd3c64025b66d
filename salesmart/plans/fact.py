"""``fact_sales``: one row per staged order with the six dimension keys.

The left joins plus ``IS NOT NULL`` on every looked-up key are an inner star join;
Catalyst rewrites them as such. Dimensions are joined with ``checked_broadcast``, so
the large side is streamed once through chained broadcast hash joins and never
shuffled while every dimension stays under the checked size.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates as D
from ..operators.joins import checked_broadcast
from ..schemas import FACT_AMOUNT

# Partition column of the stored fact: the month (yyyymm) of the order date.
PART_COL = "ORDER_MONTH_KEY"

FACT_COLUMNS = ["ORDER_ID", "UNITS_SOLD", "UNIT_PRICE", "UNIT_COST", "TOTAL_REVENUE",
                "TOTAL_COST", "TOTAL_PROFIT", "PRODUCT_ID", "GEOGRAPHY_ID", "CHANNEL_ID",
                "PRIORITY_ID", "ORDER_DATE_KEY", "SHIP_DATE_KEY", "SHIPPING_DAYS"]


def recent_slice(stg: DataFrame, as_of: str | _dt.date | None, days: int = 30) -> DataFrame:
    """Staged orders whose later date is within ``days`` of ``as_of`` (the incremental
    source filter); ``greatest`` skips a NULL date."""
    return stg.where(F.greatest("order_date", "ship_date") >= F.date_sub(D.as_of_date(as_of), days))


def build_fact(stg: DataFrame, dim_product: DataFrame, dim_geography: DataFrame,
               dim_channel: DataFrame, dim_priority: DataFrame, dim_date: DataFrame) -> DataFrame:
    src = stg.select(
        "order_id", "units_sold", "unit_price", "unit_cost", "order_date", "ship_date",
        "item_type", "country", "region", "sales_channel", "order_priority",
        D.date_key("order_date").alias("_order_date_key"),
        D.date_key("ship_date").alias("_ship_date_key"))
    date_keys = dim_date.select("DATE_KEY")
    order_dates = checked_broadcast(date_keys.select(F.col("DATE_KEY").alias("ORDER_DATE_KEY")))
    ship_dates = checked_broadcast(date_keys.select(F.col("DATE_KEY").alias("SHIP_DATE_KEY")))
    prod = checked_broadcast(dim_product)
    geo = checked_broadcast(dim_geography)
    chan = checked_broadcast(dim_channel)
    prio = checked_broadcast(dim_priority.select("PRIORITY_ID", "ORDER_PRIORITY"))

    joined = (src
              .join(prod, src.item_type == prod.PRODUCT_CATEGORY)
              .join(geo, (src.country == geo.COUNTRY) & (src.region == geo.REGION))
              .join(chan, src.sales_channel == chan.SALES_CHANNEL)
              .join(prio, src.order_priority == prio.ORDER_PRIORITY)
              .join(order_dates, src._order_date_key == order_dates.ORDER_DATE_KEY)
              .join(ship_dates, src._ship_date_key == ship_dates.SHIP_DATE_KEY))
    units, price, cost = F.col("units_sold"), F.col("unit_price"), F.col("unit_cost")
    return joined.select(
        F.col("order_id").alias("ORDER_ID"),
        units.alias("UNITS_SOLD"),
        price.alias("UNIT_PRICE"),
        cost.alias("UNIT_COST"),
        F.round(units * price, 2).cast(FACT_AMOUNT).alias("TOTAL_REVENUE"),
        F.round(units * cost, 2).cast(FACT_AMOUNT).alias("TOTAL_COST"),
        F.round(units * price - units * cost, 2).cast(FACT_AMOUNT).alias("TOTAL_PROFIT"),
        "PRODUCT_ID", "GEOGRAPHY_ID", "CHANNEL_ID", "PRIORITY_ID",
        "ORDER_DATE_KEY", "SHIP_DATE_KEY",
        F.datediff("ship_date", "order_date").cast("int").alias("SHIPPING_DAYS"),
    )
