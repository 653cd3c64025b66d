"""Declared table schemas. Nothing in the package infers a schema."""

from __future__ import annotations

from pyspark.sql import types as T

# Source CSV header names, in file order, and the raw column each feeds.
CSV_HEADERS = [
    "Order ID", "Region", "Country", "Item Type", "Sales Channel",
    "Order Priority", "Order Date", "Ship Date", "Units Sold",
    "Unit Price", "Unit Cost", "Total Revenue", "Total Cost", "Total Profit",
]
RAW_COLUMNS = [
    "ORDER_ID", "REGION", "COUNTRY", "ITEM_TYPE", "SALES_CHANNEL",
    "ORDER_PRIORITY", "ORDER_DATE", "SHIP_DATE", "UNITS_SOLD",
    "UNIT_PRICE", "UNIT_COST", "TOTAL_REVENUE", "TOTAL_COST", "TOTAL_PROFIT",
]
HEADER_TO_RAW = dict(zip(CSV_HEADERS, RAW_COLUMNS))

# Declared maximum lengths of the raw text columns.
RAW_MAX_LENGTH = {"REGION": 100, "COUNTRY": 100, "ITEM_TYPE": 100,
                  "SALES_CHANNEL": 50, "ORDER_PRIORITY": 10}

PRICE = T.DecimalType(12, 2)
AMOUNT = T.DecimalType(14, 2)
# Units times price, without loss: a line amount is bounded by its factors only, a sum by Spark's widest decimal.
FACT_AMOUNT = T.DecimalType(24, 2)
TOTAL = T.DecimalType(38, 2)

CSV_SCHEMA = T.StructType([T.StructField(h, T.StringType(), True) for h in CSV_HEADERS])

RAW_SALES = T.StructType([
    T.StructField("ORDER_ID", T.LongType(), True),
    T.StructField("REGION", T.StringType(), True),
    T.StructField("COUNTRY", T.StringType(), True),
    T.StructField("ITEM_TYPE", T.StringType(), True),
    T.StructField("SALES_CHANNEL", T.StringType(), True),
    T.StructField("ORDER_PRIORITY", T.StringType(), True),
    T.StructField("ORDER_DATE", T.DateType(), True),
    T.StructField("SHIP_DATE", T.DateType(), True),
    T.StructField("UNITS_SOLD", T.IntegerType(), True),
    T.StructField("UNIT_PRICE", PRICE, True),
    T.StructField("UNIT_COST", PRICE, True),
    T.StructField("TOTAL_REVENUE", AMOUNT, True),
    T.StructField("TOTAL_COST", AMOUNT, True),
    T.StructField("TOTAL_PROFIT", AMOUNT, True),
    T.StructField("_ingested_at", T.TimestampNTZType(), True),
])

STG_SALES = T.StructType([
    T.StructField("region", T.StringType(), False),
    T.StructField("country", T.StringType(), False),
    T.StructField("item_type", T.StringType(), False),
    T.StructField("sales_channel", T.StringType(), False),
    T.StructField("order_priority", T.StringType(), False),
    T.StructField("order_date", T.DateType(), False),
    T.StructField("order_id", T.LongType(), False),
    T.StructField("ship_date", T.DateType(), False),
    T.StructField("units_sold", T.IntegerType(), False),
    T.StructField("unit_price", PRICE, False),
    T.StructField("unit_cost", PRICE, False),
    T.StructField("total_revenue", AMOUNT, False),
    T.StructField("total_cost", AMOUNT, False),
    T.StructField("total_profit", AMOUNT, False),
])

# The seven columns that identify one row of the monthly mart.
PERF_KEY = ["YEAR", "MONTH", "PRODUCT_CATEGORY", "REGION", "COUNTRY",
            "SALES_CHANNEL", "ORDER_PRIORITY"]
# Total order used to break ties in the mart's windows (see README, "Determinism").
PERF_TOTAL_ORDER = ["YEAR", "MONTH", "REGION", "COUNTRY", "PRODUCT_CATEGORY",
                    "SALES_CHANNEL", "ORDER_PRIORITY"]
PERF_GROUP = ["YEAR", "MONTH", "MONTH_NAME", "QUARTER", "YEAR_QUARTER", "YEAR_MONTH",
              "PRODUCT_CATEGORY", "REGION", "COUNTRY", "SALES_CHANNEL", "ORDER_PRIORITY",
              "PRIORITY_LABEL", "PRIORITY_SORT_ORDER"]
