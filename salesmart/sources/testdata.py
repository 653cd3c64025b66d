"""Adapter: shape the driver's TPC-H-like tables as the ``raw.sales`` feed.

One raw row per ``lineitem`` row (copies included, so staging's dedup has real work).
The same mapping is written as SQL in ``salesmart.oracle`` for the DuckDB check.

Join plan: the order side (orders -> customer) is built first so the line side joins it
once on the order key. ``nation`` and ``region`` have a fixed size (25 and 5 rows by the
TPC-H spec), so they are broadcast; customer and part are left to the planner, which
broadcasts them only below its size threshold and uses a sort-merge join beyond it. What
these joins may shuffle is as narrow as it gets: days instead of times, codes instead of
priorities and a flag instead of a status; the names of the places are looked up after them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import AMOUNT, PRICE

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]

# Mapping of the driver's order priorities onto the feed's codes.
PRIORITY_CODES = {"1-URGENT": "C", "2-HIGH": "H", "3-MEDIUM": "M"}  # anything else: "L"
# Fixed value: unit cost is 60 % of the list price.
COST_RATIO = "0.6"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _priority_code(c: Column) -> Column:
    expr = F.lit("L")
    for source, code in reversed(list(PRIORITY_CODES.items())):
        expr = F.when(c == source, F.lit(code)).otherwise(expr)
    return expr


def raw_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``raw.sales`` table (15 columns) derived from the driver tables."""
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("o_orderdate"),
        _priority_code(F.col("o_orderpriority")).alias("priority_code"))
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_retailprice")
    lineitem = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", (F.col("l_linestatus") == "O").alias("is_online"),
        F.col("l_shipdate").cast("date").alias("ship_day"), F.col("l_shipdate").cast("timestamp_ntz").alias("ship_time"))

    geo = nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey)
    order_side = (orders
                  .join(customer, orders.o_custkey == customer.c_custkey)
                  .select("o_orderkey", "o_orderdate", "priority_code", "c_nationkey"))
    lines = (lineitem
             .join(order_side, lineitem.l_orderkey == order_side.o_orderkey)
             .join(part, lineitem.l_partkey == part.p_partkey)
             .join(F.broadcast(geo), order_side.c_nationkey == geo.n_nationkey))

    units = F.col("l_quantity").cast("int")
    price = F.col("p_retailprice").cast(PRICE)
    cost = F.round(price * F.lit(COST_RATIO).cast("decimal(2,1)"), 2).cast(PRICE)
    revenue = F.round(units * price, 2).cast(AMOUNT)
    total_cost = F.round(units * cost, 2).cast(AMOUNT)
    return lines.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("bigint").alias("ORDER_ID"),
        F.col("r_name").alias("REGION"),
        F.col("n_name").alias("COUNTRY"),
        F.col("p_type").alias("ITEM_TYPE"),
        F.when(F.col("is_online"), "Online").otherwise("Offline").alias("SALES_CHANNEL"),
        F.col("priority_code").alias("ORDER_PRIORITY"),
        F.col("o_orderdate").alias("ORDER_DATE"),
        F.col("ship_day").alias("SHIP_DATE"),
        units.alias("UNITS_SOLD"),
        price.alias("UNIT_PRICE"),
        cost.alias("UNIT_COST"),
        revenue.alias("TOTAL_REVENUE"),
        total_cost.alias("TOTAL_COST"),
        (revenue - total_cost).cast(AMOUNT).alias("TOTAL_PROFIT"),
        F.col("ship_time").alias("_ingested_at"),
    )


# ---------------------------------------------------------------------------------------
# A CSV feed derived from the adapter, for the ingest operators.
# ---------------------------------------------------------------------------------------

# Text formats the feed uses for dates, chosen per order by a rule.
FEED_DATE_FORMATS = ["MM/dd/yyyy", "yyyy-MM-dd", "dd/MM/yyyy"]
FEED_FILE_ROWS = 1_000_000  # about 100 MB of text
# Defects planted in the feed, keyed by ORDER_ID % 1000 (about 0.1 % of
# rows each): column, planted text ('{v}' = the clean value).
FEED_DEFECTS = {
    13: ("Units Sold", "  "),             # whitespace only: rejected
    25: ("Units Sold", ""),               # empty: loads as 0
    37: ("Unit Price", "n/a"),            # not a number: rejected
    41: ("Order Date", "not-a-date"),     # unparsable: loads as NULL
    52: ("Region", "  {v}\t"),            # padded: stripped
    64: ("Order ID", ""),                 # empty id: loads as 0, staging drops it
    88: ("Country", "{v}" + "x" * 101),   # over the declared length: rejected
}


def _formatted_date(d: Column, selector: Column) -> Column:
    expr = F.date_format(d, FEED_DATE_FORMATS[-1])
    for i in reversed(range(len(FEED_DATE_FORMATS) - 1)):
        expr = F.when(selector == i, F.date_format(d, FEED_DATE_FORMATS[i])).otherwise(expr)
    return expr


def feed_text(raw: DataFrame) -> DataFrame:
    """The raw rows as the 14 text columns of the source CSV, with planted defects."""
    from ..schemas import CSV_HEADERS, HEADER_TO_RAW

    oid = F.col("ORDER_ID")
    group = F.floor(oid / 10)
    clean = {h: F.col(c).cast("string") for h, c in HEADER_TO_RAW.items()}
    clean["Order Date"] = _formatted_date(F.col("ORDER_DATE"), F.pmod(group, F.lit(3)))
    clean["Ship Date"] = _formatted_date(F.col("SHIP_DATE"), F.pmod(group + 1, F.lit(3)))
    cols = dict(clean)
    for key, (header, text) in FEED_DEFECTS.items():
        planted = F.lit(text) if "{v}" not in text else F.concat(
            *[p for part in text.split("{v}") for p in (F.lit(part), clean[header])][:-1])
        cols[header] = F.when(F.pmod(oid, F.lit(1000)) == key, planted).otherwise(cols[header])
    return raw.select(*[cols[h].alias(h) for h in CSV_HEADERS])


def write_feed(raw: DataFrame, path: str, drop_headers: tuple[str, ...] = ()) -> str:
    """Write the feed as headered, compressed CSV (whitespace kept as is).

    A compressed file is read by one task, so no file has more than ``FEED_FILE_ROWS`` rows.
    """
    feed = feed_text(raw)
    if drop_headers:
        feed = feed.drop(*drop_headers)
    (feed.write.mode("overwrite").option("header", True)
     .option("compression", "gzip").option("maxRecordsPerFile", FEED_FILE_ROWS)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(path))
    return path


# ---------------------------------------------------------------------------------------
# Defects planted in the tables, so that checks have something to find.
# ---------------------------------------------------------------------------------------

FLAW_EVERY = 211
# What is planted, by the remainder of the order id.
RAW_FLAWS = {
    "REGION": {3: None}, "COUNTRY": {5: "", 59: None}, "ITEM_TYPE": {7: "  ", 61: None}, "SALES_CHANNEL": {11: None}, "ORDER_PRIORITY": {13: None},
    "UNITS_SOLD": {23: None, 29: -1, 31: 0}, "UNIT_PRICE": {37: None}, "UNIT_COST": {41: None}, "ORDER_ID": {43: None}}
RAW_DATE_FLAWS = {"ORDER_DATE": 17, "SHIP_DATE": 19}   # NULL
RAW_LATER = 47                                         # both dates ten years (3,653 days) later
RAW_WRONG_TOTAL = 53                                   # revenue one too high
STAGED_NULLS = {"order_id": 2, "order_date": 4, "units_sold": 6, "unit_price": 8, "unit_cost": 10}
STAGED_TWICE = 12
FACT_NULLS = {"ORDER_ID": 2, "ORDER_DATE_KEY": 4, "SHIP_DATE_KEY": 6, "PRODUCT_ID": 8, "GEOGRAPHY_ID": 10, "CHANNEL_ID": 12,
              "PRIORITY_ID": 14, "UNITS_SOLD": 16, "UNIT_PRICE": 18, "UNIT_COST": 20}
FACT_ORPHANS = {"PRODUCT_ID": 22, "GEOGRAPHY_ID": 24, "CHANNEL_ID": 26, "PRIORITY_ID": 28, "ORDER_DATE_KEY": 30, "SHIP_DATE_KEY": 32}
FACT_WRONG = {"TOTAL_REVENUE": 34, "TOTAL_COST": 36, "TOTAL_PROFIT": 38}
FACT_TWICE = 40


def _replaced(df: DataFrame, key: str, flaws: dict[str, dict[int, Column]]) -> DataFrame:
    rest = F.pmod(F.col(key), F.lit(FLAW_EVERY))
    columns = []
    for c in df.columns:
        value = F.col(c)
        for at, flaw in flaws.get(c, {}).items():
            value = F.when(rest == at, flaw).otherwise(value)
        columns.append(value.cast(df.schema[c].dataType).alias(c))
    return df.select(*columns)


def flawed_raw(raw: DataFrame) -> DataFrame:
    """The raw table with missing and blank values, broken totals and orders far ahead, a few of each by rule."""
    flaws = {c: {at: F.lit(v) for at, v in by.items()} for c, by in RAW_FLAWS.items()}
    flaws |= {c: {at: F.lit(None), RAW_LATER: F.date_add(c, 3653)} for c, at in RAW_DATE_FLAWS.items()}
    flaws["TOTAL_REVENUE"] = {RAW_WRONG_TOTAL: F.col("TOTAL_REVENUE") + 1}
    return _replaced(raw, "ORDER_ID", flaws)


def flawed_layers(layers: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The layers with NULLs, orphans, repeated ids and broken totals, which the models themselves never let through."""
    stg, fact = layers["stg_sales"], layers["fact_sales"]
    rest = lambda key: F.pmod(F.col(key), F.lit(FLAW_EVERY))
    twice = stg.unionByName(stg.where(rest("order_id") == STAGED_TWICE))
    out = dict(layers, stg_sales=_replaced(twice, "order_id", {c: {at: F.lit(None)} for c, at in STAGED_NULLS.items()}))
    flaws: dict[str, dict[int, Column]] = {}
    for c, at in FACT_NULLS.items():
        flaws.setdefault(c, {})[at] = F.lit(None)
    for c, at in FACT_ORPHANS.items():
        flaws.setdefault(c, {})[at] = F.lit(-1)
    for c, at in FACT_WRONG.items():
        flaws.setdefault(c, {})[at] = F.col(c) + 1
    out["fact_sales"] = _replaced(fact.unionByName(fact.where(rest("ORDER_ID") == FACT_TWICE)), "ORDER_ID", flaws)
    for name, key in (("dim_geography", "GEOGRAPHY_ID"), ("dim_product", "PRODUCT_ID"), ("dim_channel", "CHANNEL_ID"),
                      ("dim_priority", "PRIORITY_ID")):
        first = layers[name].where(F.col(key) == 1)
        missing = first.withColumn(key, F.lit(None).cast(layers[name].schema[key].dataType))
        out[name] = layers[name].unionByName(first).unionByName(missing)
    dates = layers["dim_date"]
    day = lambda month: (F.col("MONTH") == month) & (F.col("DAY") == 1)
    out["dim_date"] = dates.unionByName(dates.where(day(1))).select(*(
        F.when(~day(month), F.col(c)).alias(c) if month else F.col(c)
        for c, month in ((c, {"DATE_KEY": 2, "FULL_DATE": 3}.get(c, 0)) for c in dates.columns)))
    return out
