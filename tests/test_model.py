"""The model layers on the five seed rows (golden values by hand) and properties of the
model built from the driver tables."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from conftest import SF_SMALL
from salesmart.operators import quality as Q
from salesmart.plans.model import Model
from salesmart.schemas import RAW_SALES

D = Decimal

# The five seed orders: id, region, country, item, channel, priority, order date,
# ship date, units, unit price, unit cost, revenue, cost, profit.
SEED = [
    (1001, "Europe", "France", "Cosmetics", "Online", "H", "2022-01-15", "2022-01-25",
     100, "437.20", "263.33", "43720.00", "26333.00", "17387.00"),
    (1002, "Asia", "China", "Beverages", "Offline", "M", "2022-02-10", "2022-02-20",
     200, "47.45", "31.79", "9490.00", "6358.00", "3132.00"),
    (1003, "Africa", "Nigeria", "Snacks", "Online", "L", "2022-03-05", "2022-03-15",
     150, "9.33", "6.92", "1399.50", "1038.00", "361.50"),
    (1004, "Americas", "USA", "Electronics", "Offline", "H", "2022-04-01", "2022-04-10",
     300, "651.21", "524.96", "195363.00", "157488.00", "37875.00"),
    (1005, "Europe", "Germany", "Office Supplies", "Online", "C", "2022-05-12", "2022-05-22",
     80, "651.21", "524.96", "52096.80", "41996.80", "10100.00"),
]


def _seed(spark):
    rows = [(i, r, c, it, ch, p, dt.date.fromisoformat(od), dt.date.fromisoformat(sd), u,
             D(up), D(uc), D(rev), D(cost), D(prof), dt.datetime(2022, 6, 1))
            for i, r, c, it, ch, p, od, sd, u, up, uc, rev, cost, prof in SEED]
    return spark.createDataFrame(rows, RAW_SALES)


def test_seed_rows_through_every_layer(spark):
    m = Model(spark, raw=_seed(spark), as_of="2022-06-30")
    assert all(not g.FAILED for g in Q.gate_results(m.raw(), "2022-06-30").collect())

    geo = {(r.REGION, r.COUNTRY): r.GEOGRAPHY_ID for r in m.dim_geography().collect()}
    assert geo == {("Africa", "Nigeria"): 1, ("Americas", "USA"): 2, ("Asia", "China"): 3,
                   ("Europe", "France"): 4, ("Europe", "Germany"): 5}
    prod = {r.PRODUCT_CATEGORY: r.PRODUCT_ID for r in m.dim_product().collect()}
    assert prod == {"Beverages": 1, "Cosmetics": 2, "Electronics": 3, "Office Supplies": 4, "Snacks": 5}
    prio = {r.ORDER_PRIORITY: (r.PRIORITY_ID, r.PRIORITY_LABEL, r.PRIORITY_SORT_ORDER)
            for r in m.dim_priority().collect()}
    assert prio == {"C": (1, "Critical", 1), "H": (2, "High", 2), "L": (3, "Low", 4), "M": (4, "Medium", 3)}
    assert m.dim_date().count() == 10   # five order dates and five ship dates

    fact = {r.ORDER_ID: r for r in m.fact().collect()}
    assert sorted(fact) == [1001, 1002, 1003, 1004, 1005]
    for oid, *_rest, rev, cost, prof in SEED:
        f = fact[oid]
        assert (f.TOTAL_REVENUE, f.TOTAL_COST, f.TOTAL_PROFIT) == (D(rev), D(cost), D(prof))
    assert {oid: f.SHIPPING_DAYS for oid, f in fact.items()} == {1001: 10, 1002: 10, 1003: 10, 1004: 9, 1005: 10}
    assert fact[1001].ORDER_DATE_KEY == 20220115 and fact[1001].SHIP_DATE_KEY == 20220125
    assert fact[1004].GEOGRAPHY_ID == 2 and fact[1004].PRODUCT_ID == 3

    perf = {(r.YEAR, r.MONTH): r for r in m.perf().collect()}
    assert sorted(perf) == [(2022, 1), (2022, 2), (2022, 3), (2022, 4), (2022, 5)]
    jan, apr = perf[(2022, 1)], perf[(2022, 4)]
    assert jan.ORDER_COUNT == 1 and jan.TOTAL_REVENUE == D("43720.00")
    assert jan.GROSS_MARGIN_PCT == D("39.77")           # 17387 / 43720
    assert apr.GROSS_MARGIN_PCT == D("19.39")           # 37875 / 195363
    assert jan.MONTH_NAME == "January  " and jan.YEAR_MONTH == "2022-01"
    assert all(r.MONTHLY_REVENUE_RANK == 1 for r in perf.values())   # one row per month

    tables = {"raw_sales": m.raw(), "stg_sales": m.stg(), "fact_sales": m.fact(),
              "sales_performance": m.perf(), "dim_date": m.dim_date(),
              "dim_geography": m.dim_geography(), "dim_product": m.dim_product(),
              "dim_channel": m.dim_channel(), "dim_priority": m.dim_priority()}
    assert all(r.PASSED for r in Q.run_data_tests(tables).collect())
    assert Q.integrity_failures(m.fact()).count() == 0


def test_model_properties_on_driver_tables(spark):
    m = Model(spark, SF_SMALL)
    stg = m.stg()
    assert stg.count() == stg.select("order_id").distinct().count()   # one row per order id
    fact = m.fact()
    # foreign-key closure: every fact key has its dimension row
    for key, dim in [("PRODUCT_ID", m.dim_product()), ("GEOGRAPHY_ID", m.dim_geography()),
                     ("CHANNEL_ID", m.dim_channel()), ("PRIORITY_ID", m.dim_priority())]:
        assert fact.join(dim, key, "left_anti").count() == 0, key
    for key in ["ORDER_DATE_KEY", "SHIP_DATE_KEY"]:
        assert fact.join(m.dim_date().withColumnRenamed("DATE_KEY", key), key, "left_anti").count() == 0
    # the mart's inner star join loses no fact row: totals agree
    f = fact.agg(F.sum("TOTAL_REVENUE").alias("r"), F.count(F.lit(1)).alias("n")).first()
    p = m.perf().agg(F.sum("TOTAL_REVENUE").alias("r"), F.sum("ORDER_COUNT").alias("n")).first()
    assert (f.r, f.n) == (p.r, p.n)
