"""Operators: gates, surrogate keys, dedup, upserts, windows, measures, scalar functions."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from salesmart.functions import dates as D
from salesmart.functions.numeric import format_millions, format_percent, pct
from salesmart.operators import quality as Q
from salesmart.operators.keys import assign_row_numbers
from salesmart.operators.upsert import append_new_ids, upsert
from salesmart.plans import dims as DM
from salesmart.plans import measures as MS
from salesmart.plans.mart import calendar_rolling, rolling_rows_sum
from salesmart.plans.model import Model
from salesmart.schemas import RAW_SALES


GATE_COLUMNS = {Q.GATE_ROW_COUNT: "row_count", Q.GATE_NULL_ID: "null_order_id_pct",
                Q.GATE_NULL_DATE: "null_order_date_pct", Q.GATE_FUTURE: "future_orders",
                Q.GATE_LEAD_TIME: "negative_lead_time", Q.GATE_UNITS: "nonpositive_units"}


def test_gate_verdicts(spark):
    cases = [
        (Q.GATE_ROW_COUNT, 0, True), (Q.GATE_ROW_COUNT, 1, False), (Q.GATE_ROW_COUNT, 1000, False),
        (Q.GATE_NULL_ID, 1.0, True), (Q.GATE_NULL_ID, 5.2, True), (Q.GATE_NULL_ID, 0.5, False),
        (Q.GATE_NULL_ID, 0.0, False), (Q.GATE_NULL_ID, None, False),
        (Q.GATE_NULL_DATE, 2.0, True), (Q.GATE_NULL_DATE, 0.0, False),
        (Q.GATE_FUTURE, 3, True), (Q.GATE_FUTURE, 0, False),
        (Q.GATE_LEAD_TIME, 1, True), (Q.GATE_LEAD_TIME, 0, False),
        (Q.GATE_UNITS, 5, True), (Q.GATE_UNITS, 0, False)]
    rows = [(i, *[value if gate == name else (1 if name == Q.GATE_ROW_COUNT else 0) for name in GATE_COLUMNS])
            for i, (gate, value, _) in enumerate(cases)]
    kinds = ", ".join(f"{c} {'decimal(18,2)' if c.endswith('pct') else 'long'}" for c in GATE_COLUMNS.values())
    data = [tuple(Decimal(str(v)) if v is not None and c.endswith("pct") else v
                  for c, v in zip(["i", *GATE_COLUMNS.values()], row)) for row in rows]
    metrics = spark.createDataFrame(data, f"i int, {kinds}")
    for i, (gate, value, fails) in enumerate(cases):
        got = {r.GATE: r.FAILED for r in Q.judged_gates(metrics.where(F.col("i") == i)).collect()}
        assert got[gate] is fails, (gate, value)


def test_six_unique_gates():
    assert len(Q.GATES) == 6 == len(set(Q.GATES))


def _raw(spark, rows):
    base = dict(ORDER_ID=1, REGION="Europe", COUNTRY="France", ITEM_TYPE="Baby Food",
                SALES_CHANNEL="Online", ORDER_PRIORITY="H", ORDER_DATE=dt.date(2024, 1, 15),
                SHIP_DATE=dt.date(2024, 1, 20), UNITS_SOLD=10, UNIT_PRICE=Decimal("9.28"),
                UNIT_COST=Decimal("6.92"), TOTAL_REVENUE=Decimal("92.80"), TOTAL_COST=Decimal("69.20"),
                TOTAL_PROFIT=Decimal("23.60"), _ingested_at=None)
    return spark.createDataFrame([tuple({**base, **r}[f.name] for f in RAW_SALES.fields) for r in rows], RAW_SALES)


def test_gate_values_in_one_pass(spark):
    raw = _raw(spark, [{}, {"ORDER_ID": None}, {"SHIP_DATE": dt.date(2024, 1, 1)},
                       {"UNITS_SOLD": 0}, {"ORDER_DATE": dt.date(2030, 1, 1)}])
    got = {r.GATE: (r.VALUE, r.FAILED) for r in Q.gate_results(raw, "2024-06-01").collect()}
    assert got[Q.GATE_ROW_COUNT] == (Decimal("5.00"), False)
    assert got[Q.GATE_NULL_ID] == (Decimal("20.00"), True)
    assert got[Q.GATE_NULL_DATE] == (Decimal("0.00"), False)
    assert got[Q.GATE_FUTURE] == (Decimal("1.00"), True)
    assert got[Q.GATE_LEAD_TIME] == (Decimal("2.00"), True)   # the future order also ships "before" it
    assert got[Q.GATE_UNITS] == (Decimal("1.00"), True)
    with pytest.raises(Q.GateFailure):
        Q.run_gates(raw, "2024-06-01")
    empty = Q.gate_results(raw.limit(0), "2024-06-01").collect()
    assert {r.GATE: r.FAILED for r in empty}[Q.GATE_ROW_COUNT] is True
    assert {r.GATE: r.VALUE for r in empty}[Q.GATE_NULL_ID] is None


def test_row_numbers_both_paths_agree(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5003).alias("k"), F.col("id").alias("v"))
    single = assign_row_numbers(df, ["k"], "rn")
    spread = assign_row_numbers(df, ["k"], "rn", single_task_max_rows=100)
    a = sorted((r.k, r.rn) for r in single.collect())
    b = sorted((r.k, r.rn) for r in spread.collect())
    assert a == b and [rn for _, rn in a] == list(range(1, 5001))


def test_staging_dedup_ties_and_filters(spark):
    raw = _raw(spark, [
        {"ORDER_ID": 5, "UNITS_SOLD": 1}, {"ORDER_ID": 5, "UNITS_SOLD": 3},          # equal dates: tie-break
        {"ORDER_ID": 6, "ORDER_DATE": dt.date(2024, 2, 1)}, {"ORDER_ID": 6},          # latest date wins
        {"ORDER_ID": 7, "ORDER_DATE": None},                                          # sentinel: dropped
        {"ORDER_ID": None}, {"ORDER_ID": 0},                                          # id <= 0: dropped
        {"ORDER_ID": 8, "SHIP_DATE": None, "REGION": "  Asia "},                       # sentinel ship date kept
    ])
    stg = {r.order_id: r for r in Model(spark, raw=raw).stg().collect()}
    assert sorted(stg) == [5, 6, 8]
    assert stg[5].units_sold == 3
    assert stg[6].order_date == dt.date(2024, 2, 1)
    assert stg[8].ship_date == dt.date(1900, 1, 1) and stg[8].region == "Asia"


def test_priority_labels_and_missing_region(spark):
    raw = _raw(spark, [{"ORDER_ID": 1, "ORDER_PRIORITY": "X"}, {"ORDER_ID": 2, "ORDER_PRIORITY": "C"},
                       {"ORDER_ID": 3, "REGION": ""}])
    m = Model(spark, raw=raw)
    pr = {r.ORDER_PRIORITY: (r.PRIORITY_LABEL, r.PRIORITY_SORT_ORDER) for r in m.dim_priority().collect()}
    assert pr == {"C": ("Critical", 1), "H": ("High", 2), "X": ("X", 99)}
    assert sorted(r.ORDER_ID for r in m.fact().collect()) == [1, 2]   # empty region drops out
    assert m.fact().where("ORDER_ID = 1").first().SHIPPING_DAYS == 5


def test_dim_date_attributes(spark):
    d = spark.createDataFrame([(dt.date(2024, 3, 3),), (dt.date(2021, 1, 1),)], "date_col date")
    rows = {r.DATE_KEY: r for r in DM.date_attributes(d).collect()}
    r = rows[20240303]
    assert (r.DAY, r.MONTH, r.QUARTER, r.YEAR) == (3, 3, 1, 2024)
    assert r.MONTH_NAME == "March    " and r.DAY_NAME == "Sunday   "
    assert r.DAY_OF_WEEK == 0 and r.IS_WEEKEND is True and r.WEEK_OF_YEAR == 9
    assert r.YEAR_QUARTER == "2024-Q1" and r.YEAR_MONTH == "2024-03"
    assert rows[20210101].WEEK_OF_YEAR == 53                      # ISO week of 2021-01-01


def test_upsert_idempotent_and_stable_ids(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    batch = spark.createDataFrame([(2, "B"), (3, "c")], "k int, v string")
    once = upsert(target, batch, ["k"])
    assert sorted(map(tuple, once.collect())) == [(1, "a"), (2, "B"), (3, "c")]
    assert sorted(map(tuple, upsert(once, batch, ["k"]).collect())) == sorted(map(tuple, once.collect()))
    existing = spark.createDataFrame([(1, "Europe", "France"), (2, "Asia", "India")], "GEOGRAPHY_ID int, REGION string, COUNTRY string")
    cand = spark.createDataFrame([("Asia", "India"), ("Africa", "Chad"), ("Europe", "Spain")], "REGION string, COUNTRY string")
    out = {(r.REGION, r.COUNTRY): r.GEOGRAPHY_ID for r in append_new_ids(existing, cand, ["REGION", "COUNTRY"], "GEOGRAPHY_ID").collect()}
    assert out == {("Europe", "France"): 1, ("Asia", "India"): 2, ("Africa", "Chad"): 3, ("Europe", "Spain"): 4}


def test_rows_vs_calendar_rolling_with_missing_month(spark):
    rows = [(2024, m, "P", "R", "C", "Online", "H", Decimal(v)) for m, v in [(1, "10"), (2, "20"), (4, "40")]]
    perf = spark.createDataFrame(rows, "YEAR int, MONTH int, PRODUCT_CATEGORY string, REGION string, COUNTRY string, "
                                       "SALES_CHANNEL string, ORDER_PRIORITY string, TOTAL_REVENUE decimal(18,2)")
    by_rows = {r.MONTH: r.R for r in perf.select("MONTH", rolling_rows_sum("TOTAL_REVENUE", ["PRODUCT_CATEGORY"], 3).alias("R")).collect()}
    by_cal = {r.MONTH: r.C for r in calendar_rolling(perf, "TOTAL_REVENUE", "PRODUCT_CATEGORY", 3, "C").collect()}
    assert by_rows[4] == Decimal("70.00")      # three rows back: Jan + Feb + Apr
    assert by_cal[4] == Decimal("60.00")       # three calendar months: Feb + (Mar) + Apr


def test_measures_small(spark):
    rows = [(2023, 1, "A", "EU", "Online", "C", Decimal("100"), Decimal("40"), 2, Decimal("10.00")),
            (2024, 1, "A", "EU", "Offline", "H", Decimal("150"), Decimal("30"), 3, None),
            (2024, 1, "B", "AS", "Online", "H", Decimal("50"), Decimal("-5"), 1, Decimal("-20.00"))]
    perf = spark.createDataFrame(rows, "YEAR int, MONTH int, PRODUCT_CATEGORY string, REGION string, SALES_CHANNEL string, "
                                       "ORDER_PRIORITY string, TOTAL_REVENUE decimal(18,2), TOTAL_PROFIT decimal(18,2), "
                                       "ORDER_COUNT bigint, MOM_REVENUE_GROWTH_PCT decimal(18,2)")
    yoy = {(r.YEAR, r.MONTH): r.YOY_REVENUE_GROWTH for r in MS.yoy_revenue_growth(perf, ["YEAR", "MONTH"]).collect()}
    assert yoy[(2023, 1)] is None and yoy[(2024, 1)] == pytest.approx(1.0)
    share = {r.REGION: r.REGION_REVENUE_SHARE for r in MS.region_revenue_share(perf, ["YEAR"]).where("YEAR = 2024").collect()}
    assert share == {"EU": 0.75, "AS": 0.25}
    online = MS.online_revenue_share(perf).first().ONLINE_REVENUE_SHARE
    assert online == pytest.approx(150 / 300)
    assert MS.critical_revenue_share(perf).first().CRITICAL_REVENUE_SHARE == pytest.approx(100 / 300)
    top = {r.PRODUCT_CATEGORY: (r.REVENUE_RANK, r.IS_TOP_PRODUCT) for r in MS.top_products(perf, n=1).collect()}
    assert top == {"A": (1, True), "B": (2, False)}
    colors = {r.REGION: r.MOM_COLOR for r in MS.mom_color(perf, ["REGION"]).collect()}
    assert colors == {"EU": MS.MOM_COLOR_UP, "AS": MS.MOM_COLOR_DOWN}
    assert MS.gross_margin(perf).first().GROSS_MARGIN == pytest.approx(65 / 300)
    assert MS.avg_revenue_per_order(perf).first().AVG_REVENUE_PER_ORDER == pytest.approx(50.0)


def test_number_formats_and_rounding(spark):
    df = spark.createDataFrame([(0.2346, 1234567.0, Decimal("-2.345"), Decimal("1.00"))], "m double, r double, n decimal(10,3), d decimal(10,2)")
    r = df.select(format_percent(F.col("m")).alias("p"), format_millions(F.col("r")).alias("mm"),
                  pct(F.col("n"), F.col("d")).alias("x"), pct(F.col("n"), F.lit(0)).alias("z")).first()
    assert r.p == "23.5%" and r.mm == "1.2M"
    assert r.x == Decimal("-234.50") and r.z is None
    assert df.select(F.round(F.col("n"), 2).alias("h")).first().h == Decimal("-2.35")   # half away from zero


def test_data_tests_detect_failures(spark):
    fact = spark.createDataFrame([(1, 1, 2, Decimal("1.00"), Decimal("0.50"), Decimal("2.00"), Decimal("1.00"), Decimal("1.00")),
                                  (1, 9, 2, Decimal("1.00"), Decimal("0.50"), Decimal("9.99"), Decimal("1.00"), Decimal("8.99"))],
                                 "ORDER_ID bigint, PRODUCT_ID int, UNITS_SOLD int, UNIT_PRICE decimal(12,2), UNIT_COST decimal(12,2), "
                                 "TOTAL_REVENUE decimal(14,2), TOTAL_COST decimal(14,2), TOTAL_PROFIT decimal(14,2)")
    prod = spark.createDataFrame([(1, "A")], "PRODUCT_ID int, PRODUCT_CATEGORY string")
    tests = [Q.DataTest("fact_sales", "ORDER_ID", "unique"),
             Q.DataTest("fact_sales", "PRODUCT_ID", "relationships", "dim_product", "PRODUCT_ID"),
             Q.DataTest("fact_sales", "UNIT_PRICE", "not_null")]
    got = {r.KIND: r.FAILURES for r in Q.run_data_tests({"fact_sales": fact, "dim_product": prod}, tests).collect()}
    assert got == {"unique": 1, "relationships": 1, "not_null": 0}
    assert [r.TOTAL_REVENUE for r in Q.integrity_failures(fact).collect()] == [Decimal("9.99")]


def test_checked_broadcast_falls_back_past_the_bound(spark):
    from salesmart.operators.joins import checked_broadcast
    from salesmart.session import materialize
    dim = materialize(spark.range(10).withColumnRenamed("id", "k"), "bcast-dim")
    assert checked_broadcast(dim, max_rows=5) is dim                  # too big: plain join
    hinted = checked_broadcast(dim, max_rows=10)                      # within the bound
    assert hinted is not dim and "broadcast" in str(hinted._jdf.queryExecution().logical()).lower()
    fact = spark.range(100).select((F.col("id") % 12).alias("k"))
    assert fact.join(checked_broadcast(dim, max_rows=5), "k").count() == fact.join(dim, "k").count() == 84


def test_ties_round_away_from_zero(spark):
    df = spark.createDataFrame([(0.1225, 1_250_000.0), (-0.1225, -1_250_000.0), (0.12249, 1_249_999.0), (None, None)],
                               "p double, m double")
    got = df.select(format_percent(F.col("p")).alias("p"), format_millions(F.col("m")).alias("m")).collect()
    assert [r.p for r in got] == ["12.3%", "-12.3%", "12.2%", None]
    assert [r.m for r in got] == ["1.3M", "-1.3M", "1.2M", None]


def test_amounts_beyond_declared_widths(spark):
    """A line of 2 * 10 ** 9 units reaches fact and mart, with exact percentages."""
    raw = _raw(spark, [{"UNITS_SOLD": 2_000_000_000, "UNIT_PRICE": Decimal("9999.00"), "UNIT_COST": Decimal("3333.00")},
                       {"ORDER_ID": 2, "UNITS_SOLD": 2_000_000_000, "UNIT_PRICE": Decimal("9999.00"),
                        "UNIT_COST": Decimal("3333.00")}])
    m = Model(spark, raw=raw)
    assert {r.TOTAL_REVENUE for r in m.fact().collect()} == {Decimal("19998000000000.00")}
    row = m.perf().first()
    assert row.TOTAL_REVENUE == Decimal("39996000000000.00") and row.GROSS_MARGIN_PCT == Decimal("66.67")


def test_percentages_are_exact(spark):
    rows = [(Decimal(a), Decimal(b)) for a, b in (
        ("1.00", "3.00"), ("-1.00", "3.00"), ("1.00", "-3.00"), ("0.01", "1.00"), ("1.00", "0.00"),
        ("1.00", "80000.00"), ("-1.00", "80000.00"))]
    df = spark.createDataFrame(rows, "n decimal(38,2), d decimal(38,2)")
    got = [r.v for r in df.select(pct(F.col("n"), F.col("d")).alias("v")).limit(5).collect()]
    assert got[:3] == [Decimal("33.33"), Decimal("-33.33"), Decimal("-33.33")] and got[4] is None
    last = [r.v for r in df.where("d = 80000").select(pct(F.col("n"), F.col("d")).alias("v")).collect()]
    assert last == [Decimal("0.00"), Decimal("0.00")]


def test_time_measures_ignore_labels(spark):
    rows = [(y, m, (m + 2) // 3, f"{y}-Q{(m + 2) // 3}", f"{y}-{m:02}", Decimal(100 * (y - 2000) + m))
            for y in (2001, 2002) for m in range(1, 13)]
    perf = spark.createDataFrame(rows, "YEAR int, MONTH int, QUARTER int, YEAR_QUARTER string, YEAR_MONTH string, "
                                       "TOTAL_REVENUE decimal(18,2)")
    for depth in (1, 2, 3, 4):
        by = MS.TIME_PATH[:depth]
        ytd = {(r.YEAR, r.MONTH): r.YTD_REVENUE for r in MS.ytd_revenue(perf, by).collect()}
        qtd = {(r.YEAR, r.MONTH): r.QTD_REVENUE for r in MS.qtd_revenue(perf, by).collect()}
        assert ytd[2001, 4] == 400 + 10 and qtd[2001, 4] == 104 and qtd[2001, 6] == 315
        grown = MS.yoy_revenue_growth(perf, by).where("YEAR = 2002").collect()
        assert all(r.YOY_REVENUE_GROWTH is not None for r in grown) and len(grown) == {1: 1, 2: 4, 3: 12, 4: 12}[depth]


def test_failing_rows_are_what_the_tests_count(spark):
    raw = _raw(spark, [{}, {"ORDER_ID": 2}, {"ORDER_ID": 3}])
    m = Model(spark, raw=raw)
    layers = {"raw_sales": raw, "stg_sales": m.stg().unionByName(m.stg().limit(1)), "sales_performance": m.perf(), **m.dims(),
              "fact_sales": m.fact().withColumn("UNIT_COST", F.when(F.col("ORDER_ID") > 1, F.col("UNIT_COST")))
              .withColumn("PRODUCT_ID", F.when(F.col("ORDER_ID") == 3, 99).otherwise(F.col("PRODUCT_ID")))}
    counted = {r.TEST_NAME: r.FAILURES for r in Q.run_data_tests(layers).collect()}
    failed = {t.name: Q.failing_rows(t, layers).count() for t in Q.DECLARED_TESTS if counted[t.name]}
    assert failed == {"unique_stg_sales_order_id": 1, "not_null_fact_sales_UNIT_COST": 1,
                      "relationships_fact_sales_PRODUCT_ID__dim_product_PRODUCT_ID": 1}
    assert all(counted[name] == n for name, n in failed.items())


def test_pct_is_exact_at_any_scale(spark):
    rows = [("0.004", "0.006", "66.67"), ("-2.345", "1.00", "-234.50"), ("0.00000125", "1", "0.00"), ("0.00005", "1", "0.01"),
            ("123456789012.34", "123456789012.33", "100.00"), ("1", "-3", "-33.33"), ("1", "0", None), (None, "1", None)]
    df = spark.createDataFrame(rows, "a string, b string, want string").select(
        pct(F.col("a").cast("decimal(30,8)"), F.col("b").cast("decimal(30,8)")).alias("y"), "want")
    got = df.collect()
    assert [None if r.y is None else str(r.y) for r in got] == [r.want for r in got]


def test_session_starts_without_site_defaults(tmp_dir):
    """Where nothing names the shared folder a local session makes its own."""
    import os
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = ("from salesmart.session import get_spark, materialize; s = get_spark('local[1]');"
            "print('ROWS', materialize(s.range(3), 'x').count(), s.sparkContext.getCheckpointDir() is not None)")
    env = {**os.environ, "SPARK_CONF_DIR": tmp_dir, "PYTHONPATH": root}
    done = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=180)
    assert "ROWS 3 True" in done.stdout, done.stderr[-2000:]
