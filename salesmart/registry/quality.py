"""Data-quality queries Q1-Q16: source gates, declared tests, layer checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import oracle as O
from ..operators import quality as Q
from ..sources.testdata import flawed_layers
from .core import AS_OF, AS_OF_SQL, W, X, alias, flawed, layers_of, model, register

_GATE_VALUES = [
    ("row_count", "row_count = 0"),
    ("null_id", "COALESCE(null_id >= 1, false)"),
    ("null_date", "COALESCE(null_date >= 1, false)"),
    ("future", "future > 0"),
    ("lead", "lead > 0"),
    ("units", "units > 0"),
]

GATE_METRICS_SQL = f"""
gate_metrics AS (
  SELECT COUNT(*) AS row_count,
         {O.pct_sql("SUM(CASE WHEN ORDER_ID IS NULL THEN 1 ELSE 0 END)", "COUNT(*)")} AS null_id,
         {O.pct_sql("SUM(CASE WHEN ORDER_DATE IS NULL THEN 1 ELSE 0 END)", "COUNT(*)")} AS null_date,
         COUNT(*) FILTER (WHERE ORDER_DATE > {AS_OF_SQL}) AS future,
         COUNT(*) FILTER (WHERE SHIP_DATE < ORDER_DATE) AS lead,
         COUNT(*) FILTER (WHERE UNITS_SOLD <= 0) AS units
  FROM raw_sales
),
gate_rows AS (
""" + "\n  UNION ALL\n".join(
    f"  SELECT {i + 1} AS GATE_ID, '{g}' AS GATE, CAST({col} AS DECIMAL(18,2)) AS VALUE, "
    f"{fail} AS FAILED FROM gate_metrics"
    for i, (g, (col, fail)) in enumerate(zip(Q.GATES, _GATE_VALUES))) + "\n)"


def _gate_sql(where: str = "", over=W) -> str:
    return over(f"SELECT * FROM gate_rows {where}", extra_ctes=GATE_METRICS_SQL)


@register("q7_source_gates", _gate_sql())
def q7(spark, sf):
    return Q.gate_results(model(spark, sf).raw(), AS_OF)


def _single_gate(gate_id: int):
    def run(spark, sf):
        return Q.gate_results(flawed(spark, sf).raw(), AS_OF).where(F.col("GATE_ID") == gate_id)
    return run


for _i, _name in enumerate(["q1_gate_row_count", "q2_gate_null_order_id_rate",
                            "q3_gate_null_order_date_rate", "q4_gate_no_future_orders",
                            "q5_gate_no_negative_lead_time", "q6_gate_positive_units"]):
    register(_name, _gate_sql(f"WHERE GATE_ID = {_i + 1}", X))(_single_gate(_i + 1))


def _not_null_sql() -> str:
    parts = [f"""SELECT '{t.name}' AS TEST_NAME, '{t.model}' AS MODEL, '{t.column}' AS COLUMN_NAME,
       'not_null' AS KIND, CAST(COUNT(*) FILTER (WHERE {t.column} IS NULL) AS BIGINT) AS FAILURES
FROM x_{t.model}""" for t in Q.DECLARED_TESTS if t.kind == "not_null"]
    return "SELECT *, FAILURES = 0 AS PASSED FROM (" + " UNION ALL ".join(parts) + ") t"


def _unique_sql() -> str:
    parts = [f"""SELECT '{t.name}' AS TEST_NAME, '{t.model}' AS MODEL, '{t.column}' AS COLUMN_NAME,
       'unique' AS KIND, (SELECT CAST(COUNT(*) AS BIGINT) FROM (SELECT {t.column} FROM x_{t.model}
       WHERE {t.column} IS NOT NULL GROUP BY {t.column} HAVING COUNT(*) > 1) d) AS FAILURES"""
             for t in Q.DECLARED_TESTS if t.kind == "unique"]
    return "SELECT *, FAILURES = 0 AS PASSED FROM (" + " UNION ALL ".join(parts) + ") t"


def _flawed_layers(spark, sf):
    return flawed_layers(layers_of(flawed(spark, sf)))


@register("q8_not_null_tests", X(_not_null_sql()))
def q8(spark, sf):
    return Q.run_data_tests(_flawed_layers(spark, sf), kinds={"not_null"})


@register("q9_unique_tests", X(_unique_sql()))
def q9(spark, sf):
    return Q.run_data_tests(_flawed_layers(spark, sf), kinds={"unique"})


alias("q10_relationship_tests", "j7_relationship_tests")


@register("q11_financial_integrity", X(f"""
SELECT ORDER_ID, UNITS_SOLD, UNIT_PRICE, UNIT_COST, TOTAL_REVENUE, TOTAL_COST, TOTAL_PROFIT
FROM x_fact_sales WHERE {O.identity_broken_sql()}"""))
def q11(spark, sf):
    return Q.integrity_failures(_flawed_layers(spark, sf)["fact_sales"])


def _layer_checks_sql() -> str:
    """One aggregate per layer table and rule, named as ``Q.LAYER_CHECKS`` names them."""
    rules = {Q.FILLED: "true", Q.NO_NULL_ID: "order_id IS NULL", Q.AMOUNTS_AGREE: O.identity_broken_sql(),
             Q.PRODUCTS_KNOWN: "NOT coalesce(PRODUCT_ID IN (SELECT PRODUCT_ID FROM dim_product), false)"}
    rows = [f"SELECT {i} AS CHECK_ID, '{Q.check_name(table, rule)}' AS CHECK_NAME, "
            f"count(*) FILTER (WHERE {rules[rule]}) AS VALUE, VALUE {'>' if rule == Q.FILLED else '='} 0 AS PASSED "
            f"FROM {table}" for i, (table, rule) in enumerate(Q.LAYER_CHECKS, 1)]
    return " UNION ALL ".join(rows)


LAYER_CHECKS_SQL = _layer_checks_sql()


@register("q13_layer_checks", W(LAYER_CHECKS_SQL))
def q13(spark, sf):
    return Q.layer_checks(spark, layers_of(model(spark, sf)))


@register("q14_consumption_not_empty", W("""
SELECT COUNT(*) AS N_ROWS, COUNT(*) > 0 AS PASSED FROM sales_performance"""))
def q14(spark, sf):
    n = F.count(F.lit(1))
    return model(spark, sf).perf().agg(n.alias("N_ROWS"), (n > 0).alias("PASSED"))


@register("q15_recent_ingest_count", W(f"""
SELECT COUNT(*) AS RECENT_ROWS FROM raw_sales
WHERE _ingested_at >= CAST({AS_OF_SQL} AS TIMESTAMP) - INTERVAL 1 HOUR"""))
def q15(spark, sf):
    cut = F.lit(AS_OF).cast("timestamp_ntz") - F.expr("INTERVAL 1 HOUR")
    return model(spark, sf).raw().where(F.col("_ingested_at") >= cut).agg(
        F.count(F.lit(1)).alias("RECENT_ROWS"))


@register("q16_mart_freshness", W("""
SELECT MAX(YEAR) AS MAX_YEAR, MAX(MONTH) AS MAX_MONTH FROM sales_performance"""))
def q16(spark, sf):
    return model(spark, sf).perf().agg(F.max("YEAR").alias("MAX_YEAR"), F.max("MONTH").alias("MAX_MONTH"))

