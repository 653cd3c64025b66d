"""Data-quality operators: source gates, declared data tests, layer checks.

Every check set is computed in as few passes as possible: all six source gates are one
aggregation over the raw table; all not-null tests of a table are one aggregation over
it. Only the tiny result rows (one per check) reach the driver, and only when a runner
needs to decide whether to stop.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import as_of_date
from ..functions.numeric import pct
from .joins import anti_join, checked_broadcast

# Source gate names, in the order they run.
GATE_ROW_COUNT = "Row count > 0"
GATE_NULL_ID = "NULL ORDER_ID rate < 1%"
GATE_NULL_DATE = "NULL ORDER_DATE rate < 1%"
GATE_FUTURE = "No future ORDER_DATE"
GATE_LEAD_TIME = "SHIP_DATE >= ORDER_DATE (no negative lead time)"
GATE_UNITS = "UNITS_SOLD all positive"


GATES = [GATE_ROW_COUNT, GATE_NULL_ID, GATE_NULL_DATE, GATE_FUTURE, GATE_LEAD_TIME, GATE_UNITS]


def _count_if(cond: Column) -> Column:
    return F.coalesce(F.sum(F.when(cond, 1).otherwise(0)), F.lit(0)).cast("bigint")


def gate_metrics(raw: DataFrame, as_of: str | _dt.date | None = None) -> DataFrame:
    """One row with the six gate values, from a single scan of ``raw``."""
    n = F.count(F.lit(1))
    dec = T.DecimalType(20, 0)
    return raw.agg(
        n.alias("row_count"),
        pct(_count_if(F.col("ORDER_ID").isNull()).cast(dec), n.cast(dec)).alias("null_order_id_pct"),
        pct(_count_if(F.col("ORDER_DATE").isNull()).cast(dec), n.cast(dec)).alias("null_order_date_pct"),
        _count_if(F.col("ORDER_DATE") > as_of_date(as_of)).alias("future_orders"),
        _count_if(F.col("SHIP_DATE") < F.col("ORDER_DATE")).alias("negative_lead_time"),
        _count_if(F.col("UNITS_SOLD") <= 0).alias("nonpositive_units"),
    )


def gate_results(raw: DataFrame, as_of: str | _dt.date | None = None) -> DataFrame:
    """One row per gate: ``GATE_ID``, ``GATE``, ``VALUE`` (decimal), ``FAILED``."""
    return judged_gates(gate_metrics(raw, as_of))


def judged_gates(m: DataFrame) -> DataFrame:
    """The verdicts on a row of ``gate_metrics``; an unknown rate (empty table) does not fail."""
    val = T.DecimalType(18, 2)
    v = {
        GATE_ROW_COUNT: F.col("row_count"), GATE_NULL_ID: F.col("null_order_id_pct"),
        GATE_NULL_DATE: F.col("null_order_date_pct"), GATE_FUTURE: F.col("future_orders"),
        GATE_LEAD_TIME: F.col("negative_lead_time"), GATE_UNITS: F.col("nonpositive_units"),
    }
    failed = {
        GATE_ROW_COUNT: v[GATE_ROW_COUNT] == 0,
        GATE_NULL_ID: F.coalesce(v[GATE_NULL_ID] >= 1, F.lit(False)),
        GATE_NULL_DATE: F.coalesce(v[GATE_NULL_DATE] >= 1, F.lit(False)),
        GATE_FUTURE: v[GATE_FUTURE] > 0,
        GATE_LEAD_TIME: v[GATE_LEAD_TIME] > 0,
        GATE_UNITS: v[GATE_UNITS] > 0,
    }
    rows = F.array(*[
        F.struct(F.lit(i + 1).alias("GATE_ID"), F.lit(g).alias("GATE"), v[g].cast(val).alias("VALUE"),
                 failed[g].alias("FAILED"))
        for i, g in enumerate(GATES)])
    return m.select(F.inline(rows))


class GateFailure(RuntimeError):
    def __init__(self, failures: list[tuple[str, object]]):
        self.failures = failures
        super().__init__(f"{len(failures)} quality gate(s) failed: {[f[0] for f in failures]}")


def run_gates(raw: DataFrame, as_of: str | _dt.date | None = None, raise_on_failure: bool = True):
    """Evaluate every gate (one scan), then raise listing all failures."""
    rows = gate_results(raw, as_of).collect()  # six rows
    failures = [(r.GATE, r.VALUE) for r in rows if r.FAILED]
    if failures and raise_on_failure:
        raise GateFailure(failures)
    return rows


# ---------------------------------------------------------------------------------------
# Declared data tests
# ---------------------------------------------------------------------------------------

@dataclass(frozen=True)
class DataTest:
    model: str
    column: str
    kind: str                 # not_null | unique | relationships
    parent: str | None = None
    parent_column: str | None = None

    @property
    def name(self) -> str:
        if self.kind == "relationships":
            return f"relationships_{self.model}_{self.column}__{self.parent}_{self.parent_column}"
        return f"{self.kind}_{self.model}_{self.column}"


# The declared generic tests (model, column, kind[, parent, parent column]).
DECLARED_TESTS = [
    DataTest("raw_sales", "ORDER_ID", "not_null"),
    DataTest("raw_sales", "ORDER_DATE", "not_null"),
    DataTest("stg_sales", "order_id", "not_null"),
    DataTest("stg_sales", "order_id", "unique"),
    DataTest("stg_sales", "order_date", "not_null"),
    DataTest("stg_sales", "units_sold", "not_null"),
    DataTest("stg_sales", "unit_price", "not_null"),
    DataTest("stg_sales", "unit_cost", "not_null"),
    DataTest("fact_sales", "ORDER_ID", "not_null"),
    DataTest("fact_sales", "ORDER_ID", "unique"),
    DataTest("fact_sales", "ORDER_DATE_KEY", "not_null"),
    DataTest("fact_sales", "ORDER_DATE_KEY", "relationships", "dim_date", "DATE_KEY"),
    DataTest("fact_sales", "SHIP_DATE_KEY", "not_null"),
    DataTest("fact_sales", "SHIP_DATE_KEY", "relationships", "dim_date", "DATE_KEY"),
    DataTest("fact_sales", "PRODUCT_ID", "not_null"),
    DataTest("fact_sales", "PRODUCT_ID", "relationships", "dim_product", "PRODUCT_ID"),
    DataTest("fact_sales", "GEOGRAPHY_ID", "not_null"),
    DataTest("fact_sales", "GEOGRAPHY_ID", "relationships", "dim_geography", "GEOGRAPHY_ID"),
    DataTest("fact_sales", "CHANNEL_ID", "not_null"),
    DataTest("fact_sales", "CHANNEL_ID", "relationships", "dim_channel", "CHANNEL_ID"),
    DataTest("fact_sales", "PRIORITY_ID", "not_null"),
    DataTest("fact_sales", "PRIORITY_ID", "relationships", "dim_priority", "PRIORITY_ID"),
    DataTest("fact_sales", "UNITS_SOLD", "not_null"),
    DataTest("fact_sales", "UNIT_PRICE", "not_null"),
    DataTest("fact_sales", "UNIT_COST", "not_null"),
    DataTest("dim_date", "DATE_KEY", "not_null"),
    DataTest("dim_date", "DATE_KEY", "unique"),
    DataTest("dim_date", "FULL_DATE", "not_null"),
    DataTest("dim_geography", "GEOGRAPHY_ID", "not_null"),
    DataTest("dim_geography", "GEOGRAPHY_ID", "unique"),
    DataTest("dim_product", "PRODUCT_ID", "not_null"),
    DataTest("dim_product", "PRODUCT_ID", "unique"),
    DataTest("dim_channel", "CHANNEL_ID", "not_null"),
    DataTest("dim_channel", "CHANNEL_ID", "unique"),
    DataTest("dim_priority", "PRIORITY_ID", "not_null"),
    DataTest("dim_priority", "PRIORITY_ID", "unique"),
]

RESULT_SCHEMA = "TEST_NAME string, MODEL string, COLUMN_NAME string, KIND string, FAILURES bigint"


def column_failures(child: DataFrame, model: str, not_null: list[str],
                    relationships: list[DataTest], tables: dict[str, DataFrame]) -> DataFrame:
    """All not-null and relationship tests of one table in a single pass over it.

    Each parent's distinct keys are joined (left, broadcast behind the size check) to the
    child's foreign key, which keeps every child row exactly once; one aggregate then
    counts NULLs per tested column and, per relationship, the non-NULL keys without a
    parent match.
    """
    joined = child.select(*dict.fromkeys(not_null + [t.column for t in relationships]))
    for i, t in enumerate(relationships):
        keys = tables[t.parent].select(F.col(t.parent_column).alias(f"_pk{i}")).distinct()
        joined = joined.join(checked_broadcast(keys), F.col(t.column) == F.col(f"_pk{i}"), "left")
    counts = joined.agg(
        *[_count_if(F.col(c).isNull()).alias(f"_nn{i}") for i, c in enumerate(not_null)],
        *[_count_if(F.col(t.column).isNotNull() & F.col(f"_pk{i}").isNull()).alias(f"_rf{i}")
          for i, t in enumerate(relationships)])

    def row(name: str, column: str, kind: str, failures: str) -> Column:
        return F.struct(F.lit(name).alias("TEST_NAME"), F.lit(model).alias("MODEL"),
                        F.lit(column).alias("COLUMN_NAME"), F.lit(kind).alias("KIND"),
                        F.col(failures).alias("FAILURES"))
    rows = ([row(f"not_null_{model}_{c}", c, "not_null", f"_nn{i}") for i, c in enumerate(not_null)]
            + [row(t.name, t.column, "relationships", f"_rf{i}") for i, t in enumerate(relationships)])
    return counts.select(F.inline(F.array(*rows)))


def unique_failures(table: DataFrame, model: str, column: str) -> DataFrame:
    """Number of non-NULL values that occur more than once (the failing rows of the test)."""
    dups = (table.where(F.col(column).isNotNull()).groupBy(column).count()
            .where(F.col("count") > 1))
    return dups.agg(F.count(F.lit(1)).cast("bigint").alias("FAILURES")).select(
        F.lit(f"unique_{model}_{column}").alias("TEST_NAME"), F.lit(model).alias("MODEL"),
        F.lit(column).alias("COLUMN_NAME"), F.lit("unique").alias("KIND"), "FAILURES")


def run_data_tests(tables: dict[str, DataFrame], tests: list[DataTest] = DECLARED_TESTS,
                   kinds: set[str] | None = None) -> DataFrame:
    """One row per test with its failure count (0 = pass)."""
    selected = [t for t in tests if kinds is None or t.kind in kinds]
    parts: list[DataFrame] = []
    for model in dict.fromkeys(t.model for t in selected):
        cols = [t.column for t in selected if t.model == model and t.kind == "not_null"]
        rel = [t for t in selected if t.model == model and t.kind == "relationships"]
        if cols or rel:
            parts.append(column_failures(tables[model], model, cols, rel, tables))
    for t in selected:
        if t.kind == "unique":
            parts.append(unique_failures(tables[t.model], t.model, t.column))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("PASSED", F.col("FAILURES") == 0)


def integrity_broken() -> Column:
    """Whether an amount is not what units and prices, or revenue and cost, make it (unknown: not broken)."""
    differs = [F.round(F.col(a) - b, 2) != 0 for a, b in (
        ("TOTAL_REVENUE", F.col("UNITS_SOLD") * F.col("UNIT_PRICE")),
        ("TOTAL_COST", F.col("UNITS_SOLD") * F.col("UNIT_COST")),
        ("TOTAL_PROFIT", F.col("TOTAL_REVENUE") - F.col("TOTAL_COST")))]
    return differs[0] | differs[1] | differs[2]


def integrity_failures(fact: DataFrame) -> DataFrame:
    """Fact rows whose amounts disagree."""
    return fact.where(integrity_broken()).select("ORDER_ID", "UNITS_SOLD", "UNIT_PRICE", "UNIT_COST",
                                                 "TOTAL_REVENUE", "TOTAL_COST", "TOTAL_PROFIT")


def failing_rows(test: DataTest, tables: dict[str, DataFrame]) -> DataFrame:
    """The rows a declared test counts: NULLs, values that occur more than once (with their number),
    or rows whose key has no parent."""
    df, c = tables[test.model], F.col(test.column)
    if test.kind == "not_null":
        return df.where(c.isNull())
    if test.kind == "unique":
        return df.where(c.isNotNull()).groupBy(test.column).count().where(F.col("count") > 1)
    return anti_join(df, checked_broadcast(tables[test.parent].select(test.parent_column)),
                     test.column, test.parent_column)


def store_failures(failing: DataFrame, path: str) -> int:
    """Write failing rows for audit (``--store-failures``); returns the row count written.

    The count is an observed metric of the write itself (no second pass over the rows).
    """
    stored = Observation("stored_failures")
    failing.observe(stored, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
    return int(stored.get["rows"])


# The end-to-end assertions: a table of a layer and the rule it must keep.
FILLED, NO_NULL_ID = "has rows", "every row has an order id"
AMOUNTS_AGREE, PRODUCTS_KNOWN = "amounts agree with units and prices", "every product is in the dimension"
LAYER_CHECKS = [
    ("raw_sales", FILLED), ("stg_sales", FILLED), ("stg_sales", NO_NULL_ID),
    *((d, FILLED) for d in ("dim_date", "dim_geography", "dim_product", "dim_channel", "dim_priority")),
    ("fact_sales", FILLED), ("sales_performance", FILLED), ("fact_sales", AMOUNTS_AGREE), ("fact_sales", PRODUCTS_KNOWN)]


def check_name(table: str, rule: str) -> str:
    return f"{table}: {rule}"


def layer_checks(spark: SparkSession, layers: dict[str, DataFrame]) -> DataFrame:
    """One row per assertion: its count, which must be positive for ``FILLED`` and zero else.

    Each table is read once, for all its rules together.
    """
    known = layers["dim_product"].select("PRODUCT_ID", F.lit(True).alias("_known"))
    out = None
    for table in dict.fromkeys(t for t, _ in LAYER_CHECKS):
        df = layers[table]
        rules = [(i, rule) for i, (t, rule) in enumerate(LAYER_CHECKS, 1) if t == table]
        if any(rule == PRODUCTS_KNOWN for _, rule in rules):
            df = df.join(checked_broadcast(known), "PRODUCT_ID", "left")
        counted = {FILLED: F.lit(True), NO_NULL_ID: F.expr("order_id IS NULL") if "order_id" in df.columns else None,
                   AMOUNTS_AGREE: integrity_broken() if table == "fact_sales" else None,
                   PRODUCTS_KNOWN: F.expr("_known IS NULL") if "_known" in df.columns else None}
        values = df.agg(*[_count_if(counted[rule]).alias(f"v{i}") for i, rule in rules])
        rows = F.array(*[F.struct(
            F.lit(i).alias("CHECK_ID"), F.lit(check_name(table, rule)).alias("CHECK_NAME"),
            F.col(f"v{i}").alias("VALUE"),
            (F.col(f"v{i}") > 0 if rule == FILLED else F.col(f"v{i}") == 0).alias("PASSED")) for i, rule in rules])
        part = values.select(F.inline(rows))
        out = part if out is None else out.unionByName(part)
    return out
