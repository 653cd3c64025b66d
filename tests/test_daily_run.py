"""K1 job: full run, then an incremental run, against the lazily built model."""

import os

import pytest
from pyspark.sql import functions as F

from salesmart.operators.quality import GateFailure
from salesmart.operators.upsert import read_table
from salesmart.plans.daily_run import read_fact, run_daily
from salesmart.plans.model import Model
from salesmart.sources.testdata import raw_sales

from conftest import SF_SMALL

AS_OF = "1998-06-30"


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_gates_stop_the_run(spark, tmp_dir):
    raw = raw_sales(spark, SF_SMALL)  # the adapter has ship dates before order dates
    with pytest.raises(GateFailure) as err:
        run_daily(spark, raw, tmp_dir, as_of=AS_OF)
    assert any("SHIP_DATE" in name for name, _ in err.value.failures)
    assert err.value.report.failed_step == "validate_source"
    assert read_table(spark, tmp_dir, "marts/fact_sales") is None  # nothing written


def test_full_then_incremental_equals_model(spark, tmp_dir):
    raw = raw_sales(spark, SF_SMALL)
    first = raw.where(F.col("ORDER_DATE") <= AS_OF)
    r1 = run_daily(spark, first, tmp_dir, as_of=AS_OF, enforce_gates=False)
    assert r1.mode == "full"
    assert all(t["PASSED"] for t in r1.tests)
    r2 = run_daily(spark, raw, tmp_dir, as_of=AS_OF, enforce_gates=False)
    assert r2.mode == "incremental"
    # Every order after the run date falls in the 30-day increment, so the incremental
    # run must land exactly on a full rebuild over all rows.
    m = Model(spark, raw=raw)
    assert _rows(read_table(spark, tmp_dir, "marts/dim_date")) == _rows(m.dim_date())
    fact = read_fact(spark, tmp_dir)
    assert fact.count() == fact.select("ORDER_ID").distinct().count()
    assert fact.count() == m.fact().count()
    perf = read_table(spark, tmp_dir, "consumption/sales_performance")
    assert _rows(perf.select(*m.perf().columns)) == _rows(m.perf())
    # a third run with the same input changes nothing (idempotent upsert)
    before = _rows(fact)
    run_daily(spark, raw, tmp_dir, as_of=AS_OF, enforce_gates=False)
    assert _rows(read_fact(spark, tmp_dir)) == before


def _fact_rows(spark, warehouse):
    from salesmart.plans.daily_run import FACT, PART_COL
    t = read_table(spark, warehouse, FACT, PART_COL)
    return sorted((r.ORDER_ID, r.ORDER_DATE_KEY, r.UNITS_SOLD) for r in t.collect())


def test_fact_upsert_moves_an_order_and_empties_a_month(spark, tmp_dir, monkeypatch):
    from salesmart.operators import upsert as U
    from salesmart.plans.daily_run import FACT, PART_COL, _with_part, upsert_fact_partitions
    schema = "ORDER_ID long, ORDER_DATE_KEY int, UNITS_SOLD int, GEOGRAPHY_ID int"
    rows = [(1, 19980105, 10, 1), (2, 19980110, 20, 2), (3, 19980203, 30, 1), (4, 19980301, 40, 1)]
    U.write_version(_with_part(spark.createDataFrame(rows, schema)), tmp_dir, FACT, partition_by=[PART_COL])
    before = _fact_rows(spark, tmp_dir)
    # order 3 moves from February to January (February is left empty); order 2 changes
    batch = spark.createDataFrame([(3, 19980120, 33, 1), (2, 19980110, 22, 2)], schema)
    # a stop before the commit leaves the table as it was
    monkeypatch.setattr(U, "_commit", lambda *a: (_ for _ in ()).throw(OSError("stopped")))
    with pytest.raises(OSError, match="stopped"):
        upsert_fact_partitions(spark, tmp_dir, batch)
    monkeypatch.undo()
    assert _fact_rows(spark, tmp_dir) == before
    for want in ([199801, 199802], [199801]):   # the second run re-applies the batch: nothing changes
        assert upsert_fact_partitions(spark, tmp_dir, batch) == want
        assert _fact_rows(spark, tmp_dir) == [
            (1, 19980105, 10), (2, 19980110, 22), (3, 19980120, 33), (4, 19980301, 40)]
    # old folders go, the ones of the last two commits stay
    for _ in range(3):
        upsert_fact_partitions(spark, tmp_dir, batch)
    folders = [f for f in os.listdir(os.path.join(tmp_dir, FACT)) if f.startswith("v-")]
    assert len(folders) <= 4


def test_another_writer_is_noticed(spark, tmp_dir, monkeypatch):
    from salesmart.operators import upsert as U
    df = spark.createDataFrame([(1,)], "a int")
    U.write_version(df, tmp_dir, "t")
    monkeypatch.setattr(U, "_commit_numbers", lambda *a: [])
    with pytest.raises(OSError, match="another writer"):
        U.write_version(df, tmp_dir, "t")
    monkeypatch.undo()
    assert read_table(spark, tmp_dir, "t").count() == 1


def _order(raw, order_id, ordered, shipped, units):
    return (raw.limit(1).withColumn("ORDER_ID", F.lit(order_id).cast("long"))
            .withColumn("ORDER_DATE", F.lit(ordered).cast("date")).withColumn("SHIP_DATE", F.lit(shipped).cast("date"))
            .withColumn("UNITS_SOLD", F.lit(units).cast("int")))


def _same_as_full(spark, warehouse, raw):
    m = Model(spark, raw=raw)
    assert _rows(read_fact(spark, warehouse).drop("PRODUCT_ID", "GEOGRAPHY_ID", "CHANNEL_ID", "PRIORITY_ID")) == _rows(
        m.fact().drop("PRODUCT_ID", "GEOGRAPHY_ID", "CHANNEL_ID", "PRIORITY_ID"))
    perf = read_table(spark, warehouse, "consumption/sales_performance")
    assert _rows(perf.select(*m.perf().columns)) == _rows(m.perf())


def test_late_and_moved_orders_and_a_stopped_run(spark, tmp_dir, monkeypatch):
    """Orders of old months that ship late or move reach the mart; a stop before the mart is made good."""
    from salesmart.plans import daily_run as K
    source = raw_sales(spark, SF_SMALL)
    run = dict(enforce_gates=False, enforce_tests=False)
    first = _order(source, 1, "2024-01-10", "2024-01-12", 2).unionByName(_order(source, 2, "2024-01-15", "2024-05-25", 3))
    run_daily(spark, first, tmp_dir, as_of="2024-06-01", **run)
    # a late order of January; order 2 moves to May and leaves January
    second = (_order(source, 1, "2024-01-10", "2024-01-12", 2).unionByName(_order(source, 2, "2024-05-20", "2024-05-25", 3))
              .unionByName(_order(source, 3, "2024-01-20", "2024-05-30", 5)))
    monkeypatch.setattr(K.INC, "refresh_months", lambda *a: (_ for _ in ()).throw(OSError("stopped")))
    with pytest.raises(OSError, match="stopped"):
        run_daily(spark, second, tmp_dir, as_of="2024-06-02", **run)
    monkeypatch.undo()
    assert run_daily(spark, second, tmp_dir, as_of="2024-06-02", **run).mode == "incremental"
    _same_as_full(spark, tmp_dir, second)
    third = second.where("ORDER_ID <> 3").unionByName(_order(source, 3, "2024-02-20", "2024-05-30", 5))
    run_daily(spark, third, tmp_dir, as_of="2024-06-03", **run)
    _same_as_full(spark, tmp_dir, third)
    assert run_daily(spark, third, tmp_dir, as_of="2024-06-03", full_refresh=True, **run).mode == "full"
    _same_as_full(spark, tmp_dir, third)


def test_mart_refresh_reads_touched_months_only(spark, tmp_dir):
    from salesmart.plans.daily_run import FACT, PART_COL
    from salesmart.plans.incremental import in_months
    raw = raw_sales(spark, SF_SMALL)
    run_daily(spark, raw, tmp_dir, as_of=AS_OF, enforce_gates=False)
    plan = in_months(read_table(spark, tmp_dir, FACT, PART_COL), [199806])._jdf.queryExecution().toString()
    assert "ORDER_MONTH_KEY" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_failed_tests_carry_the_report(spark, tmp_dir, monkeypatch):
    from salesmart.plans import daily_run as K
    monkeypatch.setattr(K.Q, "store_failures", lambda *a: 1)
    with pytest.raises(K.RunFailure) as err:
        run_daily(spark, raw_sales(spark, SF_SMALL), tmp_dir, as_of=AS_OF, enforce_gates=False)
    assert err.value.report.failed_step == "dbt_test" and err.value.report.tests
