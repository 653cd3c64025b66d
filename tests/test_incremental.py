"""Loads with a ledger, staging merged with new loads only, the id index of the fact, windows of reached months."""

import datetime as dt
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from salesmart.operators import upsert as U
from salesmart.operators.bitmaps import distinct_count, holders, id_sets, merged
from salesmart.operators.constraints import Refused, check_types, rules
from salesmart.plans import daily_run as K
from salesmart.plans import incremental as INC
from salesmart.plans.mart import WINDOW_REACH, add_window_metrics, aggregate_monthly, enrich
from salesmart.plans.model import Model
from salesmart.plans.staging import build_staging
from salesmart.schemas import RAW_MAX_LENGTH, RAW_SALES
from salesmart.sources import csv_ingest as CI
from salesmart.sources import loads as L
from salesmart.sources.testdata import raw_sales, write_feed

from conftest import SF_SMALL
from test_ingest import HEADER, _row, _write

RUN = dict(enforce_gates=False, enforce_tests=False)


def _rows(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)


# ------------------------------------------------------------------ sets of ids

def test_id_sets_are_exact(spark):
    rng = random.Random(1)
    rows = [(rng.choice("ab"), rng.choice([rng.randrange(200), rng.randrange(-10 ** 15, 10 ** 15)])) for _ in range(500)]
    rows += rows[:50] + [("a", None), ("c", None), ("b", 63), ("b", 64), ("b", -1)]
    df = spark.createDataFrame(rows, "k string, id long")
    sets = id_sets(df, ["k"], "id")
    ids = {k: {i for x, i in rows if x == k and i is not None} for k in "ab"}
    assert {r.k: r.n for r in distinct_count(sets, ["k"], "n").collect()} == {k: len(v) for k, v in ids.items()}
    assert distinct_count(merged(sets, []), [], "n").first().n == len(ids["a"] | ids["b"])
    for wanted in ([63], [10 ** 16], sorted(ids["a"] - ids["b"])[:3]):
        found = holders(sets, id_sets(spark.createDataFrame([(i,) for i in wanted], "id long"), [], "id"), ["k"])
        assert {r.k for r in found.collect()} == {k for k, v in ids.items() if v & set(wanted)}
    assert distinct_count(id_sets(df.limit(0), [], "id"), [], "n").first().n == 0


# ------------------------------------------------------------------ loads

def test_a_load_is_done_once(spark, tmp_dir):
    feed = _write(tmp_dir, [HEADER, _row(), _row(**{"Order ID": "7", "Units Sold": "x"}), "8,EU,FR"])
    first = L.load_feed(spark, feed, tmp_dir)
    assert (first["loaded"], first["skipped"], first["number"], first["repeated"]) == (1, 2, 1, False)
    assert L.load_feed(spark, feed, tmp_dir) == first | {"repeated": True}
    assert L.read_raw(spark, tmp_dir).count() == 1 and L.read_raw(spark, tmp_dir).schema == RAW_SALES
    rejected = {r._reject_reason: r for r in L.read_rejected(spark, tmp_dir).collect()}
    assert rejected["Item Type: missing field"]._line == "8,EU,FR" and rejected["Units Sold: not an integer"]._line is None
    assert '"Units Sold":"x"' in rejected["Units Sold: not an integer"]._source
    other = _write(tmp_dir, [HEADER, _row(**{"Order ID": "9"})], "other.csv")
    assert L.load_feed(spark, other, tmp_dir)["number"] == 2
    assert [r.ORDER_ID for r in L.read_raw(spark, tmp_dir, numbers=[2]).collect()] == [9]
    # an id given by the caller counts, whatever the file
    assert L.load_feed(spark, other, tmp_dir, load_id="day-3")["number"] == 3
    assert L.load_feed(spark, feed, tmp_dir, load_id="day-3")["repeated"]
    assert L.read_raw(spark, tmp_dir).count() == 3
    replaced = L.load_feed(spark, feed, tmp_dir, replace=True)
    assert replaced["number"] == 4 and L.load_numbers(spark, tmp_dir) == [4] and L.read_raw(spark, tmp_dir).count() == 1
    assert L.load_feed(spark, feed, tmp_dir, replace=True)["repeated"]
    with pytest.raises(FileNotFoundError):
        L.load_feed(spark, os.path.join(tmp_dir, "absent.csv"), tmp_dir)


@pytest.mark.parametrize("step", ["_commit", "sweep"])
def test_a_stopped_load_may_be_run_again(spark, tmp_dir, monkeypatch, step):
    feed = _write(tmp_dir, [HEADER, _row()])
    L.load_feed(spark, feed, tmp_dir, load_id="a")
    for replace in (False, True):
        load = f"b-{replace}"
        monkeypatch.setattr(U, step, lambda *a: (_ for _ in ()).throw(OSError("stopped")))
        with pytest.raises(OSError, match="stopped"):
            L.load_feed(spark, feed, tmp_dir, load_id=load, replace=replace)
        monkeypatch.undo()
        # readers see the table of before or of after, and the load is repeated without a lost or doubled row
        assert L.read_raw(spark, tmp_dir).count() in ((2, 1) if replace else (1, 2))
        L.load_feed(spark, feed, tmp_dir, load_id=load, replace=replace)
        assert L.read_raw(spark, tmp_dir).count() == (1 if replace else 2)


def test_empty_and_all_rejected_loads(spark, tmp_dir):
    assert L.load_feed(spark, _write(tmp_dir, [HEADER], "none.csv"), tmp_dir)["loaded"] == 0
    assert L.load_feed(spark, _write(tmp_dir, [HEADER, "1"], "bad.csv"), tmp_dir)["skipped"] == 1
    assert L.read_raw(spark, tmp_dir).count() == 0 and L.read_rejected(spark, tmp_dir).count() == 1


def test_what_the_declared_columns_do_not_admit_is_refused(spark, tmp_dir):
    L.load_feed(spark, _write(tmp_dir, [HEADER, _row()]), tmp_dir)
    rows, _ = CI.read_coerced(spark, _write(tmp_dir, [HEADER, _row(**{"Order ID": "5"})], "b.csv"), keep_line=True)
    with pytest.raises(Refused, match="REGION: longer than 100") as err:
        L.append_rows(spark, rows.withColumn("REGION", F.repeat(F.lit("x"), 101)), tmp_dir, "raw/sales", "long")
    assert err.value.counts == {"REGION: longer than 100": 1}
    with pytest.raises(Refused, match="UNITS_SOLD: string"):
        L.append_rows(spark, rows.withColumn("UNITS_SOLD", F.col("UNITS_SOLD").cast("string")), tmp_dir, "raw/sales", "type")
    assert L.load_numbers(spark, tmp_dir) == [1] and L.read_raw(spark, tmp_dir).count() == 1
    assert len([f for f in os.listdir(os.path.join(tmp_dir, "raw/sales")) if f.startswith("v-")]) == 1
    with pytest.raises(Refused, match="ORDER_ID: missing"):
        check_types(spark.range(1).withColumnRenamed("id", "a"), RAW_SALES)
    assert set(rules(RAW_SALES, RAW_MAX_LENGTH)) == {f"{c}: longer than {n}" for c, n in RAW_MAX_LENGTH.items()}


# ------------------------------------------------------------------ the daily job on the ledger

def _lines(orders):
    return [HEADER, *(_row(**{"Order ID": str(i), "Order Date": d, "Ship Date": s, "Units Sold": str(u), "Country": c})
                      for i, d, s, u, c in orders)]


def _same_as_full(spark, warehouse):
    m = Model(spark, raw=L.read_raw(spark, warehouse))
    assert _rows(K.read_staging(spark, warehouse)) == _rows(m.stg())
    ids = ("PRODUCT_ID", "GEOGRAPHY_ID", "CHANNEL_ID", "PRIORITY_ID")
    assert _rows(K.read_fact(spark, warehouse).drop(*ids)) == _rows(m.fact().drop(*ids))
    assert _rows(K.read_perf(spark, warehouse)) == _rows(m.perf())
    fact = U.read_table(spark, warehouse, K.FACT)
    index = U.read_index(spark, warehouse, K.FACT)
    assert _rows(index) == _rows(INC.month_index(fact))
    perf = U.read_table(spark, warehouse, K.PERF)
    assert _rows(U.read_index(spark, warehouse, K.PERF)) == _rows(INC.mart_index(perf))


def test_days_of_late_moved_and_repeated_orders(spark, tmp_dir, monkeypatch):
    days = [
        ("2024-06-01", [(i, f"2024-0{1 + i % 5}-1{i % 9}", "2024-05-25", i, "France" if i % 3 else "Spain") for i in range(1, 40)]),
        # an order of January that ships late, one that moves to May and leaves its month, one as it was
        ("2024-06-02", [(50, "2024-01-20", "2024-05-30", 5, "France"), (4, "2024-05-28", "2024-05-29", 9, "Spain"),
                        (7, "2024-03-17", "2024-05-25", 7, "France")]),
        ("2024-06-03", [(51, "2024-06-02", "2024-06-03", 2, "Malta")]),  # a new country and month
        ("2024-06-04", [(50, "2024-06-03", "2024-06-04", 6, "France")]),  # the late order moves on
    ]
    for number, (day, orders) in enumerate(days):
        L.load_feed(spark, _write(tmp_dir, _lines(orders), f"{day}.csv"), tmp_dir)
        if number == 2:  # the job stops behind staging, and once more behind the fact
            for what in ("upsert_fact_partitions", "read_perf"):
                with monkeypatch.context() as patch:
                    patch.setattr(K, what, lambda *a, **b: (_ for _ in ()).throw(OSError("stopped")))
                    with pytest.raises(OSError, match="stopped"):
                        K.run_daily(spark, None, tmp_dir, as_of=day, raw_root=tmp_dir, **RUN)
        report = K.run_daily(spark, None, tmp_dir, as_of=day, raw_root=tmp_dir, **RUN)
        assert report.mode == ("incremental" if number else "full")
        _same_as_full(spark, tmp_dir)
    # a run without new loads writes no table
    before = {t: U.table_parts(spark, tmp_dir, t) for t in (K.STG, K.FACT, K.PERF, "marts/dim_geography")}
    K.run_daily(spark, None, tmp_dir, as_of=days[-1][0], raw_root=tmp_dir, **RUN)
    assert {t: U.table_parts(spark, tmp_dir, t) for t in before} == before
    # a replaced feed: staging and the fact are made anew
    L.load_feed(spark, _write(tmp_dir, _lines(days[0][1][:9]), "again.csv"), tmp_dir, replace=True)
    K.run_daily(spark, None, tmp_dir, as_of="2024-06-05", raw_root=tmp_dir, full_refresh=True, **RUN)
    _same_as_full(spark, tmp_dir)


def test_a_run_opens_only_what_it_needs(spark, tmp_dir):
    """New loads, buckets of their orders, months of the fact that hold or get them."""
    orders = [(i, f"2024-0{1 + i % 5}-1{i % 9}", "2024-05-25", i, "France") for i in range(1, 60)]
    L.load_feed(spark, _write(tmp_dir, _lines(orders), "a.csv"), tmp_dir)
    K.run_daily(spark, None, tmp_dir, as_of="2024-06-01", raw_root=tmp_dir, **RUN)
    L.load_feed(spark, _write(tmp_dir, _lines([(4, "2024-05-28", "2024-05-29", 9, "France")]), "b.csv"), tmp_dir)
    assert all("OUTCOME=loaded" in f and L.ledger(spark, tmp_dir)[1]["path"] in f
               for f in L.read_raw(spark, tmp_dir, numbers=[2]).inputFiles())
    state = U.read_table(spark, tmp_dir, K.STG)
    rows, touched = INC.merge_staging(state, L.read_raw(spark, tmp_dir, numbers=[2]), K.STAGING_BUCKETS, 2)
    assert len(touched) == 1
    filters = re.findall(r"PartitionFilters: \[([^\]]*)\]", rows._jdf.queryExecution().toString())
    assert any(f"{INC.BUCKET}" in f for f in filters)
    # the months that hold an order come from the index alone
    index = U.read_index(spark, tmp_dir, K.FACT)
    batch = spark.createDataFrame([(4,), (9,)], "ORDER_ID long")
    assert INC.months_holding(index, batch) == [202405]
    found = holders(index, id_sets(batch, [], "ORDER_ID"), [INC.PART_COL])
    assert any("/ix-" in f for f in found.inputFiles()) and not any(f"{K.FACT}/v-" in f for f in found.inputFiles())
    plan = INC.changed_rows(U.read_table(spark, tmp_dir, K.FACT), U.read_table(spark, tmp_dir, K.FACT).limit(1), [202405])
    filters = re.findall(r"PartitionFilters: \[([^\]]*)\]", plan._jdf.queryExecution().toString())
    assert any("ORDER_MONTH_KEY" in f and "202405" in f for f in filters)
    K.run_daily(spark, None, tmp_dir, as_of="2024-06-02", raw_root=tmp_dir, **RUN)
    only = [p["only"] for p in U.table_parts(spark, tmp_dir, K.FACT) if "only" in p]
    assert only == [[202405]]  # order 4 was of May and stays there: no other month is written
    _same_as_full(spark, tmp_dir)


# ------------------------------------------------------------------ windows

def test_reached_months_by_definition(spark):
    """Random row counts: the months whose rows see a changed month in some frame, from all rows in order."""
    rng = random.Random(7)
    keys = ["PRODUCT_CATEGORY", "REGION", "SALES_CHANNEL"]
    for _ in range(4):
        def counts():
            return {(m, c, r, s): rng.randint(1, 4) for m in range(202401, 202413) for c in "AB" for r in "xy" for s in "no"
                    if rng.random() < 0.35}
        before = counts()
        changed = sorted(rng.sample(range(202401, 202413), 2))
        after = {k: v for k, v in before.items() if k[0] not in changed}
        after |= {k: v for k, v in counts().items() if k[0] in changed}
        frames = [spark.createDataFrame([(*k, n) for k, n in x.items()], f"{INC.PERF_PART} int, PRODUCT_CATEGORY string, "
                                        "REGION string, SALES_CHANNEL string, n long") for x in (before, after)]
        reached, needed = INC.window_months(*frames, changed)
        want, past = set(changed), set()
        lines = sorted(k for k, n in after.items() for _ in range(n))
        for names, reach in WINDOW_REACH:
            at = [1 + keys.index(n) for n in names]
            of = {}
            for k in lines:
                of.setdefault(tuple(k[i] for i in at), []).append(k[0])
            for part, months in of.items():
                hit = [c for c in changed if any(k[0] == c and tuple(k[i] for i in at) == part for k in [*before, *after])]
                for c in hit:
                    want |= set([m for m in months if m > c][:reach])
        for names, reach in WINDOW_REACH:
            at = [1 + keys.index(n) for n in names]
            for part in {tuple(k[i] for i in at) for k in lines}:
                months = [k[0] for k in lines if tuple(k[i] for i in at) == part]
                for d in want:
                    if d in months:
                        past |= set(months[max(0, months.index(d) - reach):months.index(d)])
        assert reached == sorted(want) and needed == sorted(past - want)


def test_windows_of_reached_months_equal_a_full_refresh(spark):
    """Changes that add, drop and empty months and window partitions."""
    m = Model(spark, sf_dir=SF_SMALL)
    dims = m.dims()
    args = [dims[d] for d in ("dim_product", "dim_geography", "dim_channel", "dim_priority", "dim_date")]
    fact = m.fact().where(F.col("ORDER_ID") % 7 == 0)
    stored = add_window_metrics(aggregate_monthly(enrich(fact, *args))).withColumn(INC.PERF_PART, INC.perf_month()).cache()
    month = INC.month_key()
    for changed, keep in (([199603], F.lit(False)), ([199701, 199805], F.col("GEOGRAPHY_ID") % 2 == 0)):
        now = fact.where(~month.isin(changed) | keep)
        rows, reached = INC.refresh_months(stored, INC.mart_index(stored), now, dims, changed)
        got = stored.where(~F.col(INC.PERF_PART).isin(reached)).unionByName(rows.select(*stored.columns)).drop(INC.PERF_PART)
        assert _rows(got) == _rows(add_window_metrics(aggregate_monthly(enrich(now, *args))))
        assert len(reached) < 40 < stored.select(INC.PERF_PART).distinct().count()


def test_merge_keeps_the_version_of_what_does_not_change(spark):
    raw = raw_sales(spark, SF_SMALL).where("ORDER_ID < 900")
    state = INC.bucketed(build_staging(raw), 4, 1).cache()
    rows, touched = INC.merge_staging(state, raw, 4, 2)   # the same rows once more
    assert touched == [0, 1, 2, 3] and rows.where(f"{INC.VERSION} = 2").count() == 0
    changed = raw.where("ORDER_ID < 60").withColumn("ORDER_DATE", F.lit(dt.date(2030, 1, 1)))
    rows, _ = INC.merge_staging(state, changed, 4, 2)
    assert {r.order_id for r in rows.where(f"{INC.VERSION} = 2").collect()} == {r.ORDER_ID for r in changed.collect()}


def test_feed_of_the_adapter_through_the_ledger(spark, tmp_dir):
    # Dates that read as two formats move orders about, so the 30 days begin before all of them.
    raw = raw_sales(spark, SF_SMALL)
    L.load_feed(spark, write_feed(raw.where("ORDER_DATE <= '1998-06-30'"), os.path.join(tmp_dir, "f1")), tmp_dir)
    K.run_daily(spark, None, tmp_dir, as_of="1995-01-01", raw_root=tmp_dir, **RUN)
    L.load_feed(spark, write_feed(raw.where("ORDER_DATE > '1998-06-30'"), os.path.join(tmp_dir, "f2")), tmp_dir)
    K.run_daily(spark, None, tmp_dir, as_of="1995-01-01", raw_root=tmp_dir, **RUN)
    _same_as_full(spark, tmp_dir)
