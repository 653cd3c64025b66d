"""The daily job (K1): gates -> staging -> dimensions -> fact -> mart -> data tests.

One driver function runs the layers in order and stops at the first failed step. Every
layer is a Parquet table under ``warehouse``:

    raw/sales                      loads of the CSV ingest, in a ledger (``sources.loads``)
    staging/stg_sales/v-*/_BUCKET=n/
                                   the latest row of each order, by hash bucket; a later run merges the
                                   loads that the ledger has gained into the buckets of their orders
    marts/dim_*/v-*                first run: full build; later runs keep ids, append keys
    marts/fact_sales/v-*/ORDER_MONTH_KEY=yyyymm/
                                   first run: full build; later runs upsert by ORDER_ID, writing the
                                   months that the batch changes to a new folder; the order ids of each
                                   month are kept as exact sets (``ix-*``)
    consumption/sales_performance/v-*/PERF_MONTH_KEY=yyyymm/
                                   the same months re-aggregated, and the windows of the months that they reach
    dq/<test>                      failing rows of every failed test (store-failures)

Tables are committed after their write (``operators.upsert``): a run that stops anywhere
leaves each table as its last commit has it, and may simply be run again. Each commit notes which state of staging it
goes back to, so a later run takes up all rows staged since, whatever was missed between. Where ``raw`` is
given as rows without a ledger, staging is rebuilt and all its rows count as new.
"""

from __future__ import annotations

import datetime as _dt
import logging
import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import quality as Q
from ..operators.joins import checked_broadcast
from ..operators.upsert import (
    append_new_ids,
    current_version,
    last_commit,
    note,
    read_index,
    read_table,
    replace_partitions,
    table_parts,
    write_version,
)
from ..session import materialize
from ..sources.loads import load_numbers, read_raw
from . import dims as DM
from . import incremental as INC
from .fact import FACT_COLUMNS, PART_COL, build_fact
from .mart import build_performance, enrich
from .staging import build_staging

log = logging.getLogger(__name__)

STG = "staging/stg_sales"
STAGING_BUCKETS = 16  # of a new table; at scale, its bytes / 1 GB
FACT = "marts/fact_sales"
PERF = "consumption/sales_performance"
FACT_SORT = ["GEOGRAPHY_ID"]
DIM_KEYS = {
    "dim_geography": (["REGION", "COUNTRY"], "GEOGRAPHY_ID", DM.geography_keys,
                      {"region": "REGION", "country": "COUNTRY"}),
    "dim_product": (["PRODUCT_CATEGORY"], "PRODUCT_ID", DM.product_keys, {"item_type": "PRODUCT_CATEGORY"}),
    "dim_channel": (["SALES_CHANNEL"], "CHANNEL_ID", DM.channel_keys, {"sales_channel": "SALES_CHANNEL"}),
    "dim_priority": (["ORDER_PRIORITY"], "PRIORITY_ID", DM.priority_keys, {"order_priority": "ORDER_PRIORITY"}),
}


class _Clock:
    def __init__(self, sink: dict | None):
        self.sink, self.step, self.t0 = sink, None, 0.0

    def start(self, step: str) -> None:
        self.stop()
        self.step, self.t0 = step, time.perf_counter()

    def stop(self) -> None:
        if self.sink is not None and self.step is not None:
            self.sink[self.step] = self.sink.get(self.step, 0.0) + time.perf_counter() - self.t0
        self.step = None


@dataclass
class RunReport:
    mode: str
    gates: list = field(default_factory=list)
    tests: list = field(default_factory=list)
    tables: dict = field(default_factory=dict)
    failed_step: str | None = None


def _with_part(fact: DataFrame) -> DataFrame:
    return fact.withColumn(PART_COL, INC.month_key())


def read_fact(spark: SparkSession, warehouse: str, with_month: bool = False) -> DataFrame | None:
    t = read_table(spark, warehouse, FACT, PART_COL)
    return None if t is None else t.select(*FACT_COLUMNS, *([PART_COL] if with_month else []))


def read_perf(spark: SparkSession, warehouse: str) -> DataFrame | None:
    t = read_table(spark, warehouse, PERF)
    return None if t is None else t.drop(INC.PERF_PART)


def upsert_fact_partitions(spark: SparkSession, warehouse: str, batch: DataFrame, notes: dict | None = None) -> list[int]:
    """Delete+insert by ORDER_ID, rewriting only affected months; returns these (yyyymm).

    Affected are the months the batch writes to and those that hold one of its ids before (an
    order whose date changed moves). There is one number per month, so they come to the driver
    and become a literal partition filter: only their folders are read. The new content is
    written beside them and replaces them in one commit.

    The months that hold the ids come from the table's index, no other month is opened; and rows of the
    batch that the table holds exactly so are left out, so a month is only written where it changes.
    A table without index (written by hand) is searched instead.
    """
    existing = read_table(spark, warehouse, FACT, PART_COL)
    # Written once: the month list and the new content both read it.
    batch = materialize(_with_part(batch), "fact-batch")
    index = read_index(spark, warehouse, FACT)
    if index is None:
        months = INC.touched_months(existing, batch)
    else:
        held = INC.months_holding(index, batch)
        batch = materialize(INC.changed_rows(existing, batch, held), "fact-changed")
        new = [r[PART_COL] for r in batch.select(PART_COL).distinct().collect()]
        months = sorted({*new, *(INC.months_holding(index, batch) if new else [])})
    if not months:
        return []
    kept = existing.where(F.col(PART_COL).isin(months)).join(
        checked_broadcast(batch.select("ORDER_ID")), "ORDER_ID", "left_anti")
    replace_partitions(kept.unionByName(batch.select(*existing.columns)), warehouse, FACT, PART_COL, months, FACT_SORT,
                       index=INC.month_index, notes=notes)
    return months


def read_staging(spark: SparkSession, warehouse: str, since: int | None = None) -> DataFrame:
    """The staged rows, or those that a run after the state ``since`` has written."""
    t = read_table(spark, warehouse, STG)
    if since is not None:
        t = t.where(F.col(INC.VERSION) > since)
    return t.drop(INC.BUCKET, INC.VERSION)


def stage(spark: SparkSession, raw: DataFrame, warehouse: str, loads: list[int] | None, rebuild: bool,
          raw_root: str | None, buckets: int = STAGING_BUCKETS) -> int:
    """Bring staging up to date; returns the number of its state.

    With a ledger only the loads that staging has not seen are read, and only their orders' buckets
    written. A replaced table (a load that staging has seen is gone) is staged anew.
    """
    noted = last_commit(spark, warehouse, STG)
    version = noted.get("version", 0) + 1
    seen = set(noted.get("loads") or [])
    if not rebuild and loads is not None and noted.get("loads") is not None and seen <= set(loads):
        fresh = [n for n in loads if n not in seen]
        if not fresh:
            return noted["version"]
        new = read_raw(spark, raw_root, numbers=fresh)
        rows, touched = INC.merge_staging(read_table(spark, warehouse, STG), new, noted["buckets"], version)
        replace_partitions(rows, warehouse, STG, INC.BUCKET, touched, notes=noted | {"loads": loads, "version": version})
        return version
    rows = INC.bucketed(build_staging(raw), buckets, version)
    write_version(rows, warehouse, STG, partition_by=[INC.BUCKET], rebalance_by=[INC.BUCKET],
                  notes={"loads": loads, "version": version, "buckets": buckets})
    return version


class RunFailure(RuntimeError):
    """A failed step; ``report`` tells how far the run came."""

    def __init__(self, message: str, report: RunReport):
        super().__init__(message)
        self.report = report


def run_daily(spark: SparkSession, raw: DataFrame | None, warehouse: str,
              as_of: str | _dt.date | None = None, full_refresh: bool = False,
              enforce_gates: bool = True, enforce_tests: bool = True,
              timings: dict | None = None, raw_root: str | None = None) -> RunReport:
    """Run the layers in order; ``timings`` (if given) receives seconds per step.

    ``raw_root`` names the warehouse that ``sources.loads`` has loaded ``raw/sales`` into, and ``raw`` may then be
    left out; without it ``raw`` is all there is and staging is rebuilt.
    """
    clock = _Clock(timings)
    loads = load_numbers(spark, raw_root) if raw_root else None
    if raw is None:
        raw = read_raw(spark, raw_root)
    run_date = str(as_of or _dt.date.today())
    fact_before = current_version(spark, warehouse, FACT)
    is_incremental = not full_refresh and fact_before is not None
    report = RunReport(mode="incremental" if is_incremental else "full")

    # 1. source gates: one scan, all six evaluated, then stop if any failed
    clock.start("validate_source")
    report.gates = [r.asDict() for r in Q.run_gates(raw, as_of, raise_on_failure=False)]
    if enforce_gates and any(g["FAILED"] for g in report.gates):
        report.failed_step = "validate_source"
        failure = Q.GateFailure([(g["GATE"], g["VALUE"]) for g in report.gates if g["FAILED"]])
        failure.report = report
        raise failure

    # 2. staging (six models read it)
    clock.start("staging")
    state = stage(spark, raw, warehouse, loads, not is_incremental, raw_root)
    stg = read_staging(spark, warehouse)
    made = {"staging": state}

    # 3. dimensions: six independent builds, submitted as concurrent jobs
    clock.start("dimensions")

    def build_dim(name: str) -> DataFrame:
        prev = read_table(spark, warehouse, f"marts/{name}") if is_incremental else None
        since = last_commit(spark, warehouse, f"marts/{name}").get("staging")
        if prev is not None and since == state:
            return prev
        new = read_staging(spark, warehouse, since)
        if name == "dim_date":
            built = DM.build_dim_date(stg) if prev is None else INC.dim_date_missing(prev, new)
        else:
            natural, id_col, keys_fn, rename = DIM_KEYS[name]
            if prev is None:
                built = getattr(DM, f"build_{name}")(stg)
            else:
                cand = keys_fn(new).select(*[F.col(k).alias(v) for k, v in rename.items()])
                stable = append_new_ids(prev.select(id_col, *natural), cand, natural, id_col)
                built = stable if name != "dim_priority" else stable.select(
                    id_col, "ORDER_PRIORITY",
                    DM.priority_label(F.col("ORDER_PRIORITY")).alias("PRIORITY_LABEL"),
                    DM.priority_sort(F.col("ORDER_PRIORITY")).alias("PRIORITY_SORT_ORDER"))
        write_version(built, warehouse, f"marts/{name}", notes=made)
        return read_table(spark, warehouse, f"marts/{name}")

    names = ["dim_date", *DIM_KEYS]
    with ThreadPoolExecutor(max_workers=len(names)) as pool:
        dims: dict[str, DataFrame] = dict(zip(names, pool.map(build_dim, names)))

    # 4. fact
    clock.start("fact")
    made["as_of"] = run_date
    if not is_incremental:
        fact = build_fact(stg, dims["dim_product"], dims["dim_geography"], dims["dim_channel"],
                          dims["dim_priority"], dims["dim_date"])
        write_version(_with_part(fact), warehouse, FACT, partition_by=[PART_COL],
                      sort_within=FACT_SORT, rebalance_by=[PART_COL], index=INC.month_index, notes=made)
        months = None
    else:
        noted = last_commit(spark, warehouse, FACT)
        # An order of the 30 days that was staged before the last run was within the 30 days of that run too,
        # unless the clock was set back.
        since = noted.get("staging") if noted.get("as_of", "9999") <= run_date else None
        months = []
        if since != state:
            batch = INC.fact_increment(read_staging(spark, warehouse, since), dims, as_of)
            months = upsert_fact_partitions(spark, warehouse, batch, notes=made)
        if not months and noted != made:
            note(spark, warehouse, FACT, notes=made)
    fact = read_fact(spark, warehouse)

    # 5. consumption mart
    clock.start("consumption")
    stored = table_parts(spark, warehouse, PERF)
    # A run that stopped between fact and mart left months that only the fact has: the mart's commit
    # names the fact it was made from, and where that was not the last, the whole mart is made anew.
    made_from = current_version(spark, warehouse, FACT)
    counts = read_index(spark, warehouse, PERF) if stored else None
    if is_incremental and counts is not None and stored[-1].get("made_from") == fact_before:
        if months:
            rows, reached = INC.refresh_months(read_table(spark, warehouse, PERF), counts,
                                               read_fact(spark, warehouse, with_month=True), dims, months)
            replace_partitions(rows, warehouse, PERF, INC.PERF_PART, reached, made_from=made_from, index=INC.mart_index)
    else:
        perf = build_performance(enrich(fact, dims["dim_product"], dims["dim_geography"],
                                        dims["dim_channel"], dims["dim_priority"], dims["dim_date"]))
        write_version(perf.withColumn(INC.PERF_PART, INC.perf_month()), warehouse, PERF, partition_by=[INC.PERF_PART],
                      rebalance_by=[INC.PERF_PART], made_from=made_from, index=INC.mart_index)
    perf = read_perf(spark, warehouse)

    # 6. data tests (declared tests + financial integrity), failing rows stored
    clock.start("data_tests")
    layers = {"raw_sales": raw, "stg_sales": stg, "fact_sales": fact, "sales_performance": perf, **dims}
    results = Q.run_data_tests(layers).collect()  # one row per declared test
    # The failing rows of every failed test are kept; a passed test costs nothing here.
    declared = {t.name: t for t in Q.DECLARED_TESTS}
    for r in results:
        if not r["PASSED"]:
            Q.store_failures(Q.failing_rows(declared[r["TEST_NAME"]], layers), f"{warehouse}/dq/{r['TEST_NAME']}")
    integrity = Q.integrity_failures(fact)
    n_integrity = Q.store_failures(integrity, f"{warehouse}/dq/test_fact_sales_costs")
    report.tests = [r.asDict() for r in results] + [
        {"TEST_NAME": "test_fact_sales_costs", "FAILURES": n_integrity, "PASSED": n_integrity == 0}]
    report.tables = {"stg_sales": current_version(spark, warehouse, STG),
                     "fact_sales": current_version(spark, warehouse, FACT),
                     "sales_performance": current_version(spark, warehouse, PERF)}
    clock.stop()
    failed = [t["TEST_NAME"] for t in report.tests if not t["PASSED"]]
    if failed and enforce_tests:
        report.failed_step = "dbt_test"
        raise RunFailure(f"{len(failed)} data test(s) failed: {failed}", report)
    log.info("daily run (%s) done", report.mode)
    return report
