"""Incremental maintenance of the marts (I1-I5, T5-T7).

* ``fact_increment``: the literal incremental source (orders whose later date is within
  30 days of the run date), joined to the current dimensions; upserted by ORDER_ID.
* ``refresh_mart``: re-aggregates the whole months that the upsert changed (those its batch
  writes to and those it takes orders from, however old), keeps the stored aggregate of every
  other month, and recomputes the windows over the merged history, so an incremental run
  gives exactly the full-refresh result.
* ``month_index`` and ``changed_rows``: the fact's table keeps, beside its folders, the exact sets of
  order ids of each month. The months that hold a batch's orders are read off the sets; only these
  are then compared with the batch, and only rows that differ are written.
* ``window_months`` and ``refresh_months``: the mart's table keeps its row counts per month and window
  partition. From these follow the months whose windows a change reaches (those within 11, 2 or 1
  rows behind it) and the months that the windows of these look back on; nothing else is read.
* ``merge_staging``: the latest row of each order, kept in hash buckets, merged with new rows only.
* ``literal_mart_increment``: the mart built from the 30-day fact slice alone and
  delete+inserted on the seven-column key (kept for comparison; it undercounts partial
  months and its windows only see the slice).
* ``dim_date_above_watermark`` / ``dim_date_missing``: the two ways to add dates.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dates as D
from ..operators.bitmaps import holders, id_sets
from ..operators.dedup import first_per_key
from ..operators.joins import checked_broadcast
from ..operators.upsert import above_watermark, upsert
from ..schemas import PERF_GROUP, PERF_KEY
from ..session import materialize
from . import dims as DM
from .fact import PART_COL, build_fact, recent_slice
from .mart import WINDOW_REACH, add_window_metrics, aggregate_monthly, build_performance, enrich
from .staging import dedup_ordering, staged_rows

AGG_COLUMNS = PERF_GROUP + ["ORDER_COUNT", "TOTAL_UNITS_SOLD", "TOTAL_REVENUE", "TOTAL_COST",
                            "TOTAL_PROFIT", "AVG_UNIT_PRICE", "AVG_UNIT_COST", "AVG_SHIPPING_DAYS",
                            "GROSS_MARGIN_PCT"]


def fact_increment(stg: DataFrame, dims: dict[str, DataFrame], as_of, days: int = 30) -> DataFrame:
    return build_fact(recent_slice(stg, as_of, days), dims["dim_product"], dims["dim_geography"],
                      dims["dim_channel"], dims["dim_priority"], dims["dim_date"])


def upsert_fact(target: DataFrame, batch: DataFrame) -> DataFrame:
    return upsert(target, batch, ["ORDER_ID"])


def month_key(date_key: str = "ORDER_DATE_KEY"):
    """yyyymm of a yyyymmdd key."""
    return F.floor(F.col(date_key) / 100).cast("int")


def touched_months(previous: DataFrame, batch: DataFrame) -> list[int]:
    """The months (yyyymm) an upsert of ``batch`` changes: those it writes to and those that
    hold one of its orders before. One number per month, so the list comes to the driver."""
    ids = checked_broadcast(batch.select("ORDER_ID"))
    holders = previous.join(ids, "ORDER_ID", "left_semi").select(month_key().alias("m"))
    found = holders.unionByName(batch.select(month_key().alias("m"))).distinct().collect()
    return sorted(r["m"] for r in found)


def month_index(fact: DataFrame) -> DataFrame:
    """The index of the stored fact: the order ids of each month as exact sets, sorted by word so that a
    lookup of few ids reads few row groups."""
    return id_sets(fact, [PART_COL], "ORDER_ID").sort("word")


def months_holding(index: DataFrame, rows: DataFrame) -> list[int]:
    """The months that hold an order of ``rows`` now, from the index alone."""
    found = holders(index, checked_broadcast(materialize(id_sets(rows, [], "ORDER_ID"), "batch-ids")), [PART_COL])
    return sorted(r[PART_COL] for r in found.collect())


def changed_rows(existing: DataFrame, batch: DataFrame, months: list[int]) -> DataFrame:
    """The rows of ``batch`` that the fact does not hold exactly so; ``months`` are those that hold its orders."""
    here = existing.where(F.col(PART_COL).isin(months)).select(*batch.columns)
    a, b = batch.alias("a"), here.alias("b")
    same = F.col("a.ORDER_ID") == F.col("b.ORDER_ID")
    for c in batch.columns:
        same = same & F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    return a.join(b, same, "left_anti")


def in_months(fact: DataFrame, months: list[int]) -> DataFrame:
    """The fact rows of ``months``: a literal filter on the partition column where the table has
    it, so that only those folders are read, else on ranges of the order date."""
    if PART_COL in fact.columns:
        return fact.where(F.col(PART_COL).isin(months))
    return fact.where(month_key().isin(months))


def refresh_mart(previous: DataFrame, fact: DataFrame, dims: dict[str, DataFrame], months: list[int]) -> DataFrame:
    """The mart after a change of the fact in ``months``, equal to a full refresh."""
    fresh = aggregate_monthly(enrich(in_months(fact, months), dims["dim_product"], dims["dim_geography"],
                                     dims["dim_channel"], dims["dim_priority"], dims["dim_date"]))
    kept = previous.select(*AGG_COLUMNS).where(~(F.col("YEAR") * 100 + F.col("MONTH")).isin(months))
    return add_window_metrics(kept.unionByName(fresh.select(*AGG_COLUMNS)))


# ---------------------------------------------------------------- windows of changed months only

PERF_PART = "PERF_MONTH_KEY"
WINDOW_KEYS = ["PRODUCT_CATEGORY", "REGION", "SALES_CHANNEL"]


def perf_month():
    return (F.col("YEAR") * 100 + F.col("MONTH")).cast("int")


def mart_index(perf: DataFrame) -> DataFrame:
    """The index of the stored mart: rows of each month and window partition; bounded by the dimensions."""
    return perf.groupBy(PERF_PART, *WINDOW_KEYS).agg(F.count(F.lit(1)).alias("n"))


def window_months(before: DataFrame, after: DataFrame, changed: list[int]) -> tuple[list[int], list[int]]:
    """(months whose windows a change of ``changed`` reaches, months that these look back on).

    ``before`` and ``after`` are row counts as of ``mart_index``. In each window partition that has
    rows in a changed month, before or after, the next rows behind that month see another past; how
    many, is the reach of the window. The rows before a reached month are needed to redo it.
    """
    reached, needed = set(changed), set()
    for keys, reach in WINDOW_REACH:
        m, same = PERF_PART, Window.partitionBy(*keys).orderBy(PERF_PART)
        touched = before.unionByName(after).where(F.col(m).isin(changed)).select(m, *keys).distinct()
        own = after.select(m, *keys, "n").unionByName(touched.withColumn("n", F.lit(0).cast("long"))).groupBy(m, *keys).agg(
            F.sum("n").alias("n")).withColumn("end", F.sum("n").over(same))
        own = materialize(own, "mart-counts")
        at = own.join(touched, [m, *keys]).select(*keys, F.col(m).alias("c"), F.col("end").alias("at"))
        behind = own.where("n > 0").join(at, keys).where((F.col(m) > F.col("c")) & (F.col("end") - F.col("n") < F.col("at") + reach))
        reached |= {r[m] for r in behind.select(m).distinct().collect()}
        # What is reached in one kind of window is redone in all kinds; so the past is asked for below.
    for keys, reach in WINDOW_REACH:
        m, same = PERF_PART, Window.partitionBy(*keys).orderBy(PERF_PART)
        own = after.groupBy(m, *keys).agg(F.sum("n").alias("n")).withColumn("end", F.sum("n").over(same))
        own = materialize(own, "mart-counts")
        redone = own.where(F.col(m).isin(sorted(reached))).select(*keys, F.col(m).alias("d"), (F.col("end") - F.col("n")).alias("start"))
        past = own.join(redone, keys).where((F.col(m) < F.col("d")) & (F.col("end") > F.col("start") - reach))
        needed |= {r[m] for r in past.select(m).distinct().collect()}
    return sorted(reached), sorted(needed - reached)


def refresh_months(previous: DataFrame, counts: DataFrame, fact: DataFrame, dims: dict[str, DataFrame],
                   months: list[int]) -> tuple[DataFrame, list[int]]:
    """(rows, months): the mart's new rows of all months that a change of the fact in ``months`` reaches.

    ``previous`` is the stored mart with its month, ``counts`` its index. Equal to a full refresh of these months.
    """
    fresh = materialize(aggregate_monthly(enrich(in_months(fact, months), dims["dim_product"], dims["dim_geography"],
                                                 dims["dim_channel"], dims["dim_priority"], dims["dim_date"])).select(
        *AGG_COLUMNS).withColumn(PERF_PART, perf_month()), "mart-fresh")
    after = counts.where(~F.col(PERF_PART).isin(months)).unionByName(mart_index(fresh))
    reached, needed = window_months(counts, after, months)
    others = [m for m in (*reached, *needed) if m not in set(months)]
    rows = previous.where(F.col(PERF_PART).isin(others)).select(*AGG_COLUMNS, PERF_PART).unionByName(fresh)
    return add_window_metrics(rows).where(F.col(PERF_PART).isin(reached)), reached


# ---------------------------------------------------------------- staging, merged with new rows only

BUCKET = "_BUCKET"
VERSION = "_VERSION"


def bucketed(staged: DataFrame, buckets: int, version: int) -> DataFrame:
    """Staged rows with the hash bucket of their order and the run that wrote them last."""
    return staged.withColumn(VERSION, F.lit(version).cast("long")).withColumn(
        BUCKET, F.pmod(F.xxhash64("order_id"), F.lit(buckets)).cast("int"))


def merge_staging(state: DataFrame, new_raw: DataFrame, buckets: int, version: int) -> tuple[DataFrame, list[int]]:
    """(rows, buckets): the new content of the buckets that the rows of ``new_raw`` belong to.

    The rule of the latest row is an order on rows, so the latest of the kept latest and the new rows is
    the latest of all. A new row that equals the kept one changes nothing: that one stays, with its version.
    """
    new = materialize(bucketed(staged_rows(new_raw), buckets, version), "staging-new")
    touched = sorted(r[BUCKET] for r in new.select(BUCKET).distinct().collect())
    both = state.where(F.col(BUCKET).isin(touched)).unionByName(new.select(*state.columns))
    return first_per_key(both, ["order_id"], [*dedup_ordering(), F.col(VERSION).asc()]), touched


def literal_mart_increment(previous: DataFrame, fact: DataFrame, dims: dict[str, DataFrame],
                           as_of: str | _dt.date | None, days: int = 30) -> DataFrame:
    """Mart of the ``days``-day fact slice, delete+inserted on the seven-column key."""
    slice_ = fact.where(F.col("ORDER_DATE_KEY") >= D.days_before_key(as_of, days))
    batch = build_performance(enrich(slice_, dims["dim_product"], dims["dim_geography"],
                                     dims["dim_channel"], dims["dim_priority"], dims["dim_date"]))
    return upsert(previous, batch, PERF_KEY)


def dim_date_above_watermark(existing: DataFrame, stg: DataFrame) -> DataFrame:
    """Add only dates later than the dimension's maximum (earlier new dates are lost)."""
    new = above_watermark(DM.date_spine(stg), "date_col", existing, "FULL_DATE")
    return existing.unionByName(DM.date_attributes(new))


def dim_date_missing(existing: DataFrame, stg: DataFrame) -> DataFrame:
    """Add every date not yet in the dimension (anti join on DATE_KEY)."""
    candidates = DM.date_attributes(DM.date_spine(stg))
    return existing.unionByName(
        candidates.join(existing.select("DATE_KEY"), "DATE_KEY", "left_anti").select(*existing.columns))
