"""Incremental operators I1-I5 and the stable-id / date-watermark variants (T5-T7).

The "previous run" is the model as it stood on the run date ``AS_OF`` (orders up to
that date); the increment is the 30-day slice the incremental models read.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import oracle as O
from ..functions import dates as D
from ..operators.bitmaps import distinct_count, id_sets, merged
from ..operators.upsert import append_new_ids
from ..plans import dims as DM
from ..plans import incremental as INC
from ..plans.fact import PART_COL
from ..plans.mart import build_performance, enrich
from ..plans.staging import build_staging
from ..schemas import PERF_KEY
from ..session import materialize
from .core import AS_OF, AS_OF_MINUS_30, AS_OF_SQL, W, model, register

KEY_AS_OF = f"CAST(strftime({AS_OF_SQL}, '%Y%m%d') AS INTEGER)"
KEY_MINUS_30 = f"CAST(strftime({AS_OF_MINUS_30}, '%Y%m%d') AS INTEGER)"


def _previous_fact(m):
    return m.fact().where(F.col("ORDER_DATE_KEY") <= D.date_key(D.as_of_date(AS_OF)))


def _previous_perf(m):
    dims = m.dims()
    return build_performance(enrich(_previous_fact(m), dims["dim_product"], dims["dim_geography"],
                                    dims["dim_channel"], dims["dim_priority"], dims["dim_date"]))


FACT_UPSERT_SQL = W("""
SELECT * FROM fact_prev WHERE ORDER_ID NOT IN (SELECT ORDER_ID FROM fact_batch)
UNION ALL SELECT * FROM fact_batch""", extra_ctes=f"""
fact_prev AS (SELECT * FROM fact_sales WHERE ORDER_DATE_KEY <= {KEY_AS_OF}),
fact_batch AS (SELECT f.* FROM fact_sales f JOIN stg_sales s ON f.ORDER_ID = s.order_id
               WHERE GREATEST(s.order_date, s.ship_date) >= {AS_OF_MINUS_30})""")


@register("i1_fact_upsert", FACT_UPSERT_SQL)
def i1(spark, sf):
    m = model(spark, sf)
    return INC.upsert_fact(_previous_fact(m), INC.fact_increment(m.stg(), m.dims(), AS_OF))


@register("i5_upsert_idempotent", FACT_UPSERT_SQL)
def i5(spark, sf):
    """The same batch applied twice gives the same table as applied once."""
    m = model(spark, sf)
    batch = INC.fact_increment(m.stg(), m.dims(), AS_OF)
    return INC.upsert_fact(INC.upsert_fact(_previous_fact(m), batch), batch)


@register("i2_mart_incremental_refresh", W("SELECT * FROM sales_performance"))
def i2(spark, sf):
    """Incremental run over whole touched months; must equal the full refresh."""
    m = model(spark, sf)
    before = _previous_fact(m)
    months = INC.touched_months(before, INC.fact_increment(m.stg(), m.dims(), AS_OF))
    return INC.refresh_mart(_previous_perf(m), m.fact(), m.dims(), months)


EMPTIED_DAY = "1991-12-15"


def _earlier_state(m):
    """A fact of the run before in which the batch's orders were missing, had other amounts, or
    stood in other months, one of which holds nothing else; with the dimension of its dates."""
    ids = INC.fact_increment(m.stg(), m.dims(), AS_OF).select("ORDER_ID").withColumn("_batch", F.lit(True))
    kind = F.when(F.col("_batch"), F.col("ORDER_ID") % 4)
    old = m.fact().join(ids, "ORDER_ID", "left").where(F.coalesce(kind != 0, F.lit(True)))
    before = old.select(*[
        F.when(kind == 1, F.col(c) + 100).otherwise(F.col(c)).cast(m.fact().schema[c].dataType).alias(c)
        if c in ("TOTAL_REVENUE", "TOTAL_PROFIT")
        else F.when(kind == 2, F.lit(19950617)).when(kind == 3, F.lit(int(EMPTIED_DAY.replace("-", ""))))
        .otherwise(F.col(c)).alias(c) if c == "ORDER_DATE_KEY" else F.col(c) for c in m.fact().columns])
    day = m.stg().limit(1).select(F.lit(EMPTIED_DAY).cast("date").alias("date_col"))
    return before, {**m.dims(), "dim_date": m.dims()["dim_date"].unionByName(DM.date_attributes(day))}


@register("i2_mart_late_changed_moved_orders", W("SELECT * FROM sales_performance"))
def i2_moved(spark, sf):
    """From a state with late, changed and moved orders, fact upsert and mart refresh give the full rebuild."""
    m = model(spark, sf)
    before, dims = _earlier_state(m)
    previous = build_performance(enrich(before, dims["dim_product"], dims["dim_geography"], dims["dim_channel"],
                                        dims["dim_priority"], dims["dim_date"]))
    batch = INC.fact_increment(m.stg(), m.dims(), AS_OF)
    return INC.refresh_mart(previous, INC.upsert_fact(before, batch), dims, INC.touched_months(before, batch))


@register("i1_fact_upsert_late_changed_moved", W("SELECT * FROM fact_sales"))
def i1_moved(spark, sf):
    """The same state, fact only: the batch replaces what it changes and nothing is left behind."""
    m = model(spark, sf)
    before, _ = _earlier_state(m)
    return INC.upsert_fact(before, INC.fact_increment(m.stg(), m.dims(), AS_OF))


@register("i1_fact_upsert_by_index", W("SELECT * FROM fact_sales"))
def i1_index(spark, sf):
    """The same state; the months that hold the batch's orders come from the sets of ids, rows that the fact has
    exactly so are left out, and only the months that change are rewritten."""
    m = model(spark, sf)
    before, _ = _earlier_state(m)
    stored = materialize(before.withColumn(PART_COL, INC.month_key()), "fact-stored")
    batch = INC.fact_increment(m.stg(), m.dims(), AS_OF).withColumn(PART_COL, INC.month_key())
    index = materialize(INC.month_index(stored), "fact-index")
    batch = materialize(INC.changed_rows(stored, batch, INC.months_holding(index, batch)), "fact-changed")
    months = sorted({*INC.months_holding(index, batch), *(r[0] for r in batch.select(PART_COL).distinct().collect())})
    rewritten = INC.upsert_fact(stored.where(F.col(PART_COL).isin(months)), batch)
    return stored.where(~F.col(PART_COL).isin(months)).unionByName(rewritten).drop(PART_COL)


@register("i2_mart_windows_of_reached_months", W("SELECT * FROM sales_performance"))
def i2_windows(spark, sf):
    """The same state; only the months that the change reaches through some window are redone."""
    m = model(spark, sf)
    before, dims = _earlier_state(m)
    stored = materialize(build_performance(enrich(before, dims["dim_product"], dims["dim_geography"], dims["dim_channel"],
                                                  dims["dim_priority"], dims["dim_date"])).withColumn(
        INC.PERF_PART, INC.perf_month()), "mart-stored")
    batch = INC.fact_increment(m.stg(), m.dims(), AS_OF)
    rows, reached = INC.refresh_months(stored, INC.mart_index(stored), INC.upsert_fact(before, batch), dims,
                                       INC.touched_months(before, batch))
    return stored.where(~F.col(INC.PERF_PART).isin(reached)).unionByName(rows.select(*stored.columns)).drop(INC.PERF_PART)


@register("t_stg_incremental_merge", W("SELECT * FROM stg_sales"))
def stg_merge(spark, sf):
    """Staging of the rows ingested up to the run date, merged with the rows ingested since."""
    m, buckets = model(spark, sf), 8
    first = F.col("_ingested_at") <= F.lit(AS_OF).cast("timestamp_ntz")
    state = materialize(INC.bucketed(build_staging(m.raw().where(first)), buckets, 1), "staging-state")
    rows, touched = INC.merge_staging(state, m.raw().where(~first), buckets, 2)
    return state.where(~F.col(INC.BUCKET).isin(touched)).unionByName(rows).drop(INC.BUCKET, INC.VERSION)


# Orders span lines of several products and places: the first digits of a line's id name its order.
LEVELS = {"all": [], "region": ["REGION"], "country": ["REGION", "COUNTRY"], "category": ["PRODUCT_CATEGORY"],
          "year": ["YEAR"], "month": ["YEAR", "MONTH"], "category_month": ["PRODUCT_CATEGORY", "YEAR", "MONTH"]}
LEVEL_KEYS = ["REGION", "COUNTRY", "PRODUCT_CATEGORY", "YEAR", "MONTH"]


@register("a2_distinct_orders_by_level", W(" UNION ALL ".join(
    f"SELECT '{level}' AS LEVEL, {', '.join(c if c in keys else f'NULL AS {c}' for c in LEVEL_KEYS)}, "
    f"count(DISTINCT ORDER_ID // 10) AS ORDERS FROM enriched {'GROUP BY ' + ', '.join(keys) if keys else ''}"
    for level, keys in LEVELS.items())))
def a2_levels(spark, sf):
    """COUNT(DISTINCT order) at every drill level from one table of exact sets, rolled up by OR."""
    m = model(spark, sf)
    rows = m.enriched().withColumn("ORDER_NO", F.floor(F.col("ORDER_ID") / 10).cast("long"))
    sets = materialize(id_sets(rows, LEVEL_KEYS, "ORDER_NO"), "order-sets")
    out = None
    for level, keys in LEVELS.items():
        part = distinct_count(merged(sets, keys), keys, "ORDERS").select(
            F.lit(level).alias("LEVEL"), *(F.col(c) if c in keys else F.lit(None).cast(sets.schema[c].dataType).alias(c)
                                           for c in LEVEL_KEYS), "ORDERS")
        out = part if out is None else out.unionByName(part)
    return out


SAME_KEY = " AND ".join(f"s.{c} = p.{c}" for c in PERF_KEY)


@register("i2_mart_delete_insert_literal", W(f"""
SELECT * FROM prev_sales_performance p
WHERE NOT EXISTS (SELECT 1 FROM slice_sales_performance s WHERE {SAME_KEY})
UNION ALL SELECT * FROM slice_sales_performance""", extra_ctes=f"""
fact_prev AS (SELECT * FROM fact_sales WHERE ORDER_DATE_KEY <= {KEY_AS_OF}),
fact_slice AS (SELECT * FROM fact_sales WHERE ORDER_DATE_KEY >= {KEY_MINUS_30}),
{O.perf_ctes("fact_prev", "prev_")},
{O.perf_ctes("fact_slice", "slice_")}"""))
def i2_literal(spark, sf):
    m = model(spark, sf)
    return INC.literal_mart_increment(_previous_perf(m), m.fact(), m.dims(), AS_OF)


FIRST_LOAD = f"""
first_load AS (SELECT * FROM stg_sales WHERE order_date <= {AS_OF_SQL}),
first_spine AS (SELECT order_date AS date_col FROM first_load UNION SELECT ship_date FROM first_load),
dim_date_prev AS ({O.date_attrs_sql("first_spine")})"""


def _first_load(m):
    return m.stg().where(F.col("order_date") <= D.as_of_date(AS_OF))


@register("i3_dim_date_watermark", W(f"""
SELECT * FROM dim_date_prev
UNION ALL
{O.date_attrs_sql('''(SELECT date_col FROM date_spine WHERE date_col >
      (SELECT COALESCE(MAX(FULL_DATE), DATE '1900-01-01') FROM dim_date_prev)) n''')}""",
    extra_ctes=FIRST_LOAD))
def i3(spark, sf):
    m = model(spark, sf)
    return INC.dim_date_above_watermark(DM.build_dim_date(_first_load(m)), m.stg())


@register("i3_dim_date_add_missing", W("SELECT * FROM dim_date"))
def i3_missing(spark, sf):
    """Anti-join variant: every new date is added, so the result is the full dimension."""
    m = model(spark, sf)
    return INC.dim_date_missing(DM.build_dim_date(_first_load(m)), m.stg())


@register("t6_stable_geography_ids", W("""
SELECT * FROM geo_prev
UNION ALL
SELECT CAST((SELECT COALESCE(MAX(GEOGRAPHY_ID), 0) FROM geo_prev)
            + ROW_NUMBER() OVER (ORDER BY REGION, COUNTRY) AS INTEGER) AS GEOGRAPHY_ID, REGION, COUNTRY
FROM (SELECT region AS REGION, country AS COUNTRY FROM stg_sales
      WHERE region IS NOT NULL AND region <> '' AND country IS NOT NULL AND country <> ''
      EXCEPT SELECT REGION, COUNTRY FROM geo_prev) n""", extra_ctes=FIRST_LOAD + """,
geo_prev AS (
  SELECT CAST(ROW_NUMBER() OVER (ORDER BY region, country) AS INTEGER) AS GEOGRAPHY_ID,
         region AS REGION, country AS COUNTRY
  FROM (SELECT DISTINCT region, country FROM first_load
        WHERE region IS NOT NULL AND region <> '' AND country IS NOT NULL AND country <> '') s)"""))
def t6(spark, sf):
    m = model(spark, sf)
    existing = DM.build_dim_geography(_first_load(m))
    candidates = DM.geography_keys(m.stg()).select(F.col("region").alias("REGION"),
                                                   F.col("country").alias("COUNTRY"))
    return append_new_ids(existing, candidates, ["REGION", "COUNTRY"], "GEOGRAPHY_ID")
