"""Query registry core: ``register``, the shared ``Model`` cache and SQL helpers.

Every query reads the driver tables (through the ``raw.sales`` adapter) or data Spark
derives from them, over whole tables. Queries of one process share a ``Model`` per
(session, data folder), so staging and the dimensions are built once; ``reset_models``
drops that cache (the bench does this between timed queries).
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import oracle as O
from ..plans.model import Model
from ..sources.testdata import flawed_raw, raw_sales

# Fixed run date for the adapter feed (its orders span 1995-2001); every date-relative
# query takes it explicitly, so no result depends on the day it runs.
AS_OF = "1999-12-31"

_MODELS: dict[tuple[int, str], Model] = {}


def model(spark: SparkSession, sf_dir: str) -> Model:
    key = (id(spark), sf_dir)
    if key not in _MODELS:
        _MODELS[key] = Model(spark, sf_dir, as_of=AS_OF)
    return _MODELS[key]


def flawed(spark: SparkSession, sf_dir: str) -> Model:
    """The model over the raw table with planted defects (see ``sources.testdata.flawed_raw``)."""
    key = (id(spark), f"flawed:{sf_dir}")
    if key not in _MODELS:
        _MODELS[key] = Model(spark, raw=flawed_raw(raw_sales(spark, sf_dir)), as_of=AS_OF)
    return _MODELS[key]


def layers_of(m: Model) -> dict[str, DataFrame]:
    return {"raw_sales": m.raw(), "stg_sales": m.stg(), "fact_sales": m.fact(),
            "sales_performance": m.perf(), **m.dims()}


def reset_models() -> None:
    _MODELS.clear()


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def narrowed(df: DataFrame) -> DataFrame:
    """Amounts wider than the oracle's as decimal(18,2): only the registered results, for the comparison."""
    wide = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DecimalType) and f.dataType.precision > 18]
    return df.withColumns({c: F.col(c).cast("decimal(18,2)") for c in wide}) if wide else df


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = lambda spark, sf: narrowed(fn(spark, sf))
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def alias(name: str, target: str) -> None:
    QUERIES[name] = QUERIES[target]
    if target in ORACLE:
        ORACLE[name] = ORACLE[target]


W = O.with_model
X = O.with_flaws
AS_OF_SQL = f"DATE '{AS_OF}'"
AS_OF_MINUS_30 = f"CAST({AS_OF_SQL} - INTERVAL 30 DAY AS DATE)"


def _count_if(cond):
    return F.coalesce(F.sum(F.when(cond, 1).otherwise(0)), F.lit(0)).cast("bigint")


def _cnt_sql(cond: str) -> str:
    return f"CAST(COALESCE(SUM(CASE WHEN {cond} THEN 1 ELSE 0 END), 0) AS BIGINT)"


