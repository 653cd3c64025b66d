"""The layered model as one lazily built object.

``Model`` builds each layer on first use and keeps it for the rest of the run.
Staging and the dimensions are read by several consumers, so they are materialized
once in the shared checkpoint folder (Parquet); later layers stay lazy so Catalyst
can prune and push filters through them.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession

from ..session import materialize, scratch_path
from ..sources.testdata import raw_sales, write_feed
from . import dims as dims_mod
from .fact import build_fact
from .mart import build_performance, enrich
from .staging import build_staging


class Model:
    def __init__(self, spark: SparkSession, sf_dir: str | None = None,
                 raw: DataFrame | None = None, as_of: str | _dt.date | None = None,
                 materialize_shared: bool = True):
        if raw is None and sf_dir is None:
            raise ValueError("give sf_dir or raw")
        self.spark = spark
        self.sf_dir = sf_dir
        self.as_of = as_of
        self.materialize_shared = materialize_shared
        self._raw = raw
        self._cache: dict[str, DataFrame] = {}
        self._paths: dict[str, str] = {}

    def _keep(self, name: str, build, shared: bool = False) -> DataFrame:
        if name not in self._cache:
            df = build()
            if shared and self.materialize_shared:
                df = materialize(df, name, compression="zstd")
            self._cache[name] = df
        return self._cache[name]

    def raw(self) -> DataFrame:
        if self._raw is None:
            self._raw = raw_sales(self.spark, self.sf_dir)
        return self._raw

    def stg(self) -> DataFrame:
        return self._keep("stg_sales", lambda: build_staging(self.raw()), shared=True)

    def dim_date(self) -> DataFrame:
        return self._keep("dim_date", lambda: dims_mod.build_dim_date(self.stg()), shared=True)

    def dim_geography(self) -> DataFrame:
        return self._keep("dim_geography", lambda: dims_mod.number_geography(
            self._keep("geo_keys", lambda: dims_mod.geography_keys(self.stg()), True)), shared=True)

    def dim_product(self) -> DataFrame:
        return self._keep("dim_product", lambda: dims_mod.number_product(
            self._keep("product_keys", lambda: dims_mod.product_keys(self.stg()), True)), shared=True)

    def dim_channel(self) -> DataFrame:
        return self._keep("dim_channel", lambda: dims_mod.number_channel(
            self._keep("channel_keys", lambda: dims_mod.channel_keys(self.stg()), True)), shared=True)

    def dim_priority(self) -> DataFrame:
        return self._keep("dim_priority", lambda: dims_mod.number_priority(
            self._keep("priority_keys", lambda: dims_mod.priority_keys(self.stg()), True)), shared=True)

    def dims(self) -> dict[str, DataFrame]:
        return {"dim_product": self.dim_product(), "dim_geography": self.dim_geography(),
                "dim_channel": self.dim_channel(), "dim_priority": self.dim_priority(),
                "dim_date": self.dim_date()}

    def fact(self) -> DataFrame:
        return self._keep("fact_sales", lambda: build_fact(
            self.stg(), self.dim_product(), self.dim_geography(), self.dim_channel(),
            self.dim_priority(), self.dim_date()))

    def enriched(self) -> DataFrame:
        return self._keep("enriched", lambda: enrich(
            self.fact(), self.dim_product(), self.dim_geography(), self.dim_channel(),
            self.dim_priority(), self.dim_date()))

    def perf(self) -> DataFrame:
        return self._keep("sales_performance", lambda: build_performance(self.enriched()))

    def perf_shared(self) -> DataFrame:
        """The mart, materialized: for consumers that read it several times."""
        return self._keep("sales_performance_m", lambda: self.perf(), shared=True)

    def feed_path(self, drop_headers: tuple[str, ...] = ()) -> str:
        """The raw table written as a CSV feed (once per variant) in the shared folder."""
        key = f"feed:{'|'.join(drop_headers)}"
        if key not in self._paths:
            self._paths[key] = write_feed(self.raw(), scratch_path(self.spark, "feed"), drop_headers)
        return self._paths[key]
