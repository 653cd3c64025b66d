"""Registered queries: one per operator of the inventory, each with its SQL oracle.

Every query reads the driver tables (through the ``raw.sales`` adapter) or data Spark
derives from them, over whole tables.
"""

from .core import ORACLE, QUERIES, model, reset_models  # noqa: F401
from . import layers, functions, quality, measures, ingest, incremental  # noqa: F401,E402  (registration order = module order)
