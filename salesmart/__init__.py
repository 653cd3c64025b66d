"""salesmart: a PySpark sales-analytics engine (ingest, gates, star schema, monthly mart,
measures and data tests), written as DataFrame plans."""

__version__ = "0.1.0"
