"""Sources and sinks: CSV ingest, the driver-table adapter, layered table storage."""
