"""Scalar column functions (dates, text, numbers), all native Spark expressions."""
