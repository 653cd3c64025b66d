"""Reusable operators: dedup, surrogate keys, checked broadcast joins, upserts, gates and data tests."""
