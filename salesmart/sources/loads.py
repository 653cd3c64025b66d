"""Loads of ``raw.sales`` with a ledger (S7-S9, S12): repeatable, atomic, checked.

A load parses its feed once and writes one folder, partitioned by outcome (loaded, rejected). The
table is the list of loads in its last commit (``operators.upsert``), and one rename commits: readers see
the loads of before or of after, never a missing table. What stops before the commit leaves
the table as it was, and the load may be run again.

A load is known by its id, by default a digest of the feed's files (name, size, time of change). A
load whose id is in the ledger has been done: running it again changes nothing and returns its audit.
Ledger entries are numbered, so a reader may ask for the loads above the last one it knows.

Loaded rows must have the declared columns: types are compared before the write, lengths and required
values counted while it runs, and a violation refuses the commit. Rejected rows keep their fields and, where the line has
more or fewer than its header, the line as it came.
"""

from __future__ import annotations

import hashlib
import json
import logging
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import upsert as U
from ..operators.constraints import Refused, check_types, counted, rules
from ..schemas import RAW_COLUMNS, RAW_MAX_LENGTH, RAW_SALES
from . import csv_ingest as CI

log = logging.getLogger(__name__)

OUTCOME = "OUTCOME"
LOADED, REJECTED = "loaded", "rejected"
REJECTS = T.StructType([T.StructField(c, T.StringType()) for c in ("_reject_reason", "_source", "_line")])


def feed_id(spark: SparkSession, path: str) -> str:
    """A digest of the feed's files; the same as long as none is added, changed or removed."""
    fs, root = U._fs(spark, path)
    if not fs.exists(root):
        raise FileNotFoundError(path)
    files = sorted((st.getPath().getName(), st.getLen(), st.getModificationTime())
                   for st in fs.listStatus(root) if not st.getPath().getName().startswith(("_", ".")))
    return hashlib.sha256(json.dumps([path, files]).encode()).hexdigest()[:24]


def ledger(spark: SparkSession, root: str, name: str = "raw/sales") -> list[dict]:
    """The loads of the table, oldest first: number, load, path, audit."""
    return [part["entry"] | {"path": part["path"]} for part in U.table_parts(spark, root, name)]


def load_numbers(spark: SparkSession, root: str, name: str = "raw/sales") -> list[int]:
    return [entry["number"] for entry in ledger(spark, root, name)]


def _read(spark: SparkSession, entries: list[dict], outcome: str, schema: T.StructType) -> DataFrame:
    paths = [f"{e['path']}/{OUTCOME}={outcome}" for e in entries if e["audit"]["loaded" if outcome == LOADED else "skipped"]]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def read_raw(spark: SparkSession, root: str, name: str = "raw/sales", numbers: list[int] | None = None) -> DataFrame:
    """The loaded rows of all loads, or of those with the given numbers: one scan of their folders."""
    entries = ledger(spark, root, name)
    return _read(spark, [e for e in entries if numbers is None or e["number"] in set(numbers)], LOADED, RAW_SALES)


def read_rejected(spark: SparkSession, root: str, name: str = "raw/sales", numbers: list[int] | None = None) -> DataFrame:
    """The rejected rows with their reason, their fields as JSON, and the line where it is no regular one."""
    entries = ledger(spark, root, name)
    return _read(spark, [e for e in entries if numbers is None or e["number"] in set(numbers)], REJECTED, REJECTS)


def load_feed(spark: SparkSession, path: str, root: str, name: str = "raw/sales", load_id: str | None = None,
              replace: bool = False, multi_line: bool = False) -> dict:
    """Load a CSV feed as one entry of the ledger; with ``replace`` it becomes the whole table."""
    load_id = load_id or feed_id(spark, path)
    parts = U.table_parts(spark, root, name)
    done = [part for part in parts if part["entry"]["load"] == load_id]
    if done and (not replace or len(parts) == 1):
        return done[0]["entry"]["audit"] | {"number": done[0]["entry"]["number"], "repeated": True}
    rows, missing = CI.read_coerced(spark, path, multi_line, keep_line=True)
    if missing:
        log.warning("Missing expected columns: %s", missing)
    return append_rows(spark, rows, root, name, load_id, replace, missing)


def append_rows(spark: SparkSession, rows: DataFrame, root: str, name: str, load_id: str, replace: bool = False,
                missing: list[str] | None = None) -> dict:
    """Write coerced rows (see ``csv_ingest.coerce_feed``) as one load and commit it."""
    good = F.col("_reject_reason").isNull()
    outcome = F.when(good, LOADED).otherwise(REJECTED).alias(OUTCOME)
    out = rows.select(*RAW_COLUMNS, F.localtimestamp().alias("_ingested_at"), "_reject_reason", "_source", "_line", outcome)
    check_types(out.select(*RAW_SALES.names), RAW_SALES)
    seen = Observation(f"load-{uuid.uuid4().hex[:12]}")
    watched = out.observe(seen, F.count(F.when(good, 1)).alias(LOADED), F.count(F.when(~good, 1)).alias(REJECTED),
                          *counted(rules(RAW_SALES, RAW_MAX_LENGTH), good))
    table = U._table(root, name)
    folder = f"{table}/v-{uuid.uuid4().hex[:12]}"
    watched.write.mode("errorifexists").partitionBy(OUTCOME).parquet(folder)
    counts = {k: int(v) for k, v in seen.get.items()}
    loaded, skipped = counts.pop(LOADED), counts.pop(REJECTED)
    broken = {k: v for k, v in counts.items() if v}
    if broken:
        fs, p = U._fs(spark, folder)
        fs.delete(p, True)
        raise Refused(f"rows break the declared columns: {broken}", broken)
    reasons = {} if not skipped else {
        r["_reject_reason"]: r["count"] for r in spark.read.parquet(f"{folder}/{OUTCOME}={REJECTED}")
        .groupBy("_reject_reason").count().collect()}
    audit = {"loaded": loaded, "skipped": skipped, "reasons": reasons, "missing_headers": missing or []}
    parts = U.table_parts(spark, root, name)
    number = 1 + max((part["entry"]["number"] for part in parts), default=0)
    U._commit(spark, table, [*([] if replace else parts),
                             {"path": folder, "entry": {"number": number, "load": load_id, "audit": audit}}])
    U.sweep(spark, root, name)
    log.info("Done. Loaded: %d rows | Skipped: %d rows", loaded, skipped)
    return audit | {"number": number, "repeated": False}
