"""Keyed upserts on plain Parquet tables.

``upsert`` is delete+insert by key: target rows whose key appears in the batch are
dropped (left anti join against the batch's distinct keys), the batch is appended.
Tables are stored in folders that never change once they are committed, so a failed run
never leaves a half-written or emptied table and no path is overwritten while it is read.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .keys import assign_row_numbers


def upsert(target: DataFrame, batch: DataFrame, key: list[str]) -> DataFrame:
    """Delete+insert on ``key``; re-applying the same batch changes nothing."""
    batch_keys = batch.select(*key).distinct()
    kept = target.join(batch_keys, key, "left_anti")
    return kept.unionByName(batch.select(*target.columns))


def above_watermark(candidates: DataFrame, col: str, target: DataFrame, target_col: str,
                    floor: str = "1900-01-01") -> DataFrame:
    """Rows of ``candidates`` with ``col`` > ``COALESCE(MAX(target_col), floor)``.

    The maximum is a scalar subquery: evaluated once, its value compared on every row."""
    mx = target.agg(F.coalesce(F.max(target_col), F.lit(floor).cast("date"))).scalar()
    return candidates.where(F.col(col) > mx)


def append_new_ids(existing: DataFrame, candidates: DataFrame, natural_key: list[str],
                   id_col: str) -> DataFrame:
    """Keep the ids of known natural keys; number new keys after ``max(id)`` in
    natural-key order. Returns the complete dimension (existing + new)."""
    new_keys = candidates.select(*natural_key).distinct().join(
        existing.select(*natural_key), natural_key, "left_anti")
    base = existing.agg(F.coalesce(F.max(id_col), F.lit(0))).scalar()
    numbered = (assign_row_numbers(new_keys, natural_key, "_n")
                .select(*natural_key, (base + F.col("_n")).cast("int").alias(id_col)))
    return existing.select(id_col, *natural_key).unionByName(numbered.select(id_col, *natural_key))


# ---------------------------------------------------------------------------------------
# Versioned table storage, through the Hadoop FileSystem API so that the same code works on
# local disk, HDFS or an object store:
#   <root>/<name>/v-<id>/                 data folders, never changed once committed
#   <root>/<name>/ix-<id>/                what a data folder's index holds (optional), under the same commit
#   <root>/<name>/_commits/<number>.json  which folders, and which partition values of each,
#                                         make up the table; the highest number holds
# A commit is one rename to a name that does not exist yet. Whatever stops before it leaves
# the table as it was, whatever stops after it only leaves folders that the next sweep drops.
# ---------------------------------------------------------------------------------------

MAX_RECORDS_PER_FILE = 5_000_000
KEPT_COMMITS = 2


#: What is kept beside a data folder: made from its rows, with the partition column among its columns.
Index = Callable[[DataFrame], DataFrame]


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _table(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def _commit_numbers(spark: SparkSession, table: str) -> list[int]:
    fs, folder = _fs(spark, f"{table}/_commits")
    if not fs.exists(folder):
        return []
    names = [st.getPath().getName() for st in fs.listStatus(folder)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def _read_commit(spark: SparkSession, table: str, number: int) -> list[dict]:
    fs, path = _fs(spark, f"{table}/_commits/{number:08d}.json")
    stream = fs.open(path)
    try:
        jvm = spark.sparkContext._jvm
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        return json.loads(reader.readLine())
    finally:
        stream.close()


def table_parts(spark: SparkSession, root: str, name: str) -> list[dict]:
    """The committed parts: ``path``, and of its partition values ``only`` some or all ``but`` some."""
    numbers = _commit_numbers(spark, _table(root, name))
    return _read_commit(spark, _table(root, name), numbers[-1]) if numbers else []


def current_version(spark: SparkSession, root: str, name: str) -> str | None:
    """The folder written last, or None where nothing is committed."""
    parts = table_parts(spark, root, name)
    return parts[-1]["path"] if parts else None


def read_table(spark: SparkSession, root: str, name: str, part_col: str | None = None) -> DataFrame | None:
    """The committed table. Parts replaced in some partitions are read without these: a literal
    filter on the partition column, so that their folders are never listed into the scan."""
    return _union(spark, table_parts(spark, root, name), "path", part_col)


def read_index(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    """The index of the committed table; None unless every part has one."""
    parts = table_parts(spark, root, name)
    return _union(spark, parts, "index") if all("index" in part for part in parts) else None


def _union(spark: SparkSession, parts: list[dict], what: str, part_col: str | None = None) -> DataFrame | None:
    out = None
    for part in parts:
        df, by = spark.read.parquet(part[what]), part.get("by", part_col)
        if part.get("only") is not None:
            df = df.where(F.col(by).isin(part["only"]))
        elif part.get("but"):
            df = df.where(~F.col(by).isin(part["but"]))
        out = df if out is None else out.unionByName(df)
    return out


def last_commit(spark: SparkSession, root: str, name: str) -> dict:
    """What the writer of the last commit noted with it (see ``notes``); empty where nothing is committed."""
    parts = table_parts(spark, root, name)
    return parts[-1].get("notes", {}) if parts else {}


def _commit(spark: SparkSession, table: str, parts: list[dict]) -> None:
    numbers = _commit_numbers(spark, table)
    fs, tmp = _fs(spark, f"{table}/_commits/.{uuid.uuid4().hex}")
    stream = fs.create(tmp, True)
    try:
        stream.write(bytearray(json.dumps(parts).encode("utf-8")))
    finally:
        stream.close()
    _, final = _fs(spark, f"{table}/_commits/{(numbers[-1] if numbers else 0) + 1:08d}.json")
    if fs.exists(final) or not fs.rename(tmp, final):
        fs.delete(tmp, False)
        raise OSError(f"another writer committed to {table}")


def sweep(spark: SparkSession, root: str, name: str, keep: int = KEPT_COMMITS) -> None:
    """Drop commits but the last ``keep``, and data folders that none of these names."""
    table = _table(root, name)
    numbers = _commit_numbers(spark, table)
    named = {part[what].rsplit("/", 1)[-1] for n in numbers[-keep:] for part in _read_commit(spark, table, n)
             for what in ("path", "index") if what in part}
    fs, folder = _fs(spark, table)
    for n in numbers[:-keep]:
        fs.delete(_fs(spark, f"{table}/_commits/{n:08d}.json")[1], False)
    for status in fs.listStatus(folder):
        path = status.getPath()
        if path.getName().startswith(("v-", "ix-")) and path.getName() not in named:
            fs.delete(path, True)


def _write_folder(df: DataFrame, table: str, partition_by: list[str] | None, sort_within: list[str] | None,
                  rebalance_by: list[str] | None) -> str:
    folder = f"{table}/v-{uuid.uuid4().hex[:12]}"
    out = df.hint("rebalance", *rebalance_by) if rebalance_by else df
    order = list(partition_by or []) + list(sort_within or [])
    if order:
        out = out.sortWithinPartitions(*order)
    writer = out.write.mode("errorifexists").option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(folder)
    return folder


def _write_index(spark: SparkSession, folder: str, index: Index | None) -> dict:
    """The index of a written folder, made from its files."""
    if index is None:
        return {}
    table, name = folder.rsplit("/v-", 1)
    index(spark.read.parquet(folder)).write.mode("errorifexists").parquet(f"{table}/ix-{name}")
    return {"index": f"{table}/ix-{name}"}


def write_version(df: DataFrame, root: str, name: str,
                  partition_by: list[str] | None = None,
                  sort_within: list[str] | None = None,
                  rebalance_by: list[str] | None = None, made_from: str | None = None,
                  index: Index | None = None, notes: dict | None = None) -> str:
    """Write ``df`` as the whole new content of a table and commit it.

    ``made_from`` is kept in the commit: the version of another table that ``df`` goes back to; so are ``notes``.
    ``index`` makes the table's index from its rows; it is committed with them.

    With ``rebalance_by`` (the partition columns) the rows are shuffled once by those
    columns under a ``REBALANCE`` hint: AQE then merges small partition values into
    shared tasks (one file per value) and splits a value holding a large share of the
    rows across several tasks. Without it every task would write a file into every
    partition value it holds (tasks x values small files).
    """
    spark = df.sparkSession
    folder = _write_folder(df, _table(root, name), partition_by, sort_within, rebalance_by)
    part = {"path": folder} | _write_index(spark, folder, index)
    if partition_by:
        part["by"] = partition_by[0]
    _commit(spark, _table(root, name), [part | _noted(made_from, notes)])
    sweep(spark, root, name)
    return folder


def _noted(made_from: str | None, notes: dict | None) -> dict:
    return ({"made_from": made_from} if made_from else {}) | ({"notes": notes} if notes else {})


def note(spark: SparkSession, root: str, name: str, made_from: str | None = None, notes: dict | None = None) -> None:
    """Commit the same content again under new notes."""
    parts = table_parts(spark, root, name)
    _commit(spark, _table(root, name), [*parts[:-1], parts[-1] | _noted(made_from, notes)])
    sweep(spark, root, name)


def replace_partitions(df: DataFrame, root: str, name: str, part_col: str, values: list,
                       sort_within: list[str] | None = None, made_from: str | None = None,
                       index: Index | None = None, notes: dict | None = None) -> str:
    """Make ``df`` the content of the partitions ``values`` of a table; other partitions stay as they are.

    The content goes to a new folder with the layout of a full write; the commit takes the
    values from the parts that held them. A value without rows in ``df`` is then empty. The
    parts in use stay below the number of partitions, since one that holds none is dropped.
    """
    spark = df.sparkSession
    table = _table(root, name)
    parts, before = [], table_parts(spark, root, name)
    for part in before:
        kept = {k: v for k, v in part.items() if k in ("path", "index")} | {"by": part_col}
        if part.get("only") is not None:
            left = [v for v in part["only"] if v not in set(values)]
            if left:
                parts.append(kept | {"only": left})
        else:
            parts.append(kept | {"but": sorted({*part.get("but", []), *values})})
    folder = _write_folder(df, table, [part_col], sort_within, [part_col])
    fs, path = _fs(spark, folder)
    if any(st.isDirectory() for st in fs.listStatus(path)):
        part = {"path": folder, "only": sorted(values)} | _write_index(spark, folder, index)
    else:  # no rows and so no file that could be read: a part that holds nothing
        part = {k: v for k, v in before[-1].items() if k in ("path", "index")} | {"only": []}
    _commit(spark, table, [*parts, part | {"by": part_col} | _noted(made_from, notes)])
    sweep(spark, root, name)
    return folder
