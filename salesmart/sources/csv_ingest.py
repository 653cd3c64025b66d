"""Bulk CSV ingest into ``raw.sales`` (S1-S12).

Plan: one splittable CSV scan with every column read as text -> one projection that
coerces all fields and tags each row with the first failure reason -> two filters
(accepted, rejected). No UDF, no shuffle, no driver-side loop: each executor parses and
coerces its own splits, and the writer appends in parallel.

Row rules (from the loader being replaced):
* headers are matched by name, file by file; a missing header only warns, and its column takes the
  default ('' for text, 0 for numbers, NULL for dates);
* text is stripped of surrounding whitespace; an empty number is 0; a number that does
  not parse rejects the row; a date is tried in three formats, else NULL (row kept);
* surplus fields on a line are ignored; a line *short* of a field is rejected
  ("missing field"; the replaced loader aborted the whole load there);
* values that do not fit the declared type (too long, out of range) reject the row.
"""

from __future__ import annotations

import logging
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import strip_ws, with_parsed_dates
from ..schemas import AMOUNT, CSV_HEADERS, HEADER_TO_RAW, PRICE, RAW_COLUMNS, RAW_MAX_LENGTH
from ..session import materialize, scratch_path

log = logging.getLogger(__name__)

CORRUPT = "_corrupt_record"
INT_PATTERN = r"^\s*[+-]?[0-9]+\s*$"
NUMBER_PATTERN = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
# Counts the fields of a raw line: commas outside double-quoted sections, plus one.
QUOTED_SECTION = r'"([^"]|"")*"'

TEXT_COLUMNS = ["REGION", "COUNTRY", "ITEM_TYPE", "SALES_CHANNEL", "ORDER_PRIORITY"]
DATE_COLUMNS = ["ORDER_DATE", "SHIP_DATE"]
INT_COLUMNS = {"ORDER_ID": T.LongType(), "UNITS_SOLD": T.IntegerType()}
DECIMAL_COLUMNS = {"UNIT_PRICE": PRICE, "UNIT_COST": PRICE, "TOTAL_REVENUE": AMOUNT,
                   "TOTAL_COST": AMOUNT, "TOTAL_PROFIT": AMOUNT}


@dataclass
class IngestResult:
    accepted: DataFrame          # raw.sales rows, 15 columns
    rejected: DataFrame          # source text of the row + _reject_reason
    missing_headers: list[str] = field(default_factory=list)

    def audit(self) -> DataFrame:
        """Rows loaded and skipped, by reason (one aggregation over both outcomes)."""
        tagged = self.accepted.select(F.lit(None).cast("string").alias("_reject_reason")) \
            .unionByName(self.rejected.select("_reject_reason"))
        return (tagged.groupBy(F.coalesce("_reject_reason", F.lit("loaded")).alias("OUTCOME"))
                .agg(F.count(F.lit(1)).alias("ROWS")))


def read_header(spark: SparkSession, path: str | list[str]) -> list[str]:
    """Column names from the header line (reads one line, no data pass)."""
    return spark.read.option("header", True).csv(path).columns


def header_groups(spark: SparkSession, path: str) -> list[list[str]]:
    """The feed's files, grouped by their first line: only files with the same column order may
    share a scan. One line per file is read, through the file system the path is on."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.getFileStatus(root).isDirectory():
        return [[path]]
    groups: dict[str, list[str]] = {}
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if not status.isFile() or name.startswith(("_", ".")):
            continue
        stream = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(
            spark.sparkContext._jsc.hadoopConfiguration()).getCodec(status.getPath())
        opened = fs.open(status.getPath())
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(
            stream.createInputStream(opened) if stream else opened, "UTF-8"))
        try:
            first = reader.readLine()
        finally:
            reader.close()
        if first is not None:
            groups.setdefault(first.lstrip("\ufeff").rstrip("\r"), []).append(status.getPath().toString())
    return list(groups.values())


def read_feed(spark: SparkSession, path: str | list[str], multi_line: bool = False) -> tuple[DataFrame, list[str]]:
    """Scan CSV files of one header with every column as text, named from it.

    BOM is dropped by the reader; quoted commas and ``""`` escapes are handled; a line
    with fewer or more fields than the header keeps its text in ``_corrupt_record``. Columns
    are never pruned from the parser: with fewer it would not see that a line is short, and
    the verdict on a row would depend on what is read of it. With ``multi_line`` a quoted
    field may hold line ends; a file is then one task.
    """
    header = read_header(spark, path)
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in header]
                          + [T.StructField(CORRUPT, T.StringType(), True)])
    df = (spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line)
          .option("columnPruning", False)
          .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
          .schema(schema).csv(path))
    return df, header


def _field_count(line: Column) -> Column:
    unquoted = F.regexp_replace(line, QUOTED_SECTION, "")
    return F.size(F.split(unquoted, ",", -1))


def coerce_feed(df: DataFrame, header: list[str], source_for_all: bool = False, keep_line: bool = False) -> DataFrame:
    """Typed raw columns plus ``_reject_reason`` (NULL when the row is accepted).

    ``_source`` holds the original fields of a rejected row (of every row with
    ``source_for_all``, for inspecting the coercion)."""
    present = {h: i for i, h in enumerate(header) if h in HEADER_TO_RAW}
    n_fields = F.when(F.col(CORRUPT).isNull(), F.lit(len(header))).otherwise(_field_count(F.col(CORRUPT)))
    values: dict[str, Column] = {}
    errors: dict[str, Column] = {}
    date_texts: dict[str, Column] = {}
    for h, raw_name in HEADER_TO_RAW.items():
        if h not in present:
            src, missing_field = F.lit(None).cast("string"), F.lit(False)
        else:
            src, missing_field = F.col(f"`{h}`"), n_fields <= present[h]
        if raw_name in TEXT_COLUMNS:
            text = strip_ws(F.coalesce(src, F.lit("")))
            values[raw_name] = text
            errors[raw_name] = (F.when(missing_field, F.lit(f"{h}: missing field"))
                                .when(F.length(text) > RAW_MAX_LENGTH[raw_name],
                                      F.lit(f"{h}: longer than {RAW_MAX_LENGTH[raw_name]}")))
        elif raw_name in DATE_COLUMNS:
            date_texts[f"_date_{raw_name}"] = F.coalesce(src, F.lit(""))
            values[raw_name] = F.col(f"_date_{raw_name}")
            errors[raw_name] = F.when(missing_field, F.lit(f"{h}: missing field"))
        else:
            is_default = src.isNull() | (src == "")
            if raw_name in INT_COLUMNS:
                dtype, pattern, kind = INT_COLUMNS[raw_name], INT_PATTERN, "an integer"
            else:
                dtype, pattern, kind = DECIMAL_COLUMNS[raw_name], NUMBER_PATTERN, "a number"
            parsed = F.trim(src).try_cast(dtype)
            values[raw_name] = F.when(is_default, F.lit(0).cast(dtype)).otherwise(parsed)
            # the pattern only runs on rows whose cast failed, to name the reason
            errors[raw_name] = (F.when(is_default | parsed.isNotNull(), F.lit(None))
                                .when(src.rlike(pattern), F.lit(f"{h}: out of range"))
                                .otherwise(F.lit(f"{h}: not {kind}")))
    reason = F.coalesce(*[errors[c] for c in RAW_COLUMNS])
    # Accepted rows carry a NULL source by default, so the persisted copy of the feed in
    # ``load_csv`` is not twice its size.
    source = F.struct(*[F.col(f"`{h}`").alias(h) for h in header])
    if not source_for_all:
        source = F.when(reason.isNotNull(), source)
    return with_parsed_dates(df, date_texts).select(
        *[values[c].alias(c) for c in RAW_COLUMNS], reason.alias("_reject_reason"), source.alias("_source"),
        *([F.when(reason.isNotNull(), F.col(CORRUPT)).alias("_line")] if keep_line else []))


def read_coerced(spark: SparkSession, path: str, multi_line: bool = False,
                 keep_line: bool = False) -> tuple[DataFrame, list[str]]:
    """The coerced rows of all files of a feed, each read by its own header, and the headers that
    some file lacks. ``_source`` is the source fields of a rejected row as JSON, since files may differ in them;
    with ``keep_line`` there is ``_line``, the line of a rejected row that has not as many fields as its header."""
    out, missing = None, set()
    for files in header_groups(spark, path):
        df, header = read_feed(spark, files, multi_line)
        missing |= {h for h in CSV_HEADERS if h not in header}
        rows = coerce_feed(df, header, keep_line=keep_line).withColumn("_source", F.to_json("_source"))
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        raise FileNotFoundError(f"no feed file in {path}")
    return out, [h for h in CSV_HEADERS if h in missing]


def _outcomes(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    accepted = (rows.where(F.col("_reject_reason").isNull())
                .select(*RAW_COLUMNS, F.localtimestamp().alias("_ingested_at")))
    source = F.from_json("_source", ", ".join(f"`{h}` string" for h in CSV_HEADERS)).alias("_fields")
    rejected = rows.where(F.col("_reject_reason").isNotNull()).select(source, "_reject_reason")
    return accepted, rejected.select("_fields.*", "_reject_reason")


def ingest_csv(spark: SparkSession, path: str, multi_line: bool = False) -> IngestResult:
    """Parse and coerce a feed; nothing is written (see ``load_csv``)."""
    rows, missing = read_coerced(spark, path, multi_line)
    if missing:
        log.warning("Missing expected columns: %s", missing)
    return IngestResult(*_outcomes(rows), missing)


def _swap_in(spark: SparkSession, new_folder: str, target: str) -> None:
    """Replace ``target`` by ``new_folder`` (a sibling, so both renames are metadata
    operations); the previous content is restored if the second rename fails."""
    jvm = spark.sparkContext._jvm
    new, tgt = jvm.org.apache.hadoop.fs.Path(new_folder), jvm.org.apache.hadoop.fs.Path(target)
    fs = tgt.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    old = jvm.org.apache.hadoop.fs.Path(f"{target.rstrip('/')}.replaced-{uuid.uuid4().hex[:12]}")
    had = fs.exists(tgt)
    if had and not fs.rename(tgt, old):
        raise OSError(f"cannot move {target} aside")
    if not fs.rename(new, tgt):
        if had:
            fs.rename(old, tgt)
        raise OSError(f"cannot move {new_folder} to {target}")
    if had:
        fs.delete(old, True)


def load_csv(spark: SparkSession, path: str, table_path: str, truncate: bool = False,
             rejected_path: str | None = None, multi_line: bool = False) -> dict:
    """Append (or, with ``truncate``, replace) ``raw.sales`` from a CSV feed.

    Missing input ends the job with an error before anything is written. The feed is
    parsed once: the coerced rows are written to the shared scratch folder by outcome, and the accepted and
    the rejected rows are taken from there (``sources.loads`` has one write and a ledger besides, and is what
    the daily job reads). The audit takes no further pass: loaded rows are counted
    while they are written, skipped rows by reason from the written rejected rows.
    Replacing writes the new content to a sibling folder that is renamed into place only
    after its write has committed, so a failed load never leaves an emptied table behind.
    """
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        raise FileNotFoundError(path)
    rows, missing = read_coerced(spark, path, multi_line)
    rows = materialize(rows, "ingest-coerced")
    dest = f"{table_path.rstrip('/')}.loading-{uuid.uuid4().hex[:12]}" if truncate else table_path
    accepted, rejected = _outcomes(rows)
    loaded_rows = Observation("loaded_rows")
    # Rejects first: if their write fails nothing has been appended yet, and the load may be run again.
    folder = rejected_path or scratch_path(spark, "ingest-rejected")
    rejected_target = f"{folder.rstrip('/')}/load-{uuid.uuid4().hex[:12]}"
    rejected.write.mode("errorifexists").parquet(rejected_target)
    (accepted.observe(loaded_rows, F.count(F.lit(1)).alias("rows"))
     .write.mode("errorifexists" if truncate else "append").parquet(dest))
    if truncate:
        _swap_in(spark, dest, table_path)
    # the audit: loaded rows observed during their write; skipped rows by reason from the
    # written rejected rows (one column read, one row per reason)
    counts = {r["_reject_reason"]: r["count"] for r in
              spark.read.parquet(rejected_target).groupBy("_reject_reason").count().collect()}
    loaded = int(loaded_rows.get["rows"])
    out = {"loaded": loaded, "skipped": sum(counts.values()), "reasons": counts,
           "missing_headers": missing}
    log.info("Done. Loaded: %d rows | Skipped: %d rows", out["loaded"], out["skipped"])
    return out
