"""Ingest queries S1-S12 over a CSV feed written from the adapter tables.

The oracle rebuilds the same feed text in SQL and applies the coercion rules with
DuckDB's own casts and pattern matching, so the check is independent of our parser.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..schemas import CSV_HEADERS, HEADER_TO_RAW, RAW_COLUMNS, RAW_MAX_LENGTH
from ..sources import csv_ingest as CI
from ..sources.testdata import FEED_DATE_FORMATS, FEED_DEFECTS
from .core import W, model, register

_JAVA_TO_STRFTIME = {"MM/dd/yyyy": "%m/%d/%Y", "yyyy-MM-dd": "%Y-%m-%d", "dd/MM/yyyy": "%d/%m/%Y"}
DROPPED_HEADERS = ("Ship Date", "Total Profit")


def _q(h: str) -> str:
    return '"' + h + '"'


def _t(h: str) -> str:
    """Name of a source-text column inside the oracle's ``coerced`` CTE."""
    return '"text:' + h + '"'


def _fmt_sql(col: str, selector: str) -> str:
    whens = " ".join(f"WHEN {i} THEN strftime({col}, '{_JAVA_TO_STRFTIME[f]}')"
                     for i, f in enumerate(FEED_DATE_FORMATS))
    return f"(CASE {selector} {whens} END)"


def _feed_sql(drop: tuple[str, ...] = ()) -> str:
    clean = {h: f"CAST({c} AS VARCHAR)" for h, c in HEADER_TO_RAW.items()}
    clean["Order Date"] = _fmt_sql("ORDER_DATE", "(ORDER_ID // 10) % 3")
    clean["Ship Date"] = _fmt_sql("SHIP_DATE", "((ORDER_ID // 10) + 1) % 3")
    cols = dict(clean)
    for key, (header, text) in FEED_DEFECTS.items():
        parts = text.split("{v}")
        planted = " || ".join(
            p for i, part in enumerate(parts)
            for p in ([f"'{part}'".replace("\t", "' || chr(9) || '")] + ([clean[header]] if i < len(parts) - 1 else [])))
        cols[header] = f"(CASE WHEN ORDER_ID % 1000 = {key} THEN {planted} ELSE {cols[header]} END)"
    return "feed AS (SELECT " + ", ".join(
        f"{cols[h]} AS {_q(h)}" for h in CSV_HEADERS if h not in drop) + " FROM raw_sales)"


def _coerced_sql(drop: tuple[str, ...] = ()) -> str:
    """Coercion of the feed in SQL: values and the first failure reason."""
    values, errors = {}, {}
    for h, c in HEADER_TO_RAW.items():
        v = "CAST(NULL AS VARCHAR)" if h in drop else f"NULLIF({_q(h)}, '')"
        if c in CI.TEXT_COLUMNS:
            text = f"regexp_replace(COALESCE({v}, ''), '^\\s+|\\s+$', '', 'g')"
            values[c] = text
            errors[c] = f"CASE WHEN length({text}) > {RAW_MAX_LENGTH[c]} THEN '{h}: longer than {RAW_MAX_LENGTH[c]}' END"
        elif c in CI.DATE_COLUMNS:
            values[c] = (f"CAST(TRY_STRPTIME(regexp_replace(COALESCE({v}, ''), '^\\s+|\\s+$', '', 'g'), "
                         f"['%m/%d/%Y', '%Y-%m-%d', '%d/%m/%Y']) AS DATE)")
            errors[c] = "CAST(NULL AS VARCHAR)"
        else:
            if c in CI.INT_COLUMNS:
                typ = "BIGINT" if c == "ORDER_ID" else "INTEGER"
                pat, kind = CI.INT_PATTERN, "an integer"
            else:
                typ = "DECIMAL(12,2)" if c in ("UNIT_PRICE", "UNIT_COST") else "DECIMAL(14,2)"
                pat, kind = CI.NUMBER_PATTERN, "a number"
            parsed = f"TRY_CAST(trim({v}) AS {typ})"
            values[c] = f"CASE WHEN {v} IS NULL THEN CAST(0 AS {typ}) ELSE {parsed} END"
            errors[c] = (f"CASE WHEN {v} IS NULL THEN NULL WHEN NOT regexp_matches({v}, '{pat}') "
                         f"THEN '{h}: not {kind}' WHEN {parsed} IS NULL THEN '{h}: out of range' END")
    reason = "COALESCE(" + ", ".join(errors[c] for c in RAW_COLUMNS) + ")"
    src = ", ".join(f"NULLIF({_q(h)}, '') AS {_t(h)}" for h in CSV_HEADERS if h not in drop)
    return ("coerced AS (SELECT " + ", ".join(f"{values[c]} AS {c}" for c in RAW_COLUMNS)
            + f", {reason} AS _reject_reason, {src} FROM feed)")


def _with_feed(select: str, drop: tuple[str, ...] = ()) -> str:
    return W(select, extra_ctes=_feed_sql(drop) + ",\n" + _coerced_sql(drop))


def _coerced(spark, sf, drop=()):
    df, header = CI.read_feed(spark, model(spark, sf).feed_path(drop))
    return CI.coerce_feed(df, header, source_for_all=True)


def _ingested(spark, sf, drop=()):
    return CI.ingest_csv(spark, model(spark, sf).feed_path(drop))


_SRC_COLS = ", ".join(f"{_t(h)} AS {_q(h)}" for h in CSV_HEADERS)


@register("s1_csv_scan", _with_feed(f"SELECT {_SRC_COLS} FROM coerced"))
def s1(spark, sf):
    df, _ = CI.read_feed(spark, model(spark, sf).feed_path())
    return df.select(*[F.col(f"`{h}`") for h in CSV_HEADERS])


_ACCEPTED = ", ".join(RAW_COLUMNS)


@register("s2_missing_header_defaults",
          _with_feed(f"SELECT {_ACCEPTED} FROM coerced WHERE _reject_reason IS NULL", DROPPED_HEADERS))
def s2(spark, sf):
    return _ingested(spark, sf, DROPPED_HEADERS).accepted.drop("_ingested_at")


@register("s3_date_parsing", _with_feed("""
SELECT DISTINCT "text:Order Date" AS ORDER_DATE_TEXT, ORDER_DATE FROM coerced"""))
def s3(spark, sf):
    return (_coerced(spark, sf)
            .select(F.col("_source.`Order Date`").alias("ORDER_DATE_TEXT"), "ORDER_DATE").distinct())


@register("s4_text_stripping", _with_feed("""
SELECT DISTINCT "text:Region" AS REGION_TEXT, REGION FROM coerced"""))
def s4(spark, sf):
    return _coerced(spark, sf).select(F.col("_source.Region").alias("REGION_TEXT"), "REGION").distinct()


@register("s5_numeric_coercion", _with_feed("""
SELECT "text:Order ID" AS ORDER_ID_TEXT, ORDER_ID, "text:Units Sold" AS UNITS_SOLD_TEXT, UNITS_SOLD,
       "text:Unit Price" AS UNIT_PRICE_TEXT, UNIT_PRICE FROM coerced"""))
def s5(spark, sf):
    return _coerced(spark, sf).select(
        F.col("_source.`Order ID`").alias("ORDER_ID_TEXT"), "ORDER_ID",
        F.col("_source.`Units Sold`").alias("UNITS_SOLD_TEXT"), "UNITS_SOLD",
        F.col("_source.`Unit Price`").alias("UNIT_PRICE_TEXT"), "UNIT_PRICE")


@register("s6_rejected_rows", _with_feed(f"SELECT {_SRC_COLS}, _reject_reason FROM coerced WHERE _reject_reason IS NOT NULL"))
def s6(spark, sf):
    return _ingested(spark, sf).rejected


@register("s10_ingest_timestamp", _with_feed("""
SELECT CAST(1 AS BIGINT) AS DISTINCT_LOAD_TIMES, COUNT(*) AS STAMPED_ROWS
FROM coerced WHERE _reject_reason IS NULL"""))
def s10(spark, sf):
    acc = _ingested(spark, sf).accepted
    return acc.agg(F.countDistinct("_ingested_at").alias("DISTINCT_LOAD_TIMES"),
                   F.count("_ingested_at").alias("STAMPED_ROWS"))


@register("s11_load_audit", _with_feed("""
SELECT COALESCE(_reject_reason, 'loaded') AS OUTCOME, COUNT(*) AS ROWS FROM coerced GROUP BY 1"""))
def s11(spark, sf):
    return _ingested(spark, sf).audit()


@register("s12_ingest_accepted", _with_feed(f"SELECT {_ACCEPTED} FROM coerced WHERE _reject_reason IS NULL"))
def s12(spark, sf):
    return _ingested(spark, sf).accepted.drop("_ingested_at")
