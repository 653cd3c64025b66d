"""CSV ingest: the loader's date, coercion and row-rejection rules."""

import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from salesmart.functions.dates import parse_date_multi
from salesmart.schemas import CSV_HEADERS
from salesmart.sources.csv_ingest import ingest_csv, load_csv

HEADER = ",".join(CSV_HEADERS)
VALID = ["100001", "Europe", "France", "Baby Food", "Online", "H", "01/15/2024", "01/20/2024",
         "500", "9.28", "6.92", "4640.00", "3460.00", "1180.00"]


def _write(tmp_dir, lines, name="feed.csv", bom=False):
    path = os.path.join(tmp_dir, name)
    with open(path, "w", encoding="utf-8") as f:
        if bom:
            f.write("\ufeff")
        f.write("\n".join(lines) + "\n")
    return path


def _row(**changes):
    values = dict(zip(CSV_HEADERS, VALID))
    values.update(changes)
    return ",".join(values[h] for h in CSV_HEADERS)


@pytest.mark.parametrize("text,expected", [
    ("01/15/2024", dt.date(2024, 1, 15)),
    ("2024-01-15", dt.date(2024, 1, 15)),
    ("15/01/2024", dt.date(2024, 1, 15)),
    ("", None),
    ("not-a-date", None),
    ("  2024-06-30  ", dt.date(2024, 6, 30)),
    ("12/31/2023", dt.date(2023, 12, 31)),
    ("02/30/2024", None),
    ("03/28", None),
])
def test_parse_date_vectors(spark, text, expected):
    got = spark.createDataFrame([(text,)], "v string").select(parse_date_multi("v").alias("d")).first().d
    assert got == expected


def test_valid_row(spark, tmp_dir):
    res = ingest_csv(spark, _write(tmp_dir, [HEADER, _row()]))
    rows = res.accepted.collect()
    assert len(rows) == 1 and res.rejected.count() == 0
    r = rows[0]
    assert r.ORDER_ID == 100001 and r.REGION == "Europe"
    assert r.ORDER_DATE == dt.date(2024, 1, 15) and r.SHIP_DATE == dt.date(2024, 1, 20)
    assert r.UNITS_SOLD == 500 and r.UNIT_PRICE == Decimal("9.28") and r.TOTAL_REVENUE == Decimal("4640.00")
    assert r._ingested_at is not None


def test_coercion_rules(spark, tmp_dir):
    lines = [HEADER,
             _row(**{"Order ID": "100002", "Region": "  Europe  ", "Country": "\tFrance "}),
             _row(**{"Order ID": ""}),                          # empty id -> 0
             _row(**{"Order ID": "100004", "Unit Price": "0"}),
             _row(**{"Order ID": "100005", "Total Revenue": ""}),   # empty number -> 0
             _row(**{"Order ID": "100006", "Units Sold": "  "}),    # whitespace only: rejected
             _row(**{"Order ID": "100007", "Units Sold": "12.5"}),  # not an integer: rejected
             _row(**{"Order ID": "100008", "Unit Cost": "abc"}),    # rejected
             _row(**{"Order ID": "100009", "Order Date": "garbage"}),  # NULL date, row kept
             _row(**{"Order ID": "100010", "Unit Price": "12345678901.00"}),  # out of range
             _row(**{"Order ID": "100011", "Country": "x" * 101}),  # too long
             _row(**{"Order ID": "100012", "Unit Price": "9.285"})]  # rounds half up
    res = ingest_csv(spark, _write(tmp_dir, lines))
    acc = {r.ORDER_ID: r for r in res.accepted.collect()}
    assert acc[100002].REGION == "Europe" and acc[100002].COUNTRY == "France"
    assert 0 in acc
    assert acc[100004].UNIT_PRICE == Decimal("0.00")
    assert acc[100005].TOTAL_REVENUE == Decimal("0.00")
    assert acc[100009].ORDER_DATE is None
    assert acc[100012].UNIT_PRICE == Decimal("9.29")
    rej = {r["Order ID"]: r._reject_reason for r in res.rejected.collect()}
    assert rej == {"100006": "Units Sold: not an integer", "100007": "Units Sold: not an integer",
                   "100008": "Unit Cost: not a number", "100010": "Unit Price: out of range",
                   "100011": "Country: longer than 100"}


def test_short_and_long_lines(spark, tmp_dir):
    parts = VALID[:]
    long_line = ",".join(parts[:6] + ["03/28", "2022"] + parts[7:])   # unquoted comma in a date
    short_numeric = ",".join(["100020"] + parts[1:8])                  # ends before Units Sold
    short_text = ",".join(["100021", "Europe"])                        # ends before Country
    res = ingest_csv(spark, _write(tmp_dir, [HEADER, long_line, short_numeric, short_text]))
    rej = {r["Order ID"]: r._reject_reason for r in res.rejected.collect()}
    # surplus fields shift the numbers: Units Sold reads the ship date text
    assert rej["100001"] == "Units Sold: not an integer"
    assert rej["100021"] == "Country: missing field"
    acc = res.accepted.collect()
    assert [r.ORDER_ID for r in acc] == [100020]   # numbers past the end of the line load as 0
    assert acc[0].UNITS_SOLD == 0 and acc[0].TOTAL_PROFIT == Decimal("0.00")


def test_missing_header_defaults_and_bom(spark, tmp_dir):
    headers = [h for h in CSV_HEADERS if h not in ("Units Sold", "Region")]
    values = dict(zip(CSV_HEADERS, VALID))
    path = _write(tmp_dir, [",".join(headers), ",".join(values[h] for h in headers)], bom=True)
    res = ingest_csv(spark, path)
    assert res.missing_headers == ["Region", "Units Sold"]
    r = res.accepted.first()
    assert r.ORDER_ID == 100001 and r.REGION == "" and r.UNITS_SOLD == 0


def test_quoted_fields(spark, tmp_dir):
    line = _row(**{"Country": '"Korea, Republic of"', "Item Type": '"Say ""hi"""'})
    r = ingest_csv(spark, _write(tmp_dir, [HEADER, line])).accepted.first()
    assert r.COUNTRY == "Korea, Republic of" and r.ITEM_TYPE == 'Say "hi"'


def test_load_append_truncate_and_audit(spark, tmp_dir):
    feed = _write(tmp_dir, [HEADER, _row(), _row(**{"Order ID": "7", "Units Sold": "x"})])
    table = os.path.join(tmp_dir, "raw_sales")
    a1 = load_csv(spark, feed, table, rejected_path=os.path.join(tmp_dir, "rejected"))
    assert a1["loaded"] == 1 and a1["skipped"] == 1
    load_csv(spark, feed, table)                      # append: no key, copies are kept
    assert spark.read.parquet(table).count() == 2
    load_csv(spark, feed, table, truncate=True)       # replace
    assert spark.read.parquet(table).count() == 1
    assert spark.read.parquet(os.path.join(tmp_dir, "rejected", "*")).first()._reject_reason == "Units Sold: not an integer"
    with pytest.raises(FileNotFoundError):
        load_csv(spark, os.path.join(tmp_dir, "absent.csv"), table)


def test_truncate_swaps_in_the_new_content(spark, tmp_dir):
    feed = _write(tmp_dir, [HEADER, _row()])
    table = os.path.join(tmp_dir, "raw_sales")
    load_csv(spark, feed, table, truncate=True)       # no table yet
    load_csv(spark, feed, table)
    assert spark.read.parquet(table).count() == 2
    load_csv(spark, feed, table, truncate=True)       # written beside, then renamed into place
    assert spark.read.parquet(table).count() == 1
    assert [n for n in os.listdir(tmp_dir) if ".loading-" in n or ".replaced-" in n] == []


def test_verdict_does_not_depend_on_what_is_read(spark, tmp_dir):
    short = ",".join(VALID[:9])   # ends before Unit Price: missing numbers are 0
    path = _write(tmp_dir, [HEADER, _row(), short, "3,EU,FR"])
    res = ingest_csv(spark, path)
    assert (res.accepted.count(), len(res.accepted.collect()), res.accepted.select("REGION").count()) == (2, 2, 2)
    assert (res.rejected.count(), len(res.rejected.collect())) == (1, 1)
    assert {r.OUTCOME: r.ROWS for r in res.audit().collect()}["loaded"] == 2
    out = load_csv(spark, path, os.path.join(tmp_dir, "raw"))
    assert (out["loaded"], out["skipped"]) == (2, 1)


def test_files_of_a_folder_are_read_by_their_own_headers(spark, tmp_dir):
    folder = os.path.join(tmp_dir, "feed")
    os.makedirs(folder)
    turned = [h for h in CSV_HEADERS if h != "Country"]
    turned.insert(1, "Country")
    values = {**dict(zip(CSV_HEADERS, VALID)), "Order ID": "2", "Region": "Asia", "Country": "Japan"}
    _write(folder, [HEADER, _row()], "a.csv")
    _write(folder, [",".join(turned), ",".join(values[h] for h in turned)], "b.csv", bom=True)
    _write(folder, [HEADER, "x" + _row()], "c.csv")
    res = ingest_csv(spark, folder)
    assert sorted((r.ORDER_ID, r.REGION, r.COUNTRY) for r in res.accepted.collect()) == [
        (2, "Asia", "Japan"), (100001, "Europe", "France")]
    assert [r["Order ID"] for r in res.rejected.collect()] == ["x100001"]


def test_quoted_line_ends(spark, tmp_dir):
    path = _write(tmp_dir, [HEADER, _row(Country='"New\nCaledonia"'), _row(**{"Order ID": "7"})])
    res = ingest_csv(spark, path, multi_line=True)
    assert sorted((r.ORDER_ID, r.COUNTRY) for r in res.accepted.collect()) == [
        (7, "France"), (100001, "New\nCaledonia")]
    assert res.rejected.count() == 0


def test_rejects_are_kept_per_load(spark, tmp_dir):
    path, rejects = _write(tmp_dir, [HEADER, "x" + _row()]), os.path.join(tmp_dir, "rejects")
    for _ in range(2):
        load_csv(spark, path, os.path.join(tmp_dir, "raw"), rejected_path=rejects)
    assert spark.read.parquet(*[os.path.join(rejects, f) for f in os.listdir(rejects)]).count() == 2
