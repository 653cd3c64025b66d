"""The adapter's joins, the feed it writes and the rows that staging's dedup sends."""

import glob
import re
from decimal import Decimal

from pyspark.sql import functions as F

from salesmart.plans import staging as ST
from salesmart.schemas import RAW_SALES
from salesmart.sources import testdata as TD

SF_SMALL = "/root/testdata/sf0.001"


def test_joins_shuffle_narrow_rows(spark):
    """Where the joins shuffle, names of places, priorities' texts, statuses and times of day are not sent."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        raw = TD.raw_sales(spark, SF_SMALL).drop("_ingested_at")
        plan = raw._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        want = raw.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    sent = re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*?)\]", plan)
    assert len(sent) >= 4
    assert not re.findall(r"n_name|r_name|o_orderpriority|l_linestatus|l_shipdate|ship_time", " ".join(sent))
    assert TD.raw_sales(spark, SF_SMALL).count() == want


def test_feed_is_compressed_in_bounded_files(spark, tmp_dir, monkeypatch):
    raw = TD.raw_sales(spark, SF_SMALL).coalesce(1)
    monkeypatch.setattr(TD, "FEED_FILE_ROWS", 1000)
    path = TD.write_feed(raw, f"{tmp_dir}/feed")
    files = glob.glob(f"{path}/part-*.csv.gz")
    assert len(files) == -(-raw.count() // 1000)
    assert spark.read.option("header", True).csv(path).count() == raw.count()


def test_staging_sends_agreeing_totals_as_zeros(spark):
    """Totals of any kind come back as they were, also the widest, and still decide between copies."""
    most, price = Decimal("999999999999.99"), Decimal("9999999999.99")

    def row(order_id, units, unit_price, cost, revenue, total_cost, profit):
        return (order_id, "r", "c", "i", "Online", "H", None, None, units, unit_price, cost, revenue, total_cost, profit, None)

    two, six = Decimal("2.00"), Decimal("6.00")
    rows = [row(1, 3, two, two, six, six, Decimal("0.00")), row(1, 3, two, two, six, six, Decimal("0.01")),
            row(2, 3, two, two, Decimal("5.99"), six, None), row(2, 3, two, two, six, six, Decimal("-1.00")),
            row(3, 2147483647, price, price, most, -most, most), row(3, 2147483647, price, price, most, -most, -most),
            row(4, -2147483648, price, None, -most, most, most), row(5, None, None, None, None, None, None)]
    raw = spark.createDataFrame(rows, RAW_SALES).withColumn("ORDER_DATE", F.lit("2024-01-02").cast("date"))
    staged = ST.build_staging(raw)
    got = {r.order_id: (r.total_revenue, r.total_cost, r.total_profit) for r in staged.collect()}
    zero = Decimal("0.00")
    assert got == {1: (six, six, Decimal("0.01")), 2: (six, six, Decimal("-1.00")), 3: (most, -most, most),
                   4: (-most, most, most), 5: (zero, zero, zero)}
    assert staged.dtypes == ST.staging_base(raw).dtypes
    sent = ST._less_expected(ST.staged_rows(raw.where("ORDER_ID = 1"))).agg(F.max("total_revenue"), F.max("total_cost")).first()
    assert tuple(sent) == (0, 0)
