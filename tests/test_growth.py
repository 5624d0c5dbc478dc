"""What keeps the work in proportion to the input: partitions that follow the rows, one shuffle of the stored bars."""

import datetime as dt
import tempfile

import pytest

from pitspark.plans.research import Research
from pitspark.session import ROWS_A_PARTITION, partitions_for
from pitspark.sources.derive import DriverTables

from .conftest import rows


@pytest.fixture
def driver_tables(spark):
    folder = tempfile.mkdtemp(prefix="pitspark-driver-")
    days = [dt.datetime(1996, 1, 1) + dt.timedelta(days=i) for i in range(40)]
    items = [(k, d, 100.0 + (k or 0) + i, 5.0) for k in (1, 2, 3, 7, 1001, None) for i, d in enumerate(days)]
    spark.createDataFrame(items, "l_suppkey long, l_shipdate timestamp, l_extendedprice double, l_quantity double").write.parquet(f"{folder}/lineitem.parquet")
    return folder


def test_partitions_follow_the_rows(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert partitions_for(spark, ROWS_A_PARTITION) == int(before)
        assert partitions_for(spark, 50 * ROWS_A_PARTITION + 1) == 51 == int(spark.conf.get("spark.sql.shuffle.partitions"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_projections_of_stored_bars_join_without_a_shuffle(spark, driver_tables):
    r = Research.from_driver(spark, driver_tables, store=tempfile.mkdtemp(prefix="pitspark-store-"))
    u, a = r.src("raw_kline_unadj").select("ts_code", "trade_date", "close"), r.src("raw_adj_factor").select("ts_code", "trade_date", "adj_factor")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = u.join(a, ["ts_code", "trade_date"])
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        plain = DriverTables(spark, driver_tables)
        assert rows(joined) == rows(plain.raw_kline_unadj().select("ts_code", "trade_date", "close").join(plain.raw_adj_factor().select("ts_code", "trade_date", "adj_factor"), ["ts_code", "trade_date"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_previous_close_stays_with_the_supplier(spark, driver_tables):
    got = DriverTables(spark, driver_tables).bars
    first = got.where("prev_close is null")
    assert rows(first, "k") == rows(got.select("k").distinct(), "k")
