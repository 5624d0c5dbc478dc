"""What a commit of a versioned table costs: shuffles, files, micro-batches and files looked up."""

import datetime as dt
import glob
import tempfile

import pytest
from pyspark.sql import functions as F

from pitspark import catalog
from pitspark.operators import keyed as K
from pitspark.operators.versioned import VersionedTable, by_bounds, latest_delivery
from pitspark.plans.research import Research

from .conftest import rows

DDL = "k string, d string, v long, ym string"


def _rows(spark, items):
    return spark.createDataFrame([(k, d, v, None if d is None else d[:6]) for k, d, v in items], DDL)


def _exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange ")


@pytest.fixture
def table(spark):
    made = VersionedTable(spark, tempfile.mkdtemp(prefix="pitspark-commits-"), _rows(spark, []).schema, ["k", "d"], "ym")
    made.replace(_rows(spark, [(f"s{s:03d}", f"2024{m:02d}{d:02d}", s) for s in range(40) for m in (1, 2, 3) for d in range(1, 11)]))
    return made


@pytest.fixture
def research(spark):
    folder = tempfile.mkdtemp(prefix="pitspark-driver-")
    days = [dt.datetime(1996, 1, 1) + dt.timedelta(days=i) for i in range(500)]
    items = [(k, d, 100.0 + (k or 0) + i, 5.0) for k in (1, 2, 3, 7, 1001, None) for i, d in enumerate(days)]
    spark.createDataFrame(items, "l_suppkey long, l_shipdate timestamp, l_extendedprice double, l_quantity double").write.parquet(f"{folder}/lineitem.parquet")
    return Research.from_driver(spark, folder, store=tempfile.mkdtemp(prefix="pitspark-store-"))


def _query(name, research, monkeypatch):
    monkeypatch.setattr(catalog, "research_for", lambda spark, sf_dir: research)
    return catalog.QUERIES[name](research.spark, "")


def test_an_upsert_takes_one_shuffle(spark):
    base = _rows(spark, [("a", "20240101", 1), ("a", "20240101", 2), ("b", "20240102", 3), (None, "20240101", 1), (None, "20240101", 1)]).withColumns({"_delivery": F.lit(1).cast("long"), "_origin": F.lit("")})
    late, early = (base.where("k = 'a' and v = 2").withColumns({"v": F.lit(9).cast("long"), "_delivery": F.lit(n).cast("long")}) for n in (2, 0))
    for batch, want in ((late, [(None, 1), (None, 1), ("a", 9), ("b", 3)]), (early, [(None, 1), (None, 1), ("a", 1), ("a", 2), ("b", 3)])):
        got = latest_delivery(base, batch, ["k", "d"], "ym")
        assert rows(got, "k", "v") == want == rows(latest_delivery(base, batch, ["k", "d"]), "k", "v")
        written = got.sortWithinPartitions("k", "d")
        assert _exchanges(written) == 1 and written._jdf.queryExecution().executedPlan().toString().count("Sort [") == 1


def test_append_without_repeats_takes_one_shuffle(spark, table):
    old = _rows(spark, [("a", "20240101", 1), ("a", "20240101", 1), (None, None, 5), (None, None, 5), ("b", "20240201", -1)])
    new = _rows(spark, [("a", "20240101", 1), ("a", "20240101", 2), (None, None, 5), (None, "20240101", 5)])
    dealt = K.append_dedup(old, new, table.deal)
    assert _exchanges(dealt) == 1 and dealt.columns == old.columns
    assert rows(dealt) == rows(K.append_dedup(old, new))
    table.replace(dealt, dealt=True)
    assert rows(table.read()) == rows(K.append_dedup(old, new)) and table.files().agg(F.sum("rows")).first()[0] == 5


def test_corrections_of_a_month_leave_the_files_of_the_others(spark, research, monkeypatch):
    seen, upsert = [], VersionedTable.upsert
    monkeypatch.setattr(VersionedTable, "upsert", lambda self, *a, **b: seen.append(upsert(self, *a, **b)) or seen[-1])
    got = {r["step"]: r for r in _query("table_versions", research, monkeypatch).collect()}
    assert got["replay"]["rows"] == got["upsert"]["rows"] and got["reset"]["rows"] == 0 and got["upsert"]["corrected"] > 0
    assert len(seen) == 2 and all(0 < c.files_read < c.files_kept for c in seen)


def test_micro_batches_do_not_follow_the_shuffle_partitions(spark, research, monkeypatch):
    kept = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small partitions stay apart, as large ones would
    spark.conf.set("spark.sql.shuffle.partitions", "24")
    try:
        got = rows(_query("stream_deliveries", research, monkeypatch).where("source_table = 'feed_a.daily'"), "trade_date", "vol", "change")
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    root = glob.glob(f"{research.store}/deliveries-*")[0]
    landed = [glob.glob(f"{root}/landing/arrived={n}/*.parquet") for n in (1, 2, 3)]
    assert all(0 < len(files) <= 8 for files in landed)
    assert len(glob.glob(f"{root}/table/published/*")) <= 4
    day = lambda r: int(r[0][6:])
    assert all((change is None) == (8 <= day((d,)) <= 12) for d, _, change in got) and len(got) > 1500
    assert {vol for d, vol, _ in got if int(d[6:]) < 8} <= {500.0, 0.0} and {vol for d, vol, _ in got if int(d[6:]) > 12} <= {5.0, 0.0}


def test_bounds_cut_a_table_into_equal_ranges(spark, table):
    made = _rows(spark, [(f"s{s:03d}", f"2024{m:02d}{d:02d}", s) for s in range(40) for m in (1, 2, 3) for d in range(1, 11)])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        table.replace(made)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    bounds = table.bounds(3, 10**6)
    assert len(bounds) == 2 and bounds == sorted(bounds) and not table.bounds(1, 10**6)
    dealt = by_bounds(made, "ym", ["k", "d"], bounds).withColumn("p", F.spark_partition_id())
    ranges = dealt.groupBy("p").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("ym", "k", "d")).alias("low"), F.max(F.struct("ym", "k", "d")).alias("high")).orderBy("p").collect()
    assert sum(r.n for r in ranges) == 1200 and len(ranges) > 1 and max(r.n for r in ranges) <= 800
    assert all(a.high < b.low for a, b in zip(ranges, ranges[1:]))
    hollow = _rows(spark, [(None, "20240101", v) for v in range(900)])
    assert by_bounds(hollow, "ym", ["k", "d"], bounds).groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0] < 600


def test_files_that_only_later_keys_touch_are_found(spark, table):
    """The first look takes one key in 64; a file that none of those touch must be found by the others."""
    batch = _rows(spark, [(f"s{s:03d}", f"2024{m:02d}{d:02d}", -1) for s in range(40) for m in (1, 2) for d in range(1, 11)] + [("s039", "20240310", -1)])
    files = {r.path: r.part for r in table.files().collect()}
    assert {r.path for r in table.touched(batch, table.version).collect()} >= {p for p, m in files.items() if m in ("202401", "202402")}
    for s in range(40):
        assert table.touched(batch.where(f"k = 's{s:03d}' and d = '20240105'"), table.version).count() == 1
    table.upsert(batch, delivery=1)
    assert table.read().where("v = -1").count() == 801 and table.read().count() == 1200
