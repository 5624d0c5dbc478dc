"""Keyed writes: replace, latest-wins, append-dedup, incremental marks."""

import datetime as dt

from pyspark.sql import functions as F

from pitspark.operators import keyed as K
from pitspark.plans.tradeability import merge_limit_sources

from .conftest import rows


def test_upsert_replace_keeps_batch_duplicates_and_null_keys(spark):
    target = spark.createDataFrame([("a", 1, "old"), ("b", 1, "old"), (None, 1, "old-null")], "k string, d int, v string")
    batch = spark.createDataFrame([("a", 1, "new1"), ("a", 1, "new2"), (None, 1, "new-null")], "k string, d int, v string")
    out = K.upsert_replace(target, batch, ["k", "d"])
    assert rows(out, "v") == [("new-null",), ("new1",), ("new2",), ("old",), ("old-null",)]
    # replaying the batch is idempotent for non-NULL keys; a NULL key never
    # matches, so its row is appended again
    again = K.upsert_replace(out, batch, ["k", "d"])
    assert rows(again, "v") == sorted(rows(out, "v") + [("new-null",)])


def test_latest_wins_ties_prefer_source(spark):
    ts = dt.datetime(2024, 1, 1)
    src = spark.createDataFrame([("X", dt.date(2024, 1, 2), 1.0, 0.5, "s", ts)],
                                "ts_code string, trade_date date, up_limit double, down_limit double, source_table string, ingested_at timestamp")
    sup = spark.createDataFrame([("X", dt.date(2024, 1, 2), 2.0, 0.4, "p", ts), ("Y", dt.date(2024, 1, 2), 3.0, 0.3, "p", None)],
                                src.schema)
    out = merge_limit_sources([("supplemental", sup), ("source", src)])
    assert rows(out, "ts_code", "up_limit") == [("X", 1.0), ("Y", 3.0)]
    later = sup.withColumn("ingested_at", F.lit(dt.datetime(2024, 1, 3)))
    out2 = merge_limit_sources([("supplemental", later), ("source", src)])
    assert rows(out2, "ts_code", "up_limit") == [("X", 2.0), ("Y", 3.0)]


def test_append_dedup_and_reset(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "i int, s string")
    b = spark.createDataFrame([(2, "y"), (3, "z")], "i int, s string")
    assert rows(K.append_dedup(a, b)) == [(1, "x"), (2, "y"), (3, "z")]
    assert K.reset_table(a).count() == 0


def test_effective_since():
    d = dt.date
    assert K.effective_since(d(2024, 1, 5), d(2024, 1, 1)) == d(2024, 1, 6)
    assert K.effective_since(d(2024, 1, 5), d(2024, 2, 1)) == d(2024, 2, 1)
    assert K.effective_since(None, d(2024, 2, 1)) == d(2024, 2, 1)
    assert K.effective_since(d(2024, 1, 5), None, static=True) is None


def test_replace_tables_rejects_unknown(spark):
    a = spark.createDataFrame([(1,)], "i int")
    import pytest

    with pytest.raises(ValueError):
        K.replace_tables({}, {"raw_bogus": a}, allowed=["raw_dividend"], mode="replace")
