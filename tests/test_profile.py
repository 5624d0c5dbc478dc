"""Profiles taken while a table is written, and what is built from them."""

import datetime as dt

from pyspark.sql import functions as F

from pitspark.operators.profile import Profile, Span, measured, profiled_write
from pitspark.plans import registry
from pitspark.plans.research import Research
from pitspark.sources.schemas import DATASETS

from .conftest import rows

SF = "/root/testdata/sf0.001"


def test_profile_of_a_write_equals_a_measurement(spark, tmp_path):
    df = spark.createDataFrame([(dt.date(2024, 1, 3), "20240107"), (dt.date(2024, 1, 2), None), (None, "20240105")], "d date, t string").repartition(3)
    for n, span in enumerate([Span("d", "d"), Span("t", "coalesce(t, '20250101')"), Span()]):
        path = str(tmp_path / str(n))
        got = profiled_write(df, span, lambda x, path=path: x.write.parquet(path))
        assert got == measured(spark.read.parquet(path), span)
    assert profiled_write(df, Span("d", "d"), lambda x: x.write.parquet(str(tmp_path / "x"))) == Profile(3, "20240102", "20240103")
    assert profiled_write(df.where("d > '2030-01-01'"), Span("d", "d"), lambda x: x.write.parquet(str(tmp_path / "y"))) == Profile(0, None, None)


def test_stored_tables_are_profiled_as_they_are_written(spark, tmp_path):
    r = Research.from_driver(spark, SF, store=str(tmp_path / "store"))
    bars = r.daily_bar_pit
    span = next(e.span for e in registry.REGISTRY if e.dataset_id == "daily_bar_pit")
    assert r.profiles["research/daily_bar_pit"] == measured(bars, span)
    assert r.profile("research/daily_bar_pit", bars.limit(0), span).rows == bars.count()  # remembered, not read again
    frame = registry.dataset_registry(spark, {"daily_bar_pit": r.profiles["research/daily_bar_pit"]})
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan and frame.first().status == "green"


def test_exceptions_turn_amber(spark):
    of = lambda n: registry.dataset_registry(spark, {"corporate_action_exception_ledger": Profile(n, None, None)}).first().status
    assert of(0) == "green" and of(3) == "amber"


def test_sync_records_each_dataset_for_itself(spark):
    good = spark.createDataFrame([("a", "20240102", 1.0), ("a", "20240103", 1.0)], "ts_code string, trade_date string, adj_factor double")
    take = lambda spec, df: measured(df, registry.dataset_span(spec))
    state = registry.sync(spark, {"adj_factor": lambda: good, "daily": lambda: good.drop("trade_date"), "namechange": lambda: spark.table("no_such_table")}, take)
    got = {r.dataset_id: tuple(r)[1:] for r in state.collect()}
    assert got["adj_factor"] == ("ok", "20240102", "20240103", 2, None)
    assert got["daily"][0] == "error" and "trade_date" in got["daily"][4] and got["daily"][1:4] == (None, None, None)
    assert got["namechange"][0] == "error" and "no_such_table" in got["namechange"][4]
    later = registry.sync(spark, {"daily": lambda: good}, take, state)
    assert {r.dataset_id: r.status for r in later.collect()} == {"adj_factor": "ok", "daily": "ok", "namechange": "error"}


def test_every_dataset_is_derived(spark):
    r = Research.from_driver(spark, SF)
    for spec in DATASETS.values():
        df = r.raw.source[spec.table] if spec.table in r.raw.source else r.raw.supplemental[spec.table]
        assert set(spec.primary_key) <= set(df.columns), spec.dataset_id
    assert rows(r.raw.source["raw_express"].select(F.substring("end_date", 5, 4)).distinct()) == [("0630",), ("1231",)]
