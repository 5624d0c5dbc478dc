"""Plan-shape assertions: no nested-loop or cartesian joins on bar-sized
inputs, filters and projections reach the Parquet scan."""

import re

import pytest

from pitspark.plans import actions
from pitspark.plans.research import Research

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def research(spark):
    return Research.from_driver(spark, SF)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["daily_bar_pit", "corporate_action_ledger", "corporate_action_exception_ledger",
                                  "tradeability_state_daily", "normalized_bars"])
def test_no_nested_loop_or_cartesian(research, name):
    plan = _plan(getattr(research, name))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("key", ["incremental_filter", "calendar_coverage"])
def test_single_values_are_subqueries(spark, key):
    from __spark_entry__ import queries

    plan = _plan(queries()[key](spark, SF))
    assert "Subquery" in plan
    assert "NestedLoopJoin" not in plan


def test_jump_window_single_key_exchange(spark, research):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = _plan(actions.significant_jumps(research.daily_bar_pit))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "Window" in plan
    # the lag window is partitioned by the security only
    assert re.search(r"Exchange hashpartitioning\(security_id#\d+, \d+\)", plan)


def test_scan_prunes_columns(spark):
    df = spark.read.parquet(f"{SF}/lineitem.parquet").where("l_quantity > 10").select("l_suppkey")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,10.0)]" in plan
    assert "ReadSchema: struct<l_suppkey:bigint,l_quantity:double>" in plan


def test_bucketed_spine_needs_no_exchange_for_jump_window(spark, tmp_path):
    r = Research.from_driver(spark, SF, store=str(tmp_path / "store"))
    bars = r.daily_bar_pit
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = _plan(actions.significant_jumps(bars))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "Window" in plan
    assert "Exchange" not in plan


def test_jump_facts_take_one_exchange_and_one_window_each_way(spark, tmp_path):
    r = Research.from_driver(spark, SF, store=str(tmp_path / "store"))
    bars, dividends, halts = r.daily_bar_pit, r.raw_dividend, r.raw_suspend_d
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = _plan(actions.jump_facts(actions.significant_jumps(bars), actions.action_rows(dividends), dividends, halts))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(re.findall(r"Exchange ", plan)) == 1
    assert len(re.findall(r"\bWindow \[", plan)) == 3  # the lag over bars, forward and back over jumps and events
    assert "Join" not in plan
