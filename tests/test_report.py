"""The assembled quality report: sections, order, promotion state, absent tables, JSON and Markdown."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from pitspark.plans import quality, report
from pitspark.sources.sinks import write_quality_report

D = dt.date
JUMPS = "security_id string, previous_trade_date date, trade_date date, previous_close double, pre_close double, factor_ratio double, done_before date, done_after date, done_same long, open_same long, blank_same long, dividend_count long, has_suspend_window boolean, nearest_days int, has_explaining_corporate_action boolean"
GATES = quality.GateParams(min_official_ratio=0.9, fail_on_missing_limit=False, fail_on_high_severity=True, max_unresolved_adj_factor_jump=1, max_missing_limit=0)


@pytest.fixture(scope="module")
def tables(spark):
    bars = spark.createDataFrame([("a", D(2024, 1, 2), "unadjusted", 1.0, 1.0, 1.0, None, 0.0), ("b", D(2024, 1, 2), "qfq_fallback", 1.0, 1.0, 1.0, 1.0, 1.0)],
                                 "security_id string, trade_date date, price_basis string, open double, high double, low double, close double, adj_factor double")
    ledger = spark.createDataFrame([("a", D(2024, 1, 2))], "security_id string, ex_date date")
    states = spark.createDataFrame([("a", None, 1.0, "official", False), ("b", 2.0, 1.0, "ohlc_fallback", None)], "security_id string, up_limit double, down_limit double, source_priority string, is_suspended boolean")
    rule = quality.ISSUE_RULES
    flags = spark.createDataFrame([(i, *rule[i]) for i in ["MISSING_LIMIT", "UNRESOLVED_ADJ_FACTOR_JUMP", "UNRESOLVED_ADJ_FACTOR_JUMP"]],
                                  "issue_type string, issue_severity string, usable_for_vpa boolean, usable_for_ml_feature boolean, usable_for_ml_label boolean, usable_for_backtest boolean, execution_restricted boolean")

    def jump(sec, day, ratio, explained=False, before=None, days=None, count=0):
        return (sec, day - dt.timedelta(days=1), day, 10.0, 10.0, ratio, before, None, 0, 0, 0, count, False, days, explained)

    jumps = spark.createDataFrame([
        jump("b", D(2023, 5, 2), 1.004), jump("b", D(2024, 5, 2), 1.2, before=D(2024, 4, 28), days=4, count=1), jump("a", D(2024, 6, 3), 1.01),
        jump("c", D(2022, 6, 3), 1.5, explained=True),
    ], JUMPS)
    return report.ReportInputs(bars, ledger, states, flags, quality.context_of(jumps))


def _of(rows, section):
    return [(r["key"], r["text"], r["number"], r["rows"], r["securities"]) for r in sorted((r for r in rows if r["section"] == section), key=lambda r: r["position"])]


def test_sections(spark, tables):
    rows = report.quality_report(spark, tables, GATES, top=1).collect()
    assert _of(rows, "state") == [("adj_factor_jump_assessable", "true", None, None, None), ("promotion_blocking_quality_state", "blocked_unresolved_adj_factor_jumps", None, None, None)]
    assert [(k, n, s) for k, _, _, n, s in _of(rows, "years")] == [("2023", 1, 1), ("2024", 2, 2)]
    assert [(k, n) for k, _, _, n, _ in _of(rows, "magnitude_buckets")] == [("<=50bp", 1), ("<=2pct", 1), (">10pct", 1)]
    assert [(k, n) for k, _, _, n, _ in _of(rows, "top_securities")] == [("b", 2)]
    summary = {k: v for k, _, v, _, _ in _of(rows, "summary")}
    assert summary["adj_factor_jump_rows"] == 4 and summary["explained_adj_factor_jump_rows"] == 1 and summary["unresolved_adj_factor_jump_count"] == 2
    assert (summary["missing_price_rows"], summary["qfq_fallback_rows"], summary["tradeability_missing_suspend_rows"], summary["official_ratio"]) == (1, 1, 1, 0.5)
    assert [t for _, t, *_ in _of(rows, "warnings")] == ["tradeability_missing_limit_rows=1"]
    assert [t for _, t, *_ in _of(rows, "failures")] == ["official_ratio 0.500000 below min_official_ratio 0.900000", "high_issue_count=2", "unresolved_adj_factor_jump_count=2 exceeds 1", "missing_limit_count=1 exceeds 0"]
    assert [(k, n) for k, _, _, n, _ in _of(rows, "triage")] == [("implemented_dividend_outside_factor_window", 1), ("low_materiality_provider_factor_noise", 1), ("provider_factor_jump_without_event_evidence", 1)]


def test_promotion_passes_without_unresolved_jumps(spark, tables):
    settled = report.ReportInputs(tables.bars, tables.ledger, tables.tradeability, tables.flags, tables.jumps.where("has_explaining_corporate_action"))
    rows = report.quality_report(spark, settled, quality.GateParams()).collect()
    assert _of(rows, "state")[1][1] == "pass" and _of(rows, "years") == [] and _of(rows, "failures") == []


def test_absent_tables_block(spark, tables):
    rows = report.quality_report(spark, report.ReportInputs(tables.bars.drop("close"), None, tables.tradeability, None, None), GATES).collect()
    assert [k for k, *_ in _of(rows, "missing_tables")] == ["corporate_action_ledger"]
    assert [t for _, t, *_ in _of(rows, "state")] == ["false", "blocked_unassessable"]
    assert {k: v for k, _, v, _, _ in _of(rows, "summary")}["missing_price_rows"] == 2


def test_examples_without_a_dividend_table(spark, tables):
    ctx = quality.context_of(tables.jumps.where("not has_explaining_corporate_action"), with_dividends=False)
    got = [(r["security_id"], r["triage_class"], r["nearest_implemented_dividend_days"]) for r in quality.jump_examples(ctx).collect()]
    assert [g[0] for g in got] == ["b", "a", "b"] and got[-1][1] == "low_materiality_provider_factor_noise"
    assert {g[1] for g in got} <= {"low_materiality_provider_factor_noise", "raw_dividend_missing"}


def test_one_scan_a_table(spark, tables, tmp_path):
    paths = {}
    for name in ("bars", "ledger", "tradeability", "flags", "jumps"):
        paths[name] = str(tmp_path / name)
        getattr(tables, name).write.parquet(paths[name])
    stored = report.ReportInputs(*(spark.read.parquet(p) for p in paths.values()))
    rows = report.quality_report(spark, stored, quality.GateParams())
    assert {r["key"]: r["number"] for r in rows.collect() if r["section"] == "summary"} == {r["key"]: r["number"] for r in report.quality_report(spark, tables, quality.GateParams()).collect() if r["section"] == "summary"}
    sections = report._jump_sections(stored.jumps, 30)[1]._jdf.queryExecution().executedPlan().toString()
    assert sections.count("FileScan") == 1


def test_json_and_markdown(spark, tables, tmp_path):
    rows = report.quality_report(spark, tables, GATES)
    said = json.loads("".join(r[0] for r in spark.read.text(write_quality_report(rows, str(tmp_path / "j")), wholetext=True).collect()))
    assert list(said) == list(report.SECTIONS)
    assert said["years"][0] == {"key": "2023", "rows": 1, "securities": 1, "earliest_date": "20230502", "latest_date": "20230502"}
    text = report.as_markdown(rows)
    assert text.startswith("# Market data quality") and text.index("## state") < text.index("## years") < text.index("## failures")
    assert "| 2024 | 2 | 2 | 20240502 | 20240603 |" in text
    write_quality_report(rows.where(F.col("section") == "years"), str(tmp_path / "m"), "markdown")
