"""End-to-end scenarios: one trading week of five invented securities; expectations worked out by hand from the rules.

* Harbor: a paid dividend explains its factor step; a halted day without volume.
* Lantern: a factor step over a halted day, without any dividend.
* Quartz: only adjusted bars.   * Meadow: special treatment from its second day, which has no opening price.
* Willow: a factor step eleven days ahead of a paid dividend.   * Bay: listed elsewhere, so left out.
"""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pitspark.plans import quality
from pitspark.plans.normalized import CONTRACT_COLUMNS
from pitspark.plans.research import Research
from pitspark.sources.derive import RawSources

from .conftest import rows

HARBOR, LANTERN, QUARTZ, MEADOW, WILLOW, BAY = "600111.SH", "301222.SZ", "688333.SH", "920444.BJ", "000555.SZ", "00077.HK"
MON, TUE, WED, THU, FRI = "20310303", "20310304", "20310305", "20310306", "20310307"
LOADED = dt.datetime(2031, 3, 8, 6, 30)
TEXT = {"ts_code", "trade_date", "symbol", "name", "area", "industry", "list_date", "delist_date", "is_hs", "source_table",
        "start_date", "end_date", "ann_date", "change_reason", "div_proc", "record_date", "ex_date", "pay_date", "div_listdate",
        "suspend_timing", "suspend_type", "security_id", "industry_schema", "industry_code", "industry_name", "effective_at", "removed_at"}
PRICES = "ts_code trade_date open high low close pre_close change pct_chg vol amount source_table ingested_at"
BASICS = ("ts_code trade_date close turnover_rate turnover_rate_f volume_ratio pe pe_ttm pb ps ps_ttm dv_ratio dv_ttm "
          "total_share float_share free_share total_mv circ_mv source_table ingested_at")
REPORTS = ("ts_code ann_date end_date eps roe roa gross_margin netprofit_margin current_ratio debt_to_assets revenue_ps "
           "netprofit_yoy dt_netprofit_yoy or_yoy q_sales_yoy assets_yoy equity_yoy")

# security, day, open, close, close of the day before, volume, factor
BARS = [
    (HARBOR, MON, 7.8, 8.0, 7.9, 40.0, 1.0), (HARBOR, TUE, 8.1, 8.2, 8.0, 41.0, 1.0), (HARBOR, WED, 6.5, 6.6, 6.56, 42.0, 1.25),
    (HARBOR, THU, 6.7, 6.7, 6.6, 0.0, 1.25), (HARBOR, FRI, 6.8, 6.9, 6.7, 44.0, 1.25),
    (LANTERN, MON, 39.0, 39.5, 39.0, 7.0, 2.0), (LANTERN, TUE, 39.5, 40.0, 39.5, 8.0, 2.0), (LANTERN, THU, 40.5, 41.0, 40.0, 9.0, 2.1),
    (MEADOW, MON, 3.0, 3.1, 3.0, 12.0, 1.0), (MEADOW, TUE, 0.0, 3.1, 3.1, 12.0, 1.0),
    (WILLOW, MON, 20.0, 21.0, 20.0, 5.0, 1.0), (WILLOW, TUE, 21.0, 21.5, 21.0, 5.0, 1.1),
]


def frame(spark, columns, *records):
    """Records are dictionaries; columns that they do not name are null."""
    names = columns.split()
    kinds = ", ".join(f"{c} {'string' if c in TEXT else 'timestamp' if c == 'ingested_at' else 'double'}" for c in names)
    return spark.createDataFrame([tuple(r.get(c, LOADED if c == "ingested_at" else None) for c in names) for r in records], kinds)


def build(spark) -> Research:
    listed = [(HARBOR, "Harbor"), (LANTERN, "Lantern"), (QUARTZ, "Quartz"), (MEADOW, "Meadow"), (WILLOW, "Willow"), (BAY, "Bay")]
    days = {(b[0], b[1]) for b in BARS} | {(QUARTZ, MON), (BAY, MON)}
    source = {
        "stock_basic_ref": frame(spark, "ts_code symbol name area industry list_date delist_date is_hs ingested_at source_table",
                                 *({"ts_code": c, "symbol": c[:-3], "name": n, "list_date": "20200106"} for c, n in listed)),
        "raw_namechange": frame(spark, "ts_code name start_date end_date ann_date change_reason source_table ingested_at",
                                {"ts_code": MEADOW, "name": "*ST Meadow", "start_date": TUE}, {"ts_code": HARBOR, "name": "Harbor", "start_date": "20200106"}),
        "raw_kline_unadj": frame(spark, PRICES, *(
            {"ts_code": c, "trade_date": d, "open": o, "high": max(o, x), "low": min(o, x), "close": x, "pre_close": p, "vol": v, "amount": v * x}
            for c, d, o, x, p, v, _ in BARS)),
        "raw_kline_qfq": frame(spark, PRICES, {"ts_code": QUARTZ, "trade_date": MON, "open": 50.0, "high": 51.0, "low": 49.0, "close": 50.5,
                                               "pre_close": 49.5, "vol": 3.0, "amount": 150.0}),
        "raw_adj_factor": frame(spark, "ts_code trade_date adj_factor source_table ingested_at",
                                *({"ts_code": b[0], "trade_date": b[1], "adj_factor": b[6]} for b in BARS),
                                {"ts_code": QUARTZ, "trade_date": MON, "adj_factor": 1.5}),
        "raw_daily_basic": frame(spark, BASICS, *({"ts_code": c, "trade_date": d, "turnover_rate": 0.4} for c, d in sorted(days))),
        "pit_fina_indicator": frame(spark, REPORTS, *({"ts_code": c, "ann_date": d, "end_date": "20301231", "eps": 0.7}
                                                      for c, d in [(HARBOR, TUE), (LANTERN, ""), (QUARTZ, FRI), (MEADOW, "20310228")])),
        "raw_dividend": frame(
            spark, "ts_code end_date ann_date div_proc stk_div stk_bo_rate stk_co_rate cash_div cash_div_tax record_date ex_date pay_date div_listdate source_table ingested_at",
            {"ts_code": HARBOR, "end_date": "20301231", "div_proc": "实施", "stk_div": 0.05, "stk_co_rate": 0.2, "cash_div": 0.3, "record_date": TUE, "ex_date": WED},
            {"ts_code": MEADOW, "end_date": "20301231", "div_proc": "股东大会通过", "cash_div": 0.1, "ex_date": TUE},
            {"ts_code": WILLOW, "end_date": "20301231", "div_proc": "实施", "cash_div_tax": 0.6, "cash_div": 0.5, "ex_date": "20310315", "pay_date": "20310318"}),
        "raw_stk_limit": frame(spark, "ts_code trade_date up_limit down_limit source_table ingested_at",
                               {"ts_code": HARBOR, "trade_date": MON, "up_limit": 8.7, "down_limit": 7.1}, {"ts_code": HARBOR, "trade_date": TUE, "up_limit": 8.8},
                               {"ts_code": HARBOR, "trade_date": WED, "up_limit": 7.2, "down_limit": 5.9}, {"ts_code": QUARTZ, "trade_date": MON, "up_limit": 54.5, "down_limit": 44.5}),
        "raw_suspend_d": frame(spark, "ts_code trade_date suspend_timing suspend_type source_table ingested_at",
                               {"ts_code": HARBOR, "trade_date": THU, "suspend_type": "S"}, {"ts_code": LANTERN, "trade_date": WED, "suspend_timing": "", "suspend_type": "S"},
                               {"ts_code": MEADOW, "trade_date": MON, "suspend_timing": "10:00-10:30", "suspend_type": "S"}),
    }
    groups = frame(spark, "security_id industry_schema industry_code industry_name effective_at removed_at",
                   {"security_id": HARBOR, "industry_schema": "sw2021_l2", "industry_code": "K11", "industry_name": "Docks", "effective_at": "20300101"},
                   {"security_id": HARBOR, "industry_schema": "sw2021_l1", "industry_code": "K10", "effective_at": "20300101"},
                   {"security_id": LANTERN, "industry_schema": "sw2021_l1", "industry_code": "M20", "industry_name": "Lamps", "effective_at": THU})
    return Research(spark, RawSources(source, {"industry_classification_pit": groups}, {}))


@pytest.fixture(scope="module")
def week(spark):
    return build(spark)


def test_normalized_bars(week):
    bars = week.stock_bar_normalized_daily
    assert bars.columns == CONTRACT_COLUMNS
    got = {(r.code, r.trade_date): r for r in bars.collect()}
    assert set(got) == {(b[0], b[1]) for b in BARS} | {(QUARTZ, MON)}
    assert [got[HARBOR, d].prev_close for d in (MON, TUE, WED, THU)] == pytest.approx([7.9, 8.0, 8.2, 8.25])
    assert (got[HARBOR, WED].limit_up, got[HARBOR, WED].limit_down) == pytest.approx((9.0, 7.375))  # scaled by 1.25
    assert (got[HARBOR, TUE].limit_up, got[HARBOR, TUE].limit_down) == (pytest.approx(8.8), None)
    assert [got[MEADOW, d].is_st for d in (MON, TUE)] == [False, True]
    assert (got[HARBOR, FRI].industry_code, got[HARBOR, FRI].industry_name) == ("K10", "K10")  # the first level; its name is missing
    assert [got[LANTERN, d].industry_name for d in (MON, THU)] == ["UNKNOWN", "Lamps"]


def test_adjusted_bars_keep_their_limits(week):
    row = week.stock_bar_normalized_daily.where(F.col("code") == QUARTZ).first()
    bar = week.daily_bar_pit.where(F.col("security_id") == QUARTZ).first()
    assert (row.close, row.limit_up, row.limit_down, row.prev_close) == pytest.approx((50.5, 54.5, 44.5, 49.5))
    assert (bar.adj_factor, bar.price_basis) == (1.5, "qfq_fallback")


def test_tradeability(week):
    state = {(r.security_id, f"{r.trade_date:%Y%m%d}"): (r.is_suspended, r.source_priority) for r in week.tradeability_state_daily.collect()}
    assert state[HARBOR, THU] == (True, "official")  # halted all day, nothing traded
    assert state[MEADOW, MON] == (False, "official")  # halted for half an hour
    assert state[MEADOW, TUE] == (True, "ohlc_fallback")  # no opening price
    assert state[LANTERN, MON] == (False, "ohlc_fallback")
    ratios = quality.source_ratios(week.tradeability_state_daily).first()
    assert (ratios.tradeability_total_rows, ratios.official_ratio) == (13, pytest.approx(6 / 13))


def test_ledger(week):
    got = {r.action_id: (r.action_type, r.cash_per_share, r.share_ratio, r.book_date) for r in week.corporate_action_ledger.collect()}
    assert got == {
        f"{HARBOR}:20301231:{WED}:cash": ("cash_dividend", 0.3, 0.0, dt.date(2031, 3, 5)),
        f"{HARBOR}:20301231:{WED}:share": ("share_dividend", 0.0, 0.25, dt.date(2031, 3, 5)),
        f"{WILLOW}:20301231:20310315:cash": ("cash_dividend", 0.6, 0.0, dt.date(2031, 3, 18)),
        f"{WILLOW}:{TUE}:inferred_adj_factor_repair": ("inferred_adj_factor_repair", 0.0, 0.0, dt.date(2031, 3, 4)),
    }


def test_exception(week):
    (r,) = week.corporate_action_exception_ledger.collect()
    assert r.exception_id == f"{LANTERN}:{TUE}:{THU}:adj_factor_exception"
    assert (r.magnitude_bucket, r.severity, r.has_suspend_window) == ("<=10pct", "high", True)
    assert r.triage_class == "provider_factor_jump_without_event_evidence"
    assert (r.factor_ratio, r.pre_close_factor_ratio, r.factor_pre_close_basis_diff) == pytest.approx((1.05, 1.0, 0.05))


def test_flags(week):
    assert dict(rows(quality.issue_counts_by_type(week.usability_flags))) == {
        "MISSING_LIMIT": 10, "MISSING_INDUSTRY_CODE": 7, "UNRESOLVED_ADJ_FACTOR_JUMP": 1}
    jump = week.usability_flags.where("issue_type = 'UNRESOLVED_ADJ_FACTOR_JUMP'").first()
    assert (jump.affected_start, jump.affected_end) == (dt.date(2031, 3, 3), dt.date(2031, 3, 6))  # clamped to its own days


def test_reports_count_from_the_next_trading_day(week):
    assert rows(week.fundamental_snapshot_pit, "security_id", "available_date") == [(HARBOR, dt.date(2031, 3, 5)), (MEADOW, dt.date(2031, 3, 3))]
