"""Final SELECT per query key (DuckDB), matching ``pitspark.catalog``."""

from __future__ import annotations

from .events_sql import PROXIMITY, TRIAGE, TRIAGE_ORDER, first_that_holds, place_in
from .pipeline_sql import K, TSX

QUERIES: dict[str, str] = {
    "security_master": f"""
        SELECT * REPLACE ({K('list_date')} AS list_date, {K('delist_date')} AS delist_date,
                          {TSX('ingested_at')} AS ingested_at)
        FROM security_master_ref""",
    "board_counts": """
        SELECT board, exchange, count(*) AS securities FROM security_master_ref GROUP BY 1, 2""",
    "static_industry": """
        SELECT ts_code AS security_id, name AS current_name, industry AS industry_name,
               'current_static' AS classification_scope
        FROM stock_basic_ref WHERE split_part(ts_code, '.', 2) IN ('SZ', 'SH', 'BJ')""",
    "trade_calendar": f"SELECT {K('trade_date')} AS trade_date FROM market_trade_calendar",
    "name_st_windows": f"""
        SELECT security_id, name, {K('start_date')} AS start_date, {K('end_date')} AS end_date,
               {K('announcement_date')} AS announcement_date, change_reason, is_st_name
        FROM name_change_history""",
    "st_daily": f"SELECT {K('trade_date')} AS trade_date, security_id, is_st FROM st_daily",
    "daily_bar_pit": f"""
        SELECT * REPLACE ({K('trade_date')} AS trade_date, {TSX('ingested_at')} AS ingested_at) FROM daily_bar_pit""",
    "adjusted_prices": f"""
        SELECT security_id, {K('trade_date')} AS trade_date, price_basis, open_adj, high_adj, low_adj, close_adj,
               adjusted_price_source, volume_shares, turnover_value_cny, total_shares, total_mcap_cny
        FROM daily_bar_pit""",
    "fundamental_available_date": f"""
        SELECT * REPLACE ({K('announcement_date')} AS announcement_date, {K('period_end')} AS period_end,
                          {K('available_date')} AS available_date)
        FROM fundamental_snapshot_pit""",
    "industry_asof": f"""
        SELECT security_id, {K('trade_date')} AS trade_date, industry_schema, industry_code, industry_name,
               {K('effective_at')} AS effective_at, {K('removed_at')} AS removed_at
        FROM industry_match""",
    "canonical_industry": f"""
        SELECT security_id, {K('trade_date')} AS trade_date, industry_code, industry_name, industry_schema
        FROM industry_pick""",
    "limit_merge_latest": f"""
        SELECT ts_code, {K('trade_date')} AS trade_date, up_limit, down_limit, source_table,
               {TSX('ingested_at')} AS ingested_at
        FROM limits_merged""",
    "suspend_key": f"SELECT * REPLACE ({K('trade_date')} AS trade_date) FROM suspend_key",
    "limit_key": f"SELECT * REPLACE ({K('trade_date')} AS trade_date) FROM limit_key",
    "tradeability_state": f"SELECT * REPLACE ({K('trade_date')} AS trade_date) FROM tradeability_state_daily",
    "normalized_bars": f"SELECT * REPLACE ({K('trade_date')} AS trade_date) FROM normalized",
    "prev_close": f"SELECT security_id, {K('trade_date')} AS trade_date, close_adj, prev_close FROM bars_prev_close",
    "index_bars": f"""
        SELECT * REPLACE ({K('trade_date')} AS trade_date, {TSX('ingested_at')} AS ingested_at) FROM index_daily_pit""",
    "action_rows": f"""
        SELECT * REPLACE ({K('record_date')} AS record_date, {K('book_date')} AS book_date, {K('ex_date')} AS ex_date)
        FROM action_rows""",
    "adj_jumps": f"""
        SELECT * REPLACE ({K('previous_trade_date')} AS previous_trade_date, {K('trade_date')} AS trade_date)
        FROM sig_jumps""",
    "unexplained_jumps": f"""
        SELECT security_id, {K('previous_trade_date')} AS previous_trade_date, {K('trade_date')} AS trade_date, factor_ratio
        FROM unres_vs_actions""",
    "explained_flag": f"""
        SELECT security_id, {K('trade_date')} AS trade_date, has_explaining_corporate_action FROM jump_facts""",
    "nearest_dividend": f"""
        SELECT security_id, {K('trade_date')} AS trade_date, nearest_days AS nearest_implemented_dividend_days FROM jump_facts""",
    "suspend_in_window": f"""
        SELECT security_id, {K('previous_trade_date')} AS previous_trade_date, {K('trade_date')} AS trade_date, has_suspend_window
        FROM jump_facts""",
    "inferred_repairs": f"""
        SELECT * REPLACE ({K('record_date')} AS record_date, {K('book_date')} AS book_date, {K('ex_date')} AS ex_date)
        FROM inferred_repairs""",
    "corporate_action_ledger": f"""
        SELECT * REPLACE ({K('record_date')} AS record_date, {K('book_date')} AS book_date, {K('ex_date')} AS ex_date)
        FROM ledger""",
    "exception_ledger": f"""
        SELECT * REPLACE ({K('previous_trade_date')} AS previous_trade_date, {K('trade_date')} AS trade_date)
        FROM exception_ledger""",
}

_FLAG_COLS = ("trade_date, code, issue_type, issue_severity, usable_for_vpa, usable_for_ml_feature, usable_for_ml_label, "
              "usable_for_backtest, execution_restricted, affected_start, affected_end, issue_detail")
_D3 = f"{K('trade_date')} AS trade_date, {K('affected_start')} AS affected_start, {K('affected_end')} AS affected_end"

QUERIES.update({
    "missing_limit": f"""
        SELECT security_id, {K('trade_date')} AS trade_date, up_limit, down_limit
        FROM tradeability_state_daily WHERE up_limit IS NULL OR down_limit IS NULL""",
    "missing_industry": f"""
        SELECT DISTINCT {K('trade_date')} AS trade_date, code FROM normalized
        WHERE industry_code IS NULL OR industry_code = 'UNKNOWN'""",
    "incomplete_dates": f"SELECT * REPLACE ({K('trade_date')} AS trade_date) FROM incomplete_dates",
    "date_row_counts": f"SELECT * REPLACE ({K('trade_date')} AS trade_date) FROM date_counts",
    "affected_window": f"""
        SELECT code, {K('trade_date')} AS trade_date, {K('previous_trade_date')} AS previous_trade_date, factor_ratio,
               triage_class, {K('affected_start')} AS affected_start, {K('affected_end')} AS affected_end
        FROM affected""",
    "usability_flags": f"SELECT * REPLACE ({_D3}) FROM flags",
    "issue_counts": "SELECT * FROM issue_counts",
    "issue_counts_by_type": "SELECT issue_type, count(*) AS row_count FROM flags GROUP BY 1",
    "quality_scalars": "SELECT metric, CAST(value AS BIGINT) AS value FROM quality_scalars",
    "source_ratios": "SELECT * FROM source_ratios",
    "quality_gates": f"""
        SELECT 'min_official_ratio' AS gate, official_ratio AS observed, CAST(0.5 AS DOUBLE) AS threshold,
               CASE WHEN official_ratio < 0.5 THEN 'failure' ELSE 'pass' END AS outcome
        FROM source_ratios
        UNION ALL
        SELECT 'missing_limit_rows', CAST(value AS DOUBLE), NULL::DOUBLE,
               CASE WHEN value > 0 THEN 'warning' ELSE 'pass' END
        FROM quality_scalars WHERE metric = 'tradeability_missing_limit_rows'
        UNION ALL
        SELECT 'incomplete_trading_date_count', CAST(incomplete_trading_date_count AS DOUBLE), NULL::DOUBLE,
               CASE WHEN incomplete_trading_date_count > 0 THEN 'warning' ELSE 'pass' END FROM issue_counts
        UNION ALL
        SELECT 'high_issue_count', CAST(high_issue_count AS DOUBLE), NULL::DOUBLE,
               CASE WHEN high_issue_count > 0 THEN 'failure' ELSE 'pass' END FROM issue_counts
        UNION ALL
        SELECT 'max_unresolved_adj_factor_jump', CAST(unresolved_adj_factor_jump_count AS DOUBLE), CAST(100 AS DOUBLE),
               CASE WHEN unresolved_adj_factor_jump_count > 100 THEN 'failure' ELSE 'pass' END FROM issue_counts
        UNION ALL
        SELECT 'max_missing_limit', CAST(missing_limit_count AS DOUBLE), CAST(1000 AS DOUBLE),
               CASE WHEN missing_limit_count > 1000 THEN 'failure' ELSE 'pass' END FROM issue_counts""",
    "jump_totals": """
        SELECT explained_rows + unresolved_rows AS total_rows, explained_rows, unresolved_rows
        FROM (SELECT count_if(has_explaining_corporate_action)::BIGINT AS explained_rows,
                     count_if(NOT has_explaining_corporate_action)::BIGINT AS unresolved_rows FROM jump_facts)""",
    "jump_years": f"""
        SELECT strftime(trade_date, '%Y') AS year, count(*) AS rows, count(DISTINCT security_id) AS securities,
               {K('min(trade_date)')} AS earliest_date, {K('max(trade_date)')} AS latest_date
        FROM q_unresolved GROUP BY 1""",
    "magnitude_summary": """
        SELECT bucket, count(*) AS rows, count(DISTINCT security_id) AS securities, CAST(any_value(place) AS BIGINT) AS bucket_order
        FROM q_unresolved JOIN size_bands USING (bucket) GROUP BY 1""",
    "top_securities": f"""
        SELECT security_id, count(*) AS rows, {K('min(trade_date)')} AS earliest_date, {K('max(trade_date)')} AS latest_date,
               min(factor_ratio) AS min_factor_ratio, max(factor_ratio) AS max_factor_ratio
        FROM q_unresolved GROUP BY 1 ORDER BY rows DESC, security_id LIMIT 30""",
    "dividend_proximity": f"""
        SELECT dividend_proximity_bucket AS bucket, count(*) AS rows, count(DISTINCT security_id) AS securities,
               {place_in(PROXIMITY, 'dividend_proximity_bucket')} AS bucket_order
        FROM q_ctx GROUP BY 1""",
    "triage_summary": f"""
        SELECT triage_class, count(*) AS rows, count(DISTINCT security_id) AS securities,
               {place_in(TRIAGE_ORDER, 'triage_class')} AS triage_order
        FROM q_ctx GROUP BY 1""",
    "triage_no_dividend": f"""
        SELECT triage_class, count(*) AS rows, count(DISTINCT security_id) AS securities,
               {place_in(TRIAGE_ORDER, 'triage_class')} AS triage_order
        FROM (SELECT security_id, {first_that_holds([*TRIAGE[2:4], 'raw_dividend_missing'], ['factor_pre_close_basis_diff <= CAST(0.001 AS DOUBLE)', "severity = 'low'"])} AS triage_class
              FROM q_unresolved)
        GROUP BY 1""",
    "nearest_dividend_row": f"""
        SELECT security_id, {K('trade_date')} AS trade_date,
               {K('nearest_implemented_dividend_ex_date')} AS nearest_implemented_dividend_ex_date,
               nearest_days AS nearest_implemented_dividend_days
        FROM q_ctx""",
    "jump_examples": f"""
        SELECT security_id, {K('previous_trade_date')} AS previous_trade_date, {K('trade_date')} AS trade_date, factor_ratio,
               bucket AS magnitude_bucket, dividend_proximity_bucket,
               {K('nearest_implemented_dividend_ex_date')} AS nearest_implemented_dividend_ex_date,
               nearest_days AS nearest_implemented_dividend_days, has_suspend_window,
               round(factor_pre_close_basis_diff, 12) AS factor_pre_close_basis_diff, triage_class,
               'quarantine_security_window_from_promotion' AS recommended_action
        FROM (FROM q_ctx ORDER BY abs_factor_change DESC, security_id, q_ctx.trade_date LIMIT 500)""",
    "bad_dates": f"""
        SELECT DISTINCT {K('trade_date')} AS trade_date, issue_type, issue_severity FROM flags
        WHERE issue_type = 'INCOMPLETE_TRADING_DATE'""",
    "bad_symbols": """
        SELECT DISTINCT code, issue_type, issue_severity FROM flags
        WHERE issue_type IN ('MISSING_LIMIT', 'UNRESOLVED_ADJ_FACTOR_JUMP', 'MISSING_INDUSTRY_CODE')""",
    "execution_restricted": f"SELECT * REPLACE ({_D3}) FROM flags WHERE execution_restricted",
})

from .pipeline_sql import CLEAN, PD  # noqa: E402

_KL = "ts_code, trade_date, open, high, low, close, pre_close, change, pct_chg, vol, amount, source_table"

QUERIES.update({
    "upsert_replace": f"""
        SELECT {_KL} FROM raw_kline_unadj t
        WHERE NOT EXISTS (SELECT 1 FROM feed_a_norm b WHERE b.ts_code = t.ts_code AND b.trade_date = t.trade_date)
        UNION ALL SELECT {_KL} FROM feed_a_norm""",
    "append_dedup": """
        SELECT DISTINCT * FROM (
            SELECT ts_code, trade_date, up_limit, down_limit FROM raw_stk_limit
            UNION ALL SELECT ts_code, trade_date, up_limit, down_limit FROM sup_raw_stk_limit)""",
    "incremental_filter": f"""
        SELECT ts_code, trade_date FROM raw_daily_basic
        WHERE {PD('trade_date')} >= (SELECT greatest(max({PD('trade_date')}) + 1, DATE '1999-06-01')
                                     FROM raw_daily_basic WHERE trade_date < '20000101')""",
    "feed_a_normalize": "SELECT * FROM feed_a_norm",
    "feed_b_normalize": "SELECT * FROM feed_b_norm",
    "conform_fill": """
        SELECT ts_code, trade_date, NULL::DOUBLE AS open, NULL::DOUBLE AS high, NULL::DOUBLE AS low, close,
               NULL::DOUBLE AS pre_close, NULL::DOUBLE AS change, NULL::DOUBLE AS pct_chg, NULL::DOUBLE AS vol,
               NULL::DOUBLE AS amount, 'provider.thin' AS source_table
        FROM raw_kline_qfq""",
    "event_normalize": f"""
        SELECT {CLEAN('ts_code')} AS ts_code,
               NULLIF({CLEAN("CASE WHEN trade_date IS NOT NULL AND trade_date <> '' THEN trade_date ELSE suspend_date END")}, '') AS trade_date,
               {CLEAN('suspend_timing')} AS suspend_timing,
               {CLEAN("CASE WHEN suspend_type IS NOT NULL AND suspend_type <> '' THEN suspend_type ELSE reason_type END")} AS suspend_type,
               'provider.suspend_d' AS source_table
        FROM provider_suspend_d""",
    "index_ingest": """
        SELECT DISTINCT ts_code, trade_date, close, open, high, low, pre_close, change, pct_chg, vol, amount
        FROM raw_index_daily WHERE ts_code <> '' AND trade_date IS NOT NULL AND close IS NOT NULL""",
    "index_basic_latest": "SELECT ts_code, upper(name) AS name, market, publisher, category, base_date, base_point, list_date FROM index_basic_ref",
    "weight_ingest": f"""
        SELECT DISTINCT benchmark_id, {CLEAN('security_id')} AS security_id, NULLIF({CLEAN('trade_date')}, '') AS trade_date,
               CAST(weight AS DOUBLE) AS weight
        FROM benchmark_weight_snapshot_pit
        WHERE NULLIF({CLEAN('trade_date')}, '') IS NOT NULL AND {CLEAN('security_id')} <> '' AND weight IS NOT NULL""",
    "membership_intervals": f"""
        SELECT benchmark_id, security_id, {K('effective_at')} AS effective_at, {K('removed_at')} AS removed_at FROM membership""",
    "close_intervals": f"""
        SELECT security_id, industry_schema, industry_code, {K('effective_at')} AS effective_at,
               {K("least(removed_at, lead(effective_at) OVER (PARTITION BY security_id, industry_schema ORDER BY effective_at, industry_code))")} AS removed_at
        FROM industry_pit""",
    "industry_unpivot": f"""
        SELECT security_id, industry_schema, industry_code, {K('effective_at')} AS effective_at,
               {K("least(removed_at, lead(effective_at) OVER (PARTITION BY security_id, industry_schema ORDER BY effective_at, industry_code))")} AS removed_at
        FROM member_long""",
    "staging_registry": f"""
        SELECT * FROM (
            SELECT 'industry_classification_pit' AS dataset_id, 'pit_reference_staging' AS boundary_role, 'green' AS status,
                   count(*) AS row_count, {K('min(effective_at)')} AS earliest_date,
                   {K('max(COALESCE(removed_at, effective_at))')} AS latest_date FROM industry_pit
            UNION ALL SELECT 'benchmark_membership_pit', 'pit_reference_staging', 'green', count(*), {K('min(effective_at)')},
                   {K('max(COALESCE(removed_at, effective_at))')} FROM membership
            UNION ALL SELECT 'benchmark_weight_snapshot_pit', 'pit_reference_staging', 'green', count(*), {K('min(trade_date)')},
                   {K('max(trade_date)')} FROM weights_pit
            UNION ALL SELECT 'index_basic_ref', 'pit_reference_staging', 'green', count(*), {K(f"min({PD('list_date')})")},
                   {K(f"max({PD('list_date')})")} FROM index_basic_ref
            UNION ALL SELECT 'raw_index_daily', 'pit_reference_staging', 'green', count(*), {K('min(trade_date)')},
                   {K('max(trade_date)')} FROM index_daily_pit
            UNION ALL SELECT 'raw_dividend', 'pit_reference_staging', 'green', count(*), {K('min(COALESCE(ex_date, ann_date))')},
                   {K('max(COALESCE(ex_date, ann_date))')} FROM dividend
            UNION ALL SELECT 'raw_stk_limit', 'pit_reference_staging', 'green', count(*), {K('min(trade_date)')},
                   {K('max(trade_date)')} FROM limits_merged
            UNION ALL SELECT 'raw_suspend_d', 'pit_reference_staging', 'green', count(*), {K('min(trade_date)')},
                   {K('max(trade_date)')} FROM suspend
            UNION ALL SELECT 'raw_share_float', 'pit_reference_staging', 'green', count(*), min(end_date), max(end_date) FROM raw_income
            UNION ALL SELECT 'raw_repurchase', 'pit_reference_staging', 'green', count(*), min(end_date), max(end_date) FROM raw_forecast)
        WHERE row_count > 0""",
    "raw_audit": "SELECT * FROM audit_checks",
    "rows_per_year": "SELECT * FROM rows_per_year",
    "calendar_coverage": "SELECT * FROM calendar_check",
    "dataset_registry": f"""
        SELECT 'daily_bar_pit' AS dataset_id, 'green' AS status, count(*) AS row_count, {K('min(trade_date)')} AS earliest_date,
               {K('max(trade_date)')} AS latest_date FROM daily_bar_pit
        UNION ALL SELECT 'fundamental_snapshot_pit', 'amber', count(*), {K('min(announcement_date)')}, {K('max(announcement_date)')}
            FROM fundamental_snapshot_pit
        UNION ALL SELECT 'industry_classification_static', 'amber', count(*), NULL, NULL
            FROM stock_basic_ref WHERE split_part(ts_code, '.', 2) IN ('SZ', 'SH', 'BJ')
        UNION ALL SELECT 'market_trade_calendar', 'green', count(*), {K('min(trade_date)')}, {K('max(trade_date)')} FROM market_trade_calendar
        UNION ALL SELECT 'name_change_history', 'green', count(*), {K('min(COALESCE(start_date, announcement_date))')},
            {K('max(COALESCE(end_date, announcement_date))')} FROM name_change_history
        UNION ALL SELECT 'security_master_ref', 'green', count(*), {K('min(list_date)')}, {K('max(COALESCE(delist_date, list_date))')}
            FROM security_master_ref
        UNION ALL SELECT 'corporate_action_ledger', 'green', count(*), {K('min(book_date)')}, {K('max(book_date)')} FROM ledger
        UNION ALL SELECT 'corporate_action_exception_ledger', CASE WHEN count(*) = 0 THEN 'green' ELSE 'amber' END, count(*),
            {K('min(trade_date)')}, {K('max(trade_date)')} FROM exception_ledger
        UNION ALL SELECT 'tradeability_state_daily', 'green', count(*), {K('min(trade_date)')}, {K('max(trade_date)')}
            FROM tradeability_state_daily
        UNION ALL SELECT 'benchmark_weight_snapshot_pit', 'green', count(*), {K('min(trade_date)')}, {K('max(trade_date)')} FROM weights_pit
        UNION ALL SELECT 'industry_classification_pit', 'green', count(*), {K('min(effective_at)')},
            {K('max(COALESCE(removed_at, effective_at))')} FROM industry_pit
        UNION ALL SELECT 'index_basic_ref', 'green', count(*), {K(f"min({PD('list_date')})")}, {K(f"max({PD('list_date')})")} FROM index_basic_ref
        UNION ALL SELECT 'index_daily_bar_pit', 'green', count(*), {K('min(trade_date)')}, {K('max(trade_date)')} FROM index_daily_pit""",
})

_FLOAT = """ts_code, NULLIF(ann_date, '') AS ann_date, end_date AS float_date, sq AS float_share, CASE WHEN nd % 2 = 1 THEN nd / 100::DOUBLE END AS float_ratio,
               'Holder' AS holder_name, CASE WHEN nd % 2 = 1 THEN 'common' ELSE '' END AS share_type, 'provider.share_float' AS source_table"""
_BACK = """ts_code, NULLIF(ann_date, '') AS ann_date, end_date, 'done' AS proc, NULL::VARCHAR AS exp_date, sq AS vol, mh AS amount, mh AS high_limit,
               NULL::DOUBLE AS low_limit, 'provider.repurchase' AS source_table"""
QUERIES.update({
    "dividend_normalize": """
        SELECT ts_code, end_date, ann_date, coalesce(div_proc, '') AS div_proc, stk_div, NULLIF(stk_bo_rate, 0) AS stk_bo_rate, stk_co_rate, cash_div,
               cash_div_tax, record_date, ex_date, NULLIF(pay_date, '') AS pay_date, NULL::VARCHAR AS div_listdate, 'provider.dividend' AS source_table
        FROM raw_dividend""",
    "limit_normalize": "SELECT ts_code, trade_date, up_limit, down_limit, 'provider.stk_limit' AS source_table FROM raw_stk_limit",
    "share_float_normalize": f"SELECT {_FLOAT} FROM g_quarters",
    "repurchase_normalize": f"SELECT {_BACK} FROM g_quarters WHERE end_date[5:8] = '1231'",
    "share_float_events": f"SELECT *, '2024-01-02 02:00:00' AS ingested_at FROM (SELECT {_FLOAT} FROM g_quarters)",
    "repurchase_events": f"SELECT *, '2024-01-02 02:00:00' AS ingested_at FROM (SELECT {_BACK} FROM g_quarters WHERE end_date[5:8] = '1231')",
})
# Notes of the registry.
NOTES = {
    "daily_bar_pit": "one bar a security and day; unadjusted prices first, adjusted ones marked by their source",
    "fundamental_snapshot_pit": "usable from the first trading day after the announcement",
    "industry_classification_static": "present industry only, without history",
    "market_trade_calendar": "days on which any listed security has a basic row",
    "name_change_history": "source of the special-treatment windows",
    "security_master_ref": "listed securities with their board",
    "corporate_action_ledger": "implemented dividends and inferred factor repairs",
    "corporate_action_exception_ledger": "factor jumps that no booking explains; rows keep a security window from promotion",
    "tradeability_state_daily": "suspensions and limit locks with their source",
    "benchmark_weight_snapshot_pit": "benchmark weights as delivered",
    "industry_classification_pit": "industry intervals by schema",
    "index_basic_ref": "index names and base values",
    "index_daily_bar_pit": "index bars",
}
QUERIES["dataset_registry"] = f"""
    SELECT dataset_id, status, row_count, earliest_date, latest_date, note FROM ({QUERIES['dataset_registry']})
    JOIN (VALUES {", ".join(f"('{n}', '{t}')" for n, t in NOTES.items())}) notes(dataset_id, note) USING (dataset_id)"""


def _section(name: str, key: str, place: str, top: str = "") -> str:
    """Breakdown of the unresolved jumps by a class, numbered by its place."""
    return f"""
        SELECT '{name}' AS section, row_number() OVER (ORDER BY place, key) AS position, key, NULL::VARCHAR AS text, NULL::DOUBLE AS number, rows, securities,
               {K('earliest_date')} AS earliest_date, {K('latest_date')} AS latest_date
        FROM (SELECT {key} AS key, {place} AS place, count(*) AS rows, count(DISTINCT security_id) AS securities, min(trade_date) AS earliest_date,
                     max(trade_date) AS latest_date FROM q_ctx GROUP BY key) {top}"""


_NO_JUMP = "NULL::BIGINT AS rows, NULL::BIGINT AS securities, NULL::VARCHAR AS earliest_date, NULL::VARCHAR AS latest_date"
_SUMMARY = """
            SELECT metric AS key, value::DOUBLE AS number FROM quality_scalars
            UNION ALL SELECT key, n::DOUBLE FROM (UNPIVOT issue_counts ON COLUMNS(*) INTO NAME key VALUE n)
            UNION ALL SELECT 'official_ratio', official_ratio FROM source_ratios
            UNION ALL SELECT 'fallback_ratio', fallback_ratio FROM source_ratios
            UNION ALL SELECT 'adj_factor_jump_rows', count(*) FROM jump_facts
            UNION ALL SELECT 'explained_adj_factor_jump_rows', count(*) FROM jump_facts WHERE has_explaining_corporate_action
            UNION ALL SELECT 'unresolved_adj_factor_jump_rows', count(*) FROM q_unresolved"""


def _said(section: str, position: int, key: str, test: str, tail: str = "''") -> str:
    return f"""
        SELECT '{section}' AS section, {position}::BIGINT AS position, key, key || '=' || number::BIGINT || {tail} AS text, NULL::DOUBLE AS number, {_NO_JUMP}
        FROM ({_SUMMARY}) WHERE key = '{key}' AND number {test}"""


QUERIES["quality_report"] = " UNION ALL ".join([
    _section("years", "strftime(trade_date, '%Y')", "0"),
    _section("magnitude_buckets", "bucket", "(SELECT any_value(b.place) FROM size_bands b WHERE b.bucket = q_ctx.bucket)"),
    _section("dividend_proximity", "dividend_proximity_bucket", place_in(PROXIMITY, "dividend_proximity_bucket")),
    _section("triage", "triage_class", place_in(TRIAGE_ORDER, "triage_class")),
    _section("top_securities", "security_id", "0").replace("(ORDER BY place, key)", "(ORDER BY rows DESC, key)") + " QUALIFY position <= 30",
    f"""
        SELECT 'summary' AS section, row_number() OVER (ORDER BY key) AS position, key, NULL::VARCHAR AS text, number, {_NO_JUMP} FROM ({_SUMMARY})""",
    f"""
        SELECT 'state' AS section, 1::BIGINT AS position, 'adj_factor_jump_assessable' AS key, 'true' AS text, NULL::DOUBLE AS number, {_NO_JUMP}""",
    f"""
        SELECT 'state' AS section, 2::BIGINT AS position, 'promotion_blocking_quality_state' AS key,
               CASE WHEN count(*) > 0 THEN 'blocked_unresolved_adj_factor_jumps' ELSE 'pass' END AS text, NULL::DOUBLE AS number, {_NO_JUMP} FROM q_unresolved""",
    f"""
        SELECT 'failures' AS section, 1::BIGINT AS position, 'official_ratio' AS key, format('official_ratio {{:.6f}} below min_official_ratio 0.500000', official_ratio) AS text,
               NULL::DOUBLE AS number, {_NO_JUMP} FROM source_ratios WHERE official_ratio < 0.5""",
    _said("warnings", 2, "tradeability_missing_limit_rows", "> 0"),
    _said("warnings", 3, "incomplete_trading_date_count", "> 0"),
    _said("failures", 4, "high_issue_count", "> 0"),
    _said("failures", 5, "unresolved_adj_factor_jump_count", "> 100", "' exceeds 100'"),
    _said("failures", 6, "missing_limit_count", "> 1000", "' exceeds 1000'"),
])
QUERIES["membership_incremental"] = QUERIES["membership_intervals"]
QUERIES["stream_upsert"] = QUERIES["upsert_replace"]

_BAR = "ts_code, trade_date, open, high, low, close, pre_close, change, pct_chg, vol, amount, source_table"
QUERIES.update({
    "stream_deliveries": f"""
        SELECT {_BAR} FROM (
            SELECT {_BAR}, 0 AS delivery FROM raw_kline_unadj
            UNION ALL SELECT {_BAR}, 1 FROM feed_a_norm
            UNION ALL SELECT * REPLACE (vol * 100 AS vol), 2 FROM (SELECT {_BAR} FROM feed_a_norm) WHERE trade_date[7:8]::INT <= 10
            UNION ALL SELECT * REPLACE (NULL AS change, NULL AS pct_chg), 3 FROM (SELECT {_BAR} FROM feed_a_norm)
                WHERE trade_date[7:8]::INT BETWEEN 8 AND 12)
        QUALIFY delivery = max(delivery) OVER (PARTITION BY ts_code, trade_date)""",
    "incremental_files": f"""
        SELECT {_BAR} FROM raw_kline_unadj
        WHERE {PD('trade_date')} > (SELECT greatest(max({PD('trade_date')}), DATE '1999-05-31') FROM raw_kline_unadj WHERE trade_date < '20000101')""",
    "table_versions": f"""
        SELECT version::BIGINT AS version, step, count(trade_date) AS rows, coalesce(count_if(source_table = 'feed_a.daily'), 0)::BIGINT AS corrected,
               min(trade_date) AS first_date, max(trade_date) AS last_date
        FROM (VALUES (1, 'replace', 'old'), (2, 'upsert', 'upserted'), (3, 'replay', 'upserted'), (4, 'reset', ''), (5, 'append', 'appended')) held(version, step, rowset)
        LEFT JOIN (
            SELECT 'old' AS rowset, trade_date, source_table FROM raw_kline_unadj
            UNION ALL SELECT 'upserted', trade_date, source_table FROM feed_a_norm WHERE trade_date[5:6] = '03'
            UNION ALL SELECT 'upserted', trade_date, source_table FROM raw_kline_unadj
                ANTI JOIN (SELECT ts_code, trade_date FROM feed_a_norm WHERE trade_date[5:6] = '03') USING (ts_code, trade_date)
            UNION ALL SELECT 'appended', trade_date, source_table FROM (
                SELECT {_BAR} FROM raw_kline_unadj UNION SELECT {_BAR} FROM feed_a_norm WHERE trade_date[5:6] = '03')
        ) USING (rowset) GROUP BY ALL""",
})

from .pipeline_sql import CUT_TS  # noqa: E402,F401

_T = "strftime({0}, '%Y-%m-%d %H:%M:%S')"
QUERIES.update({
    "hierarchy_levels": "SELECT code, level, level_code FROM oi_hier_all",
    "crosswalk_map": "SELECT code, level, level_code FROM oi_cross",
    "cutover_anchors": f"""
        SELECT security_id, {_T.format('effective_at')} AS effective_at, raw_code, {_T.format('updated_at')} AS updated_at
        FROM oi_anchors""",
    "empirical_map": "SELECT code, level, level_code FROM oi_emp",
    "official_industry_rows": f"""
        SELECT security_id, industry_schema, industry_code, {_T.format('effective_at')} AS effective_at,
               {_T.format('removed_at')} AS removed_at
        FROM oi_official""",
    "official_import_counters": f"""
        SELECT 'quarantined_placeholder_rows' AS counter, '' AS level,
               count(*) FILTER (WHERE {'strftime(effective_at, %s)' % "'%Y%m%d'"} = '19900101') AS value FROM oi_all
        UNION ALL
        SELECT 'quarantined_pre_window_rows', '', count(*) FILTER (WHERE strftime(effective_at, '%Y%m%d') <> '19900101'
               AND strftime(effective_at, '%Y%m%d') < '19960221') FROM oi_all
        UNION ALL
        SELECT g.counter, g.level, count(h.level) FROM (SELECT c AS counter, l AS level FROM (VALUES ('quarantined_unresolved_rows'),
               ('window_carry_forward_rows'), ('snapshot_backfill_rows')) a(c), (VALUES ('L1'), ('L2'), ('L3')) b(l)) g
        LEFT JOIN (SELECT 'quarantined_unresolved_rows' AS counter, level FROM oi_base WHERE level_code = ''
                   UNION ALL SELECT 'window_carry_forward_rows', level FROM oi_carry
                   UNION ALL SELECT 'snapshot_backfill_rows', level FROM oi_backfill) h ON h.counter = g.counter AND h.level = g.level
        GROUP BY g.counter, g.level""",
    "contract_check": """
        SELECT v."check", v.status, v.detail, n.rows_checked
        FROM (VALUES ('table:stock_bar_normalized_daily', 'pass', 'present'), ('table:daily_bar_pit', 'pass', 'present'),
                     ('table:tradeability_state_daily', 'pass', 'present'), ('columns', 'pass', 'ordered')) v("check", status, detail)
        CROSS JOIN (SELECT count(*) AS rows_checked FROM normalized) n""",
    "manual_adjudication": f"""
        SELECT security_id, industry_schema, industry_code, {_T.format('effective_at')} AS effective_at,
               {_T.format("least(removed_at, lead(effective_at) OVER (PARTITION BY security_id, industry_schema ORDER BY effective_at, industry_code))")} AS removed_at
        FROM (SELECT DISTINCT * FROM (
                SELECT security_id, industry_schema, industry_code, effective_at, removed_at FROM oi_official
                UNION ALL SELECT security_id, industry_schema, industry_code, start_date, end_date FROM oi_applied))""",
})

QUERIES["export_normalized_csv"] = QUERIES["normalized_bars"]
# Registered datasets: table, kind of axis, its column.
DATASETS = {
    "stock_basic": ("stock_basic_ref", "static", None), "trade_cal": ("raw_trade_cal", "trade_date", "cal_date"),
    "namechange": ("raw_namechange", "static", None), "index_member_all": ("raw_index_member_all", "static", None),
    "fina_indicator": ("pit_fina_indicator", "period_end", "end_date"),
    **{n: (t, "trade_date", "trade_date") for n, t in {
        "daily": "raw_kline_unadj", "daily_basic": "raw_daily_basic", "adj_factor": "raw_adj_factor", "daily_qfq": "raw_kline_qfq",
        "suspend_d": "raw_suspend_d", "stk_limit": "raw_stk_limit", "index_daily": "raw_index_daily", "index_weight": "raw_index_weight"}.items()},
    **{n: (f"raw_{n}", "period_end", "end_date") for n in ("income", "balancesheet", "cashflow", "forecast", "express")},
}
QUERIES["high_water_mark"] = " UNION ALL ".join(
    f"SELECT '{n}' AS dataset_id, '{axis}' AS axis, {f'max({c})' if c else 'any_value(NULL::VARCHAR)'} AS last_date FROM {t}" for n, (t, axis, c) in DATASETS.items())
QUERIES["sync_state"] = " UNION ALL ".join(
    f"SELECT '{n}' AS dataset_id, 'ok' AS status, {f'min({c})' if c else 'any_value(NULL::VARCHAR)'} AS start_date, {f'max({c})' if c else 'any_value(NULL::VARCHAR)'} AS last_date, "
    f"count(*) AS row_count, any_value(NULL::VARCHAR) AS error FROM {t}" for n, (t, _, c) in DATASETS.items() if n != "express") + """
    UNION ALL SELECT 'express', 'error', NULL, NULL, NULL, 'express: the delivery lacks the key column end_date'"""

