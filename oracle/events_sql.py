"""DuckDB CTEs for corporate actions, factor jumps and quality flags.

Everything known about a jump is gathered once, in ``jump_facts``: the nearest event days before and after it come from
ASOF joins over distinct event days, and the classes from rule tables (first rule that holds, or the band a size falls in).
"""

from __future__ import annotations

# Class names, issue texts and thresholds that results must carry.
DONE = "实施"
TRIAGE = ["nonimplemented_dividend_same_date", "implemented_dividend_outside_factor_window",
          "daily_pre_close_ex_right_without_ledger", "low_materiality_provider_factor_noise",
          "provider_factor_jump_without_event_evidence"]
TRIAGE_ORDER = [TRIAGE[1], TRIAGE[0], *TRIAGE[2:]]
PROXIMITY = ["same_date_implemented", "same_date_nonimplemented_only", "implemented_within_5d", "implemented_within_30d",
             "no_implemented_within_30d"]
BANDS = [("0.005", "<=50bp", "low"), ("0.02", "<=2pct", "medium"), ("0.10", "<=10pct", "high"), ("'inf'", ">10pct", "critical")]
ISSUES = {  # severity, then usable for: vpa, ml feature, ml label, backtest; then execution restricted
    "MISSING_LIMIT": ("MEDIUM", True, True, True, False, True),
    "MISSING_INDUSTRY_CODE": ("LOW", True, True, True, True, False),
    "INCOMPLETE_TRADING_DATE": ("HIGH", False, False, False, False, True),
    "UNRESOLVED_ADJ_FACTOR_JUMP": ("HIGH", False, False, False, False, True),
}
MISSING_LIMIT_DETAIL = "up_limit or down_limit is missing; execution checks must be conservative"
MISSING_INDUSTRY_DETAIL = ("industry_code is missing and standardized to UNKNOWN; industry attribution and portfolio "
                           "constraints should handle UNKNOWN explicitly")


def day_text(x: str) -> str:
    return f"strftime({x}, '%Y%m%d')"


def texts(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def first_that_holds(names: list[str], tests: list[str]) -> str:
    """The name of the first test that is true; the last name stands for none."""
    return f"({texts(names)})[list_position([{', '.join(f'coalesce({t}, FALSE)' for t in tests)}, TRUE], TRUE)]"


def place_in(names: list[str], x: str) -> str:
    return f"CAST(coalesce(list_position({texts(names)}, {x}), {len(names) + 1}) AS BIGINT)"


def after(days: str, alias: str) -> str:
    """ASOF join: the latest of ``days`` on or before the jump."""
    return f"ASOF LEFT JOIN {days} {alias} ON {alias}.security_id = j.security_id AND j.trade_date >= {alias}.day"


def before(days: str, alias: str) -> str:
    return f"ASOF LEFT JOIN {days} {alias} ON {alias}.security_id = j.security_id AND j.trade_date <= {alias}.day"


IN_JUMP = "coalesce({}.day > j.previous_trade_date, FALSE)"
_ISSUE_ROWS = ", ".join(f"('{name}', '{sev}', {', '.join(map(str, marks))})" for name, (sev, *marks) in ISSUES.items())

CTES: list[tuple[str, str]] = [
    ("dividend_days", f"""
        SELECT ts_code AS security_id, ex_date AS day, bool_or(coalesce(div_proc = '{DONE}', FALSE)) AS any_done,
               bool_or(coalesce(div_proc <> '{DONE}', FALSE)) AS any_open, bool_or(div_proc IS NULL) AS any_blank
        FROM dividend WHERE ts_code IS NOT NULL AND ex_date IS NOT NULL GROUP BY ALL"""),
    ("done_days", "SELECT security_id, day FROM dividend_days WHERE any_done"),
    ("halt_days", "SELECT DISTINCT ts_code AS security_id, trade_date AS day FROM suspend WHERE trade_date IS NOT NULL"),
    ("size_bands", "SELECT * FROM (VALUES " + ", ".join(f"(CAST({m} AS DOUBLE), '{b}', '{s}', {k})" for k, (m, b, s) in enumerate(BANDS, 1))
                   + ") AS t(most, bucket, severity, place)"),
    ("action_rows", f"""
        SELECT format('{{}}:{{}}:{{}}:{{}}', d.ts_code, coalesce({day_text('d.end_date')}, ''), {day_text('d.ex_date')}, leg.tag) AS action_id,
               d.ts_code AS security_id, leg.tag || '_dividend' AS action_type, d.record_date, leg.booked AS book_date, d.ex_date,
               leg.cash AS cash_per_share, leg.share AS share_ratio, d.source_table
        FROM (SELECT *, unnest([
                  {{'tag': 'cash', 'booked': coalesce(pay_date, ex_date), 'share': 0::DOUBLE,
                    'cash': coalesce(cash_div_tax, cash_div, 0::DOUBLE)}},
                  {{'tag': 'share', 'booked': ex_date, 'cash': 0::DOUBLE,
                    'share': list_reduce(list_transform([stk_div, stk_bo_rate, stk_co_rate], lambda x: coalesce(x, 0::DOUBLE)), lambda x, y: x + y)}}
              ]) AS leg FROM dividend WHERE div_proc = '{DONE}' AND ex_date IS NOT NULL) d
        WHERE greatest(leg.cash, leg.share) > 0"""),
    ("action_days", "SELECT DISTINCT security_id, unnest([ex_date, book_date]) AS day FROM action_rows"),
    ("factor_places", """
        SELECT security_id, trade_date, close, pre_close, adj_factor,
               row_number() OVER (PARTITION BY security_id ORDER BY trade_date) AS place
        FROM daily_bar_pit WHERE adj_factor > 0 AND price_basis IS DISTINCT FROM 'qfq_fallback'"""),
    ("sig_jumps", """
        SELECT * FROM (
            SELECT b.security_id, a.trade_date AS previous_trade_date, b.trade_date, a.close AS previous_close, b.pre_close,
                   a.adj_factor AS previous_adj_factor, b.adj_factor AS current_adj_factor,
                   b.adj_factor / a.adj_factor AS factor_ratio, abs(b.adj_factor / a.adj_factor - 1) AS abs_factor_change,
                   CASE WHEN b.pre_close <> 0 THEN a.close / b.pre_close END AS pre_close_factor_ratio
            FROM factor_places a JOIN factor_places b ON a.security_id = b.security_id AND a.place = b.place - 1)
        WHERE abs_factor_change > CAST(0.001 AS DOUBLE)"""),
    ("jump_evidence", f"""
        SELECT j.*,
               CASE WHEN j.pre_close_factor_ratio <> 0 THEN abs(j.factor_ratio / j.pre_close_factor_ratio - 1) END AS factor_pre_close_basis_diff,
               p.day AS done_before, n.day AS done_after,
               list_min([j.trade_date - p.day, n.day - j.trade_date]) AS nearest_days,
               coalesce(o.any_done, FALSE) AS done_same, coalesce(o.any_open, FALSE) AS open_same,
               coalesce(o.any_open OR o.any_blank, FALSE) AS undone_same,
               {IN_JUMP.format('h')} AS has_suspend_window, {IN_JUMP.format('x')} AS has_action
        FROM sig_jumps j
        {after('done_days', 'p')} {before('done_days', 'n')} {after('halt_days', 'h')} {after('action_days', 'x')}
        LEFT JOIN dividend_days o ON o.security_id = j.security_id AND o.day = j.trade_date"""),
    ("unres_vs_actions", "SELECT * FROM jump_evidence WHERE NOT has_action"),
    ("inferred_repairs", f"""
        SELECT security_id || ':' || {day_text('trade_date')} || ':' || kind AS action_id, security_id, kind AS action_type,
               previous_trade_date AS record_date, trade_date AS book_date, trade_date AS ex_date,
               0::DOUBLE AS cash_per_share, 0::DOUBLE AS share_ratio, 'derived.adj_factor_reconciliation' AS source_table
        FROM (SELECT *, 'inferred_adj_factor_repair' AS kind,
                     CASE WHEN factor_pre_close_basis_diff <= CAST(0.001 AS DOUBLE) THEN 90 ELSE 30 END AS reach FROM unres_vs_actions)
        WHERE open_same OR (nearest_days > 0 AND nearest_days <= reach)"""),
    ("ledger", "FROM action_rows UNION ALL FROM inferred_repairs"),
    ("ledger_days", "SELECT DISTINCT security_id, unnest([ex_date, book_date]) AS day FROM ledger"),
    ("jump_facts", f"""
        SELECT j.*, {IN_JUMP.format('x')} AS has_explaining_corporate_action, s.bucket, s.severity
        FROM jump_evidence j {after('ledger_days', 'x')} ASOF JOIN size_bands s ON j.abs_factor_change <= s.most"""),
    ("exception_ledger", f"""
        SELECT concat_ws(':', security_id, {day_text('previous_trade_date')}, {day_text('trade_date')}, 'adj_factor_exception') AS exception_id,
               security_id, previous_trade_date, trade_date, previous_adj_factor, current_adj_factor, factor_ratio,
               abs_factor_change, previous_close, pre_close, pre_close_factor_ratio, factor_pre_close_basis_diff,
               bucket AS magnitude_bucket, severity, has_suspend_window,
               {first_that_holds(TRIAGE, ['open_same', 'nearest_days BETWEEN 1 AND 30', 'factor_pre_close_basis_diff <= CAST(0.001 AS DOUBLE)', "severity = 'low'"])} AS triage_class,
               'quarantine_security_window_from_promotion' AS recommended_action,
               'derived.adj_factor_reconciliation' AS source_table
        FROM jump_facts WHERE NOT has_explaining_corporate_action"""),
    ("security_days", "SELECT security_id, list_sort(list(DISTINCT trade_date)) AS days FROM daily_bar_pit GROUP BY 1"),
    ("affected", """
        SELECT code, trade_date, previous_trade_date, factor_ratio, triage_class,
               days[greatest(spot - 60, 1)] AS affected_start, days[least(spot + 10, len(days))] AS affected_end
        FROM (SELECT DISTINCT e.security_id AS code, e.trade_date, e.previous_trade_date, e.factor_ratio, e.triage_class,
                     d.days, list_position(d.days, e.trade_date) AS spot
              FROM exception_ledger e JOIN security_days d USING (security_id))"""),
    ("day_sizes", """
        SELECT *, row_number() OVER (ORDER BY trade_date) AS place
        FROM (SELECT trade_date, count(*) AS row_count FROM normalized GROUP BY 1)"""),
    ("date_counts", """
        SELECT m.trade_date, m.row_count, l.row_count AS previous_row_count, r.row_count AS next_row_count
        FROM day_sizes m LEFT JOIN day_sizes l ON l.place + 1 = m.place LEFT JOIN day_sizes r ON r.place - 1 = m.place"""),
    ("incomplete_dates", """
        SELECT * FROM date_counts
        WHERE 2 * row_count < previous_row_count AND 2 * row_count < next_row_count"""),
    ("issue_kinds", f"""
        SELECT * FROM (VALUES {_ISSUE_ROWS}) AS t(issue_type, issue_severity, usable_for_vpa, usable_for_ml_feature,
                                                  usable_for_ml_label, usable_for_backtest, execution_restricted)"""),
    ("issue_hits", f"""
        SELECT 'MISSING_LIMIT' AS issue_type, security_id AS code, trade_date, trade_date AS affected_start,
               trade_date AS affected_end, '{MISSING_LIMIT_DETAIL}' AS issue_detail
        FROM tradeability_state_daily WHERE up_limit + down_limit IS NULL
        UNION ALL BY NAME
        SELECT 'MISSING_INDUSTRY_CODE' AS issue_type, code, trade_date, trade_date AS affected_start,
               trade_date AS affected_end, '{MISSING_INDUSTRY_DETAIL}' AS issue_detail
        FROM normalized WHERE coalesce(industry_code, 'UNKNOWN') = 'UNKNOWN'
        UNION ALL BY NAME
        SELECT 'INCOMPLETE_TRADING_DATE' AS issue_type, n.code, trade_date, trade_date AS affected_start,
               trade_date AS affected_end,
               format('trading date has incomplete bar coverage; row_count={{}}; previous_row_count={{}}; next_row_count={{}}',
                      i.row_count, i.previous_row_count, i.next_row_count) AS issue_detail
        FROM normalized n JOIN incomplete_dates i USING (trade_date)
        UNION ALL BY NAME
        SELECT 'UNRESOLVED_ADJ_FACTOR_JUMP' AS issue_type, code, trade_date, affected_start, affected_end,
               format('unresolved adjustment-factor jump; triage={{}}; previous_trade_date={{}}; factor_ratio={{:.6f}}',
                      triage_class, {day_text('previous_trade_date')}, factor_ratio) AS issue_detail
        FROM affected"""),
    ("flags", """
        SELECT h.trade_date, h.code, issue_type, k.issue_severity, k.usable_for_vpa, k.usable_for_ml_feature, k.usable_for_ml_label,
               k.usable_for_backtest, k.execution_restricted, h.affected_start, h.affected_end, h.issue_detail
        FROM (SELECT DISTINCT ON (trade_date, code, issue_type) * FROM issue_hits ORDER BY issue_detail) h
        JOIN issue_kinds k USING (issue_type)"""),
    ("q_unresolved", "SELECT * FROM jump_facts WHERE NOT has_explaining_corporate_action"),
    ("q_ctx", f"""
        SELECT *, {first_that_holds(TRIAGE, ['undone_same', 'nearest_days BETWEEN 1 AND 30', 'factor_pre_close_basis_diff <= CAST(0.001 AS DOUBLE)', "severity = 'low'"])} AS triage_class,
               {first_that_holds(PROXIMITY, ['done_same', 'undone_same', 'nearest_days BETWEEN 1 AND 5', 'nearest_days BETWEEN 6 AND 30'])} AS dividend_proximity_bucket,
               CASE WHEN nearest_days IS NULL THEN NULL WHEN trade_date - done_before = nearest_days THEN done_before
                    ELSE done_after END AS nearest_implemented_dividend_ex_date
        FROM q_unresolved"""),
]
