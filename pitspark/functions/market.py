"""Market classification columns (CASE chains evaluated JVM-side).

Each function returns a Column; the order of the ``when`` branches is part of
the semantics (first match wins).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the provider conventions.
A_SHARE_EXCHANGES = ["SZ", "SH", "BJ"]
IMPLEMENTED_DIVIDEND = "实施"
ST_CHANGE_REASONS = ["ST", "*ST"]
SUSPEND_TYPES = ["S", "停牌"]
FULL_DAY_TIMING_MARK = "全天"
JUMP_THRESHOLD = 0.001
LIMIT_TOLERANCE = 1e-6
# Magnitude cut points of |factor_ratio - 1| with their bucket, severity and order.
MAGNITUDE_CUTS = [(0.005, "<=50bp", "low", 1), (0.02, "<=2pct", "medium", 2), (0.10, "<=10pct", "high", 3)]
MAGNITUDE_TOP = (">10pct", "critical", 4)
# Triage classes and their report order.
TRIAGE_ORDER = [
    "implemented_dividend_outside_factor_window",
    "nonimplemented_dividend_same_date",
    "daily_pre_close_ex_right_without_ledger",
    "low_materiality_provider_factor_noise",
    "provider_factor_jump_without_event_evidence",
]
PROXIMITY_ORDER = [
    "same_date_implemented",
    "same_date_nonimplemented_only",
    "implemented_within_5d",
    "implemented_within_30d",
    "no_implemented_within_30d",
]
RECOMMENDED_ACTION = "quarantine_security_window_from_promotion"
RECONCILIATION_SOURCE = "derived.adj_factor_reconciliation"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def exchange_of(ts_code: Column | str) -> Column:
    return F.split_part(_c(ts_code), F.lit("."), F.lit(2))


def board(ts_code: Column | str, symbol: Column | str) -> Column:
    """BJ -> beijing; 688* -> star; 300*/301* -> chinext; else main_board."""
    s = _c(symbol)
    return (
        F.when(exchange_of(ts_code) == "BJ", F.lit("beijing"))
        .when(s.startswith("688"), F.lit("star"))
        .when(s.startswith("300") | s.startswith("301"), F.lit("chinext"))
        .otherwise(F.lit("main_board"))
    )


def is_st_name(name: Column | str, change_reason: Column | str) -> Column:
    return (
        F.when(_c(name).contains("ST"), F.lit(True))
        .when(_c(change_reason).isin(*ST_CHANGE_REASONS), F.lit(True))
        .otherwise(F.lit(False))
    )


def _cut_chain(abs_change: Column, pick: int) -> Column:
    expr = None
    for cut in MAGNITUDE_CUTS:
        value = F.lit(cut[pick])
        expr = F.when(abs_change <= cut[0], value) if expr is None else expr.when(abs_change <= cut[0], value)
    return expr.otherwise(F.lit(MAGNITUDE_TOP[pick - 1]))


def magnitude_bucket(abs_change: Column) -> Column:
    return _cut_chain(abs_change, 1)


def severity(abs_change: Column) -> Column:
    return _cut_chain(abs_change, 2)


def magnitude_order(abs_change: Column) -> Column:
    return _cut_chain(abs_change, 3)


def triage_class(same_date_nonimplemented: Column, nearest_days: Column, basis_diff: Column, abs_change: Column) -> Column:
    """First match wins; a NULL condition falls through to the next branch."""
    return (
        F.when(same_date_nonimplemented, F.lit(TRIAGE_ORDER[1]))
        .when(nearest_days.between(1, 30), F.lit(TRIAGE_ORDER[0]))
        .when(basis_diff <= 0.001, F.lit(TRIAGE_ORDER[2]))
        .when(abs_change <= 0.005, F.lit(TRIAGE_ORDER[3]))
        .otherwise(F.lit(TRIAGE_ORDER[4]))
    )


def triage_class_without_dividends(basis_diff: Column, abs_change: Column) -> Column:
    return (
        F.when(basis_diff <= 0.001, F.lit(TRIAGE_ORDER[2]))
        .when(abs_change <= 0.005, F.lit(TRIAGE_ORDER[3]))
        .otherwise(F.lit("raw_dividend_missing"))
    )


def ordinal(value: Column, ordered: list[str]) -> Column:
    """Position (1-based) of ``value`` in ``ordered``; len+1 when absent."""
    expr = None
    for i, name in enumerate(ordered, start=1):
        expr = F.when(value == name, F.lit(i)) if expr is None else expr.when(value == name, F.lit(i))
    return expr.otherwise(F.lit(len(ordered) + 1))


def proximity_bucket(same_date_implemented: Column, same_date_nonimplemented: Column, nearest_days: Column) -> Column:
    return (
        F.when(same_date_implemented, F.lit(PROXIMITY_ORDER[0]))
        .when(same_date_nonimplemented, F.lit(PROXIMITY_ORDER[1]))
        .when(nearest_days.between(1, 5), F.lit(PROXIMITY_ORDER[2]))
        .when(nearest_days.between(6, 30), F.lit(PROXIMITY_ORDER[3]))
        .otherwise(F.lit(PROXIMITY_ORDER[4]))
    )


def safe_ratio(num: Column, den: Column) -> Column:
    """``num / NULLIF(den, 0)`` (NULL instead of an ANSI divide-by-zero error)."""
    return num / F.nullif(den, F.lit(0.0))


def basis_diff(factor_ratio: Column, previous_close: Column, pre_close: Column) -> Column:
    """|factor_ratio / (previous_close / pre_close) - 1| with NULL-guarded division."""
    return F.abs(safe_ratio(factor_ratio, safe_ratio(previous_close, pre_close)) - F.lit(1.0))
