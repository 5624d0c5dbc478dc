"""Corporate-action ledger, inferred repairs and the exception ledger (W1, W2,
J8–J12, C1–C3, P11–P13).

Order matters: repairs (C2) are tested against the dividend action rows only;
the exception ledger (C3) is tested against the full ledger including repairs.
Everything known about a jump is gathered once, in ``jump_facts``: jumps, bookings, dividends by progress and
suspensions are united, shuffled by security and scanned once forward and once back (``asof_events``).
Repairs, exceptions and the quality report's context are projections of that frame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import date_key
from ..functions.market import (
    IMPLEMENTED_DIVIDEND,
    JUMP_THRESHOLD,
    RECOMMENDED_ACTION,
    RECONCILIATION_SOURCE,
    basis_diff,
    magnitude_bucket,
    safe_ratio,
    severity,
    triage_class,
)
from ..operators.temporal import Lookup, asof_events, event_in_window, nearest_distance

JUMP_KEYS = ["security_id", "trade_date"]
LEDGER_COLUMNS = ["action_id", "security_id", "action_type", "record_date", "book_date", "ex_date",
                  "cash_per_share", "share_ratio", "source_table"]


def colon_join(*parts: F.Column) -> F.Column:
    """``a || ':' || b ...`` — NULL when any part is NULL (like SQL ``||``)."""
    out = [parts[0]]
    for p in parts[1:]:
        out += [F.lit(":"), p]
    return F.concat(*out)


def factor_series(bars: DataFrame) -> DataFrame:
    """W1 input: unadjusted bars with a positive factor, with the previous
    bar's date, close and factor per security."""
    w = Window.partitionBy("security_id").orderBy("trade_date")
    b = bars.where(
        (F.coalesce(F.col("price_basis"), F.lit("unadjusted")) == "unadjusted")
        & F.col("adj_factor").isNotNull()
        & (F.col("adj_factor") > 0.0)
    ).select("security_id", "trade_date", "close", "pre_close", "adj_factor")
    return b.select(
        "security_id",
        "trade_date",
        F.lag("trade_date").over(w).alias("previous_trade_date"),
        "close",
        F.lag("close").over(w).alias("previous_close"),
        "pre_close",
        "adj_factor",
        F.lag("adj_factor").over(w).alias("previous_adj_factor"),
    )


def significant_jumps(bars: DataFrame) -> DataFrame:
    """|factor / previous factor - 1| > 0.001 (previous bar and factor present)."""
    s = factor_series(bars)
    ratio = safe_ratio(F.col("adj_factor"), F.col("previous_adj_factor"))
    return s.where(
        F.col("previous_trade_date").isNotNull()
        & F.col("previous_adj_factor").isNotNull()
        & (F.col("previous_adj_factor") > 0.0)
        & (F.abs(ratio - 1.0) > JUMP_THRESHOLD)
    ).select(
        "security_id",
        "previous_trade_date",
        "trade_date",
        "previous_close",
        "pre_close",
        "previous_adj_factor",
        F.col("adj_factor").alias("current_adj_factor"),
        ratio.alias("factor_ratio"),
        F.abs(ratio - 1.0).alias("abs_factor_change"),
        safe_ratio(F.col("previous_close"), F.col("pre_close")).alias("pre_close_factor_ratio"),
    )


def action_rows(dividends: DataFrame) -> DataFrame:
    """Implemented dividends as cash and share bookings."""
    imp = dividends.where((F.col("div_proc") == IMPLEMENTED_DIVIDEND) & F.col("ex_date").isNotNull()).select(
        F.col("ts_code").alias("security_id"),
        "end_date",
        "record_date",
        "ex_date",
        F.coalesce("pay_date", "ex_date").alias("pay_date"),
        F.coalesce("cash_div_tax", "cash_div", F.lit(0.0)).alias("cash_per_share"),
        (F.coalesce("stk_div", F.lit(0.0)) + F.coalesce("stk_bo_rate", F.lit(0.0)) + F.coalesce("stk_co_rate", F.lit(0.0))).alias("share_ratio"),
        "source_table",
    )

    def aid(kind: str) -> F.Column:
        return colon_join(F.col("security_id"), F.coalesce(date_key("end_date"), F.lit("")), date_key("ex_date"), F.lit(kind))

    cash = imp.where(F.col("cash_per_share").isNotNull() & (F.col("cash_per_share") > 0.0) & F.col("pay_date").isNotNull()).select(
        aid("cash").alias("action_id"), "security_id", F.lit("cash_dividend").alias("action_type"), "record_date",
        F.col("pay_date").alias("book_date"), "ex_date", "cash_per_share", F.lit(0.0).alias("share_ratio"), "source_table",
    )
    share = imp.where(F.col("share_ratio").isNotNull() & (F.col("share_ratio") > 0.0)).select(
        aid("share").alias("action_id"), "security_id", F.lit("share_dividend").alias("action_type"), "record_date",
        F.coalesce("ex_date", "pay_date").alias("book_date"), "ex_date", F.lit(0.0).alias("cash_per_share"), "share_ratio",
        "source_table",
    )
    return cash.unionByName(share)


def action_dates(ledger: DataFrame) -> DataFrame:
    """Every dated booking of the ledger as an event: ex dates, book dates and, where the ledger has them, action dates."""
    out = None
    for c in ("ex_date", "book_date", "action_date"):
        if c in ledger.columns:
            part = ledger.select("security_id", F.col(c).cast("date").alias("_d"))
            out = part if out is None else out.unionByName(part)
    return out.where(F.col("_d").isNotNull())


JUMP_COLUMNS = ["security_id", "previous_trade_date", "trade_date", "previous_close", "pre_close", "previous_adj_factor",
                "current_adj_factor", "factor_ratio", "abs_factor_change", "pre_close_factor_ratio"]


def jump_facts(jumps: DataFrame, ledger: DataFrame, dividends: DataFrame | None, suspend: DataFrame | None) -> DataFrame:
    """Jumps with all that their security's events say about them (J8, J9, J10, J11, J12, J13 in one pass).

    Adds last_action, last_halt, done_before, done_after (dates), done_same, open_same, blank_same, dividend_count
    (dividends with an ex date: implemented, otherwise in progress or without progress that day, and all), has_action,
    has_suspend_window and nearest_days.  An event in (previous day, jump day] is one whose last date on or before the jump
    day lies after the previous day.
    """
    events = {"action": (action_dates(ledger), "security_id", "_d")}
    if dividends is not None:
        proc = F.col("div_proc")
        for kind, cond in (("done", proc == IMPLEMENTED_DIVIDEND), ("open", proc != IMPLEMENTED_DIVIDEND), ("blank", proc.isNull())):
            events[kind] = (dividends.where(cond), "ts_code", "ex_date")
    if suspend is not None:
        events["halt"] = (suspend, "ts_code", "trade_date")
    facts = asof_events(jumps, events, key="security_id", point="trade_date", lookups=[
        Lookup("last_action", "last", ("action",)), Lookup("last_halt", "last", ("halt",)),
        Lookup("done_before", "last", ("done",)), Lookup("done_after", "next", ("done",)),
        Lookup("done_same", "same", ("done",)), Lookup("open_same", "same", ("open",)), Lookup("blank_same", "same", ("blank",)),
        Lookup("dividend_count", "total", ("done", "open", "blank")),
    ])
    day, previous = F.col("trade_date"), F.col("previous_trade_date")
    return facts.withColumns({
        "has_action": F.coalesce(F.col("last_action") > previous, F.lit(False)),
        "has_suspend_window": F.coalesce(F.col("last_halt") > previous, F.lit(False)),
        "nearest_days": F.least(F.datediff(day, F.col("done_before")), F.datediff(F.col("done_after"), day)),
    })


def is_repair() -> F.Column:
    """No booking explains the jump, but dividend evidence makes it a factor repair."""
    days = F.col("nearest_days")
    diff = basis_diff(F.col("factor_ratio"), F.col("previous_close"), F.col("pre_close"))
    return ~F.col("has_action") & F.coalesce((F.col("open_same") > 0) | days.between(1, 30) | ((diff <= 0.001) & days.between(1, 90)), F.lit(False))


def is_explained() -> F.Column:
    """J9 against the whole ledger: a repair is booked on its jump's day and on no day of another jump's window."""
    return F.col("has_action") | is_repair()


def explained_flag(jumps: DataFrame, ledger: DataFrame, name: str = "has_explaining_corporate_action") -> DataFrame:
    """An action's ex_date or book_date in (previous day, jump day].

    The first action date strictly after the previous trading day (an as-of
    scan per security) must fall on or before the jump day.
    """
    return event_in_window(jumps, action_dates(ledger), on=[("security_id", "security_id")], after="previous_trade_date",
                           until="trade_date", event_date="_d", name=name)


def unexplained(jumps: DataFrame, ledger: DataFrame) -> DataFrame:
    """Jumps with no ledger action in their window."""
    flagged = explained_flag(jumps, ledger, name="_explained")
    return flagged.where(~F.col("_explained")).drop("_explained")


def same_date_nonimplemented(jumps: DataFrame, dividends: DataFrame, *, null_counts: bool = False,
                             name: str = "has_same_date_nonimplemented_dividend") -> DataFrame:
    """A non-implemented dividend with ex_date on the jump day.

    ``null_counts=False`` is the ledger rule (NULL progress does not count);
    ``True`` is the quality-report rule (NULL progress counts as not implemented).
    """
    proc = F.coalesce(F.col("div_proc"), F.lit("")) if null_counts else F.col("div_proc")
    keys = (
        dividends.where((proc != IMPLEMENTED_DIVIDEND) & F.col("ex_date").isNotNull())
        .select(F.col("ts_code").alias("security_id"), F.col("ex_date").alias("trade_date"))
        .distinct()
        .withColumn(name, F.lit(True))
    )
    return jumps.join(keys, JUMP_KEYS, "left").withColumn(name, F.coalesce(F.col(name), F.lit(False)))


def implemented_ex_dates(dividends: DataFrame) -> DataFrame:
    return dividends.where((F.col("div_proc") == IMPLEMENTED_DIVIDEND) & F.col("ex_date").isNotNull()).select(
        F.col("ts_code").alias("security_id"), "ex_date"
    )


def nearest_implemented_days(jumps: DataFrame, dividends: DataFrame, name: str = "nearest_implemented_dividend_days") -> DataFrame:
    """Min |ex_date - jump day| over implemented dividends of the security."""
    return nearest_distance(jumps, implemented_ex_dates(dividends), row_keys=JUMP_KEYS, on=[("security_id", "security_id")],
                            point="trade_date", event_date="ex_date", out=name)


def suspend_in_window(jumps: DataFrame, suspend: DataFrame, name: str = "has_suspend_window") -> DataFrame:
    """Any suspension event in (previous day, jump day]."""
    s = suspend.select(F.col("ts_code").alias("s_code"), F.col("trade_date").alias("s_date"))
    return event_in_window(jumps, s, on=[("security_id", "s_code")], after="previous_trade_date", until="trade_date",
                           event_date="s_date", name=name)


def repairs_of(facts: DataFrame) -> DataFrame:
    """Ledger rows of the jumps that are factor repairs."""
    return facts.where(is_repair()).select(
        colon_join(F.col("security_id"), date_key("trade_date"), F.lit("inferred_adj_factor_repair")).alias("action_id"),
        "security_id",
        F.lit("inferred_adj_factor_repair").alias("action_type"),
        F.col("previous_trade_date").alias("record_date"),
        F.col("trade_date").alias("book_date"),
        F.col("trade_date").alias("ex_date"),
        F.lit(0.0).alias("cash_per_share"),
        F.lit(0.0).alias("share_ratio"),
        F.lit(RECONCILIATION_SOURCE).alias("source_table"),
    )


def inferred_repairs(bars: DataFrame, dividends: DataFrame) -> DataFrame:
    """Unexplained jumps that dividend evidence makes a factor repair."""
    return repairs_of(jump_facts(significant_jumps(bars), action_rows(dividends), dividends, None))


def corporate_action_ledger(bars: DataFrame, dividends: DataFrame) -> DataFrame:
    """C1 + C2: dividend bookings followed by inferred repairs."""
    return action_rows(dividends).select(*LEDGER_COLUMNS).unionByName(inferred_repairs(bars, dividends).select(*LEDGER_COLUMNS))


EXCEPTION_COLUMNS = [
    "exception_id", "security_id", "previous_trade_date", "trade_date", "previous_adj_factor", "current_adj_factor",
    "factor_ratio", "abs_factor_change", "previous_close", "pre_close", "pre_close_factor_ratio",
    "factor_pre_close_basis_diff", "magnitude_bucket", "severity", "has_suspend_window", "triage_class",
    "recommended_action", "source_table",
]


def exceptions_of(unexplained_facts: DataFrame) -> DataFrame:
    """The given jumps with context and classification."""
    change = F.col("abs_factor_change")
    j = unexplained_facts.withColumn("factor_pre_close_basis_diff", F.abs(safe_ratio(F.col("factor_ratio"), F.col("pre_close_factor_ratio")) - 1.0))
    return j.select(
        colon_join(F.col("security_id"), date_key("previous_trade_date"), date_key("trade_date"), F.lit("adj_factor_exception")).alias("exception_id"),
        "security_id", "previous_trade_date", "trade_date", "previous_adj_factor", "current_adj_factor", "factor_ratio",
        "abs_factor_change", "previous_close", "pre_close", "pre_close_factor_ratio", "factor_pre_close_basis_diff",
        magnitude_bucket(change).alias("magnitude_bucket"),
        severity(change).alias("severity"),
        "has_suspend_window",
        triage_class(F.col("open_same") > 0, F.col("nearest_days"), F.col("factor_pre_close_basis_diff"), change).alias("triage_class"),
        F.lit(RECOMMENDED_ACTION).alias("recommended_action"),
        F.lit(RECONCILIATION_SOURCE).alias("source_table"),
    )


def exception_ledger(bars: DataFrame, ledger: DataFrame, dividends: DataFrame, suspend: DataFrame) -> DataFrame:
    """Jumps no ledger row explains, with context and classification."""
    return exceptions_of(jump_facts(significant_jumps(bars), ledger, dividends, suspend).where(~F.col("has_action")))
