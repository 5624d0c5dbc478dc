"""Data-quality flags, summaries and gates.

Usability flags come from four issue streams; every stream is keyed by
(trade_date, code) and the union is deduplicated per (date, code, issue).
Summaries are single-pass aggregates; the jump breakdowns share one
classified-jump frame (callers persist it when several breakdowns are built
from the same session).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.market import (
    IMPLEMENTED_DIVIDEND,
    PROXIMITY_ORDER,
    RECOMMENDED_ACTION,
    TRIAGE_ORDER,
    basis_diff,
    magnitude_bucket,
    magnitude_order,
    ordinal,
    proximity_bucket,
    triage_class,
    triage_class_without_dividends,
)
from ..operators.temporal import shift_clamped
from . import actions

# Issue rules (severity and the five usability flags per issue type).
ISSUE_RULES = {
    "MISSING_LIMIT": ("MEDIUM", True, True, True, False, True),
    "UNRESOLVED_ADJ_FACTOR_JUMP": ("HIGH", False, False, False, False, True),
    "MISSING_INDUSTRY_CODE": ("LOW", True, True, True, True, False),
    "INCOMPLETE_TRADING_DATE": ("HIGH", False, False, False, False, True),
}
RULE_FIELDS = ["issue_severity", "usable_for_vpa", "usable_for_ml_feature", "usable_for_ml_label",
               "usable_for_backtest", "execution_restricted"]
# Issue texts.
MISSING_LIMIT_DETAIL = "up_limit or down_limit is missing; execution checks must be conservative"
MISSING_INDUSTRY_DETAIL = ("industry_code is missing and standardized to UNKNOWN; industry attribution and portfolio "
                           "constraints should handle UNKNOWN explicitly")
JUMP_WINDOW_BACK = 60
JUMP_WINDOW_FORWARD = 10
EXAMPLE_LIMIT = 500
TOP_SECURITIES = 30
FLAG_COLUMNS = ["trade_date", "code", "issue_type", *RULE_FIELDS, "affected_start", "affected_end", "issue_detail"]


def issue_rule(issue_type: str) -> tuple:
    try:
        return ISSUE_RULES[issue_type]
    except KeyError as exc:
        raise ValueError(
            f"{issue_type} is no issue type; there are {', '.join(sorted(ISSUE_RULES))}"
        ) from exc


def _with_rule(df: DataFrame, issue_type: str) -> DataFrame:
    rule = issue_rule(issue_type)
    return df.select(
        "trade_date", "code", F.lit(issue_type).alias("issue_type"),
        *[F.lit(v).alias(n) for n, v in zip(RULE_FIELDS, rule)],
        "affected_start", "affected_end", "issue_detail",
    )


def missing_limit_rows(tradeability: DataFrame) -> DataFrame:
    """P10: bars whose official limits are incomplete."""
    return tradeability.where(F.col("up_limit").isNull() | F.col("down_limit").isNull())


def missing_industry_rows(normalized: DataFrame) -> DataFrame:
    """P10: normalized bars without an industry."""
    return normalized.where(F.col("industry_code").isNull() | (F.col("industry_code") == "UNKNOWN")).select("trade_date", "code").distinct()


def date_counts(normalized: DataFrame) -> DataFrame:
    """A6 + W6: rows per date with the neighbouring dates' counts.

    The window runs over per-date aggregates (one row per trading day), never
    over bars, so its single partition is bounded by the calendar.
    """
    counts = normalized.groupBy("trade_date").agg(F.count(F.lit(1)).alias("row_count"))
    w = Window.orderBy("trade_date")
    return counts.withColumn("previous_row_count", F.lag("row_count").over(w)).withColumn(
        "next_row_count", F.lead("row_count").over(w)
    )


def incomplete_dates(normalized: DataFrame) -> DataFrame:
    """Dates with fewer than half the rows of the thinner neighbour."""
    c = date_counts(normalized)
    return c.where(
        F.col("previous_row_count").isNotNull()
        & F.col("next_row_count").isNotNull()
        & (F.col("row_count") < F.least("previous_row_count", "next_row_count") * 0.5)
    )


def trading_sequence(bars: DataFrame) -> DataFrame:
    return bars.select(F.col("security_id").alias("code"), "trade_date").distinct()


def affected_windows(exceptions: DataFrame, bars: DataFrame) -> DataFrame:
    """J14 + J16: per exception, the trading day 60 bars earlier and 10 later
    (clamped to the security's first / last bar); exceptions whose day has no
    bar are dropped."""
    seq = shift_clamped(trading_sequence(bars), keys=["code"], order="trade_date", value="trade_date",
                        back=JUMP_WINDOW_BACK, forward=JUMP_WINDOW_FORWARD,
                        out_back="affected_start", out_forward="affected_end")
    base = exceptions.select(F.col("security_id").alias("code"), "trade_date", "previous_trade_date", "factor_ratio",
                             "triage_class").distinct()
    return base.join(seq, ["code", "trade_date"], "inner")


def ratio_text(c: F.Column) -> F.Column:
    """Ratios in issue text use a fixed 6-decimal format (same in every engine)."""
    return F.format_string("%.6f", c)


def usability_flags(bars: DataFrame, tradeability: DataFrame, normalized: DataFrame, exceptions: DataFrame | None) -> DataFrame:
    """One row per (trade_date, code, issue_type)."""
    ml = missing_limit_rows(tradeability).select(
        "trade_date", F.col("security_id").alias("code"), F.col("trade_date").alias("affected_start"),
        F.col("trade_date").alias("affected_end"), F.lit(MISSING_LIMIT_DETAIL).alias("issue_detail"),
    ).distinct()
    mi = missing_industry_rows(normalized).select(
        "trade_date", "code", F.col("trade_date").alias("affected_start"), F.col("trade_date").alias("affected_end"),
        F.lit(MISSING_INDUSTRY_DETAIL).alias("issue_detail"),
    )
    inc = incomplete_dates(normalized)
    detail = F.concat(
        F.lit("trading date has incomplete bar coverage; row_count="), F.col("row_count").cast("string"),
        F.lit("; previous_row_count="), F.col("previous_row_count").cast("string"),
        F.lit("; next_row_count="), F.col("next_row_count").cast("string"),
    )
    # The flagged dates are few (bounded by the calendar); the runtime
    # broadcasts them once measured.
    it = normalized.select("trade_date", "code").join(inc.select("trade_date", detail.alias("issue_detail")), "trade_date").select(
        "trade_date", "code", F.col("trade_date").alias("affected_start"), F.col("trade_date").alias("affected_end"),
        "issue_detail",
    ).distinct()
    streams = [_with_rule(ml, "MISSING_LIMIT"), _with_rule(mi, "MISSING_INDUSTRY_CODE"), _with_rule(it, "INCOMPLETE_TRADING_DATE")]
    if exceptions is not None:
        aw = affected_windows(exceptions, bars)
        jd = F.concat(
            F.lit("unresolved adjustment-factor jump; triage="), F.coalesce(F.col("triage_class"), F.lit("unknown")),
            F.lit("; previous_trade_date="), F.coalesce(F.date_format("previous_trade_date", "yyyyMMdd"), F.lit("")),
            F.lit("; factor_ratio="), F.coalesce(ratio_text(F.col("factor_ratio")), F.lit("")),
        )
        uj = aw.select("trade_date", "code", "affected_start", "affected_end", jd.alias("issue_detail"))
        streams.append(_with_rule(uj, "UNRESOLVED_ADJ_FACTOR_JUMP"))
    union = streams[0]
    for s in streams[1:]:
        union = union.unionByName(s)
    w = Window.partitionBy("trade_date", "code", "issue_type").orderBy(F.col("issue_detail").asc_nulls_last())
    return union.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


# ------------------------------------------------------------ counts
def issue_count_conditions() -> list[tuple[str, F.Column]]:
    return [
    ("missing_limit_count", F.col("issue_type") == "MISSING_LIMIT"),
    ("unresolved_adj_factor_jump_count", F.col("issue_type") == "UNRESOLVED_ADJ_FACTOR_JUMP"),
    ("missing_industry_code_count", F.col("issue_type") == "MISSING_INDUSTRY_CODE"),
    ("incomplete_trading_date_count", F.col("issue_type") == "INCOMPLETE_TRADING_DATE"),
    ("low_issue_count", F.col("issue_severity") == "LOW"),
    ("medium_issue_count", F.col("issue_severity") == "MEDIUM"),
    ("high_issue_count", F.col("issue_severity") == "HIGH"),
    ("unusable_for_vpa_count", ~F.col("usable_for_vpa")),
    ("unusable_for_ml_feature_count", ~F.col("usable_for_ml_feature")),
    ("unusable_for_ml_label_count", ~F.col("usable_for_ml_label")),
    ("unusable_for_backtest_count", ~F.col("usable_for_backtest")),
    ("execution_restricted_count", F.col("execution_restricted")),
    ]


def issue_counts(flags: DataFrame) -> DataFrame:
    """Twelve conditional counts in one pass (one row)."""
    return flags.agg(*[F.count_if(cond).alias(name) for name, cond in issue_count_conditions()])


def issue_counts_by_type(flags: DataFrame) -> DataFrame:
    """A8."""
    return flags.groupBy("issue_type").agg(F.count(F.lit(1)).alias("row_count"))


def quality_scalars(bars: DataFrame, ledger: DataFrame, tradeability: DataFrame) -> DataFrame:
    """A9 as long form (metric, value): one aggregate per table, unioned."""
    b = bars.agg(
        F.count(F.lit(1)).alias("daily_bar_rows"),
        F.count_if(F.col("price_basis") == "qfq_fallback").alias("qfq_fallback_rows"),
        F.count_if(F.col("open").isNull() | F.col("high").isNull() | F.col("low").isNull() | F.col("close").isNull()).alias("missing_price_rows"),
        F.count_if(F.col("adj_factor").isNull() | (F.col("adj_factor") <= 0.0)).alias("zero_or_missing_adj_factor_rows"),
    )
    a = ledger.agg(F.count(F.lit(1)).alias("corporate_action_rows"))
    t = tradeability.agg(
        F.count(F.lit(1)).alias("tradeability_rows"),
        F.count_if(F.col("source_priority") == "official").alias("tradeability_official_rows"),
        F.count_if(F.col("source_priority") == "ohlc_fallback").alias("tradeability_ohlc_fallback_rows"),
        F.count_if(F.col("up_limit").isNull() | F.col("down_limit").isNull()).alias("tradeability_missing_limit_rows"),
        F.count_if(F.col("is_suspended").isNull()).alias("tradeability_missing_suspend_rows"),
    )
    return _long(b).unionByName(_long(a)).unionByName(_long(t))


def _long(one_row: DataFrame) -> DataFrame:
    pairs = ", ".join(f"'{c}', CAST(`{c}` AS BIGINT)" for c in one_row.columns)
    return one_row.selectExpr(f"stack({len(one_row.columns)}, {pairs}) AS (metric, value)")


def source_ratios(tradeability: DataFrame) -> DataFrame:
    """Official / fallback shares of tradeability rows (0.0 when empty)."""
    t = tradeability.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("source_priority") == "official").alias("official"),
        F.count_if(F.col("source_priority") == "ohlc_fallback").alias("fallback"),
    )
    n = F.col("n")
    return t.select(
        n.alias("tradeability_total_rows"),
        F.when(n > 0, F.col("official") / n).otherwise(F.lit(0.0)).alias("official_ratio"),
        F.when(n > 0, F.col("fallback") / n).otherwise(F.lit(0.0)).alias("fallback_ratio"),
    )


# ------------------------------------------------------ jump breakdowns
def classified_jumps(bars: DataFrame, ledger: DataFrame) -> DataFrame:
    """Every significant jump with the explained-by-ledger flag."""
    facts = actions.jump_facts(actions.significant_jumps(bars), ledger, None, None)
    return facts.select("security_id", "previous_trade_date", "trade_date", "previous_close", "pre_close", "factor_ratio",
                        F.col("has_action").alias("has_explaining_corporate_action"))


def unresolved(classified: DataFrame) -> DataFrame:
    return classified.where(~F.col("has_explaining_corporate_action")).drop("has_explaining_corporate_action")


def jump_totals(classified: DataFrame) -> DataFrame:
    """Total / explained / unresolved jump rows in one pass."""
    return classified.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("has_explaining_corporate_action")).alias("explained_rows"),
        F.count_if(~F.col("has_explaining_corporate_action")).alias("unresolved_rows"),
    )


def jump_years(unres: DataFrame) -> DataFrame:
    """A10."""
    return unres.groupBy(F.date_format("trade_date", "yyyy").alias("year")).agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("security_id").alias("securities"),
        F.min("trade_date").alias("earliest_date"), F.max("trade_date").alias("latest_date"),
    )


def magnitude_summary(unres: DataFrame) -> DataFrame:
    """A11."""
    change = F.abs(F.col("factor_ratio") - 1.0)
    return unres.groupBy(magnitude_bucket(change).alias("bucket")).agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("security_id").alias("securities"),
        F.min(magnitude_order(change)).alias("bucket_order"),
    )


def top_securities(unres: DataFrame, n: int = TOP_SECURITIES) -> DataFrame:
    """Securities with the most unresolved jumps (top-n report)."""
    g = unres.groupBy("security_id").agg(
        F.count(F.lit(1)).alias("rows"), F.min("trade_date").alias("earliest_date"),
        F.max("trade_date").alias("latest_date"), F.min("factor_ratio").alias("min_factor_ratio"),
        F.max("factor_ratio").alias("max_factor_ratio"),
    )
    return g.orderBy(F.col("rows").desc(), F.col("security_id").asc()).limit(n)


def context_of(facts: DataFrame, with_dividends: bool = True) -> DataFrame:
    """Per unresolved jump of ``actions.jump_facts``: same-day implemented / non-implemented dividends (no progress
    counts as non-implemented here; NULL where the security has no dividend, or none with progress), nearest implemented
    distance, basis difference, suspension window and classes.  Without a dividend table (P14, T2) the jump is classified by
    basis and size alone and has no proximity."""
    n = F.col("dividend_count")
    ctx = facts.withColumns({
        "has_same_date_implemented": F.when(n == 0, F.lit(None).cast("boolean")).when(F.col("done_same") > 0, True).when(F.col("blank_same") == n, F.lit(None).cast("boolean")).otherwise(False),
        "has_same_date_nonimplemented": F.when(n == 0, F.lit(None).cast("boolean")).otherwise(F.col("open_same") + F.col("blank_same") > 0),
        "nearest_implemented_days": F.col("nearest_days"),
        "factor_pre_close_basis_diff": basis_diff(F.col("factor_ratio"), F.col("previous_close"), F.col("pre_close")),
    })
    diff, change = F.col("factor_pre_close_basis_diff"), F.abs(F.col("factor_ratio") - 1.0)
    if not with_dividends:
        return ctx.withColumns({"triage_class": triage_class_without_dividends(diff, change), "dividend_proximity_bucket": F.lit("raw_dividend_missing")})
    return ctx.withColumns({
        "triage_class": triage_class(F.col("has_same_date_nonimplemented"), F.col("nearest_implemented_days"), diff, change),
        "dividend_proximity_bucket": proximity_bucket(F.col("has_same_date_implemented"), F.col("has_same_date_nonimplemented"), F.col("nearest_implemented_days")),
    })


def dividend_context(unres: DataFrame, dividends: DataFrame, suspend: DataFrame | None) -> DataFrame:
    """The context of given jumps, their events gathered in one pass."""
    nothing = unres.select("security_id", F.lit(None).cast("date").alias("ex_date")).limit(0)
    keys = ["security_id", "previous_trade_date", "trade_date", "previous_close", "pre_close", "factor_ratio"]
    return context_of(actions.jump_facts(unres.select(*keys), nothing, dividends, suspend))


def dividend_proximity(ctx: DataFrame) -> DataFrame:
    """A12."""
    return ctx.groupBy(F.col("dividend_proximity_bucket").alias("bucket")).agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("security_id").alias("securities"),
        F.min(ordinal(F.col("dividend_proximity_bucket"), PROXIMITY_ORDER)).alias("bucket_order"),
    )


def triage_summary(ctx: DataFrame) -> DataFrame:
    """A13."""
    return ctx.groupBy("triage_class").agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("security_id").alias("securities"),
        F.min(ordinal(F.col("triage_class"), TRIAGE_ORDER)).alias("triage_order"),
    )


def triage_without_dividends(unres: DataFrame) -> DataFrame:
    """Triage when no dividend table exists."""
    diff = basis_diff(F.col("factor_ratio"), F.col("previous_close"), F.col("pre_close"))
    t = unres.withColumn("triage_class", triage_class_without_dividends(diff, F.abs(F.col("factor_ratio") - 1.0)))
    return t.groupBy("triage_class").agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("security_id").alias("securities"),
        F.min(ordinal(F.col("triage_class"), TRIAGE_ORDER)).alias("triage_order"),
    )


def jump_examples(ctx: DataFrame, n: int = EXAMPLE_LIMIT) -> DataFrame:
    """The n largest unresolved jumps with their context (top-n report)."""
    top = ctx.orderBy(F.abs(F.col("factor_ratio") - 1.0).desc(), F.col("security_id").asc(), F.col("trade_date").asc()).limit(n)
    before, day = F.col("done_before"), F.col("trade_date")
    earlier = F.datediff(day, before) == F.col("nearest_days")  # a tie goes to the earlier one
    return top.select(
        "security_id", "previous_trade_date", "trade_date", "factor_ratio",
        magnitude_bucket(F.abs(F.col("factor_ratio") - 1.0)).alias("magnitude_bucket"),
        "dividend_proximity_bucket", F.when(earlier, before).otherwise(F.col("done_after")).alias("nearest_implemented_dividend_ex_date"),
        F.col("nearest_days").cast("bigint").alias("nearest_implemented_dividend_days"),
        "has_suspend_window", F.round("factor_pre_close_basis_diff", 12).alias("factor_pre_close_basis_diff"), "triage_class",
        F.lit(RECOMMENDED_ACTION).alias("recommended_action"),
    )


# ---------------------------------------------------------------- gates
@dataclass(frozen=True)
class GateParams:
    min_official_ratio: float | None = None
    fail_on_missing_limit: bool = False
    fail_on_high_severity: bool = False
    max_unresolved_adj_factor_jump: int | None = None
    max_missing_limit: int | None = None


def quality_gates(ratios: DataFrame, counts: DataFrame, scalars: DataFrame, params: GateParams) -> DataFrame:
    """One row per gate: (gate, observed, threshold, outcome) with outcome
    'failure', 'warning' or 'pass'.  Observed values are compared on the
    executors; only this handful of rows ever reaches a driver."""
    missing_limit_rows = scalars.where(F.col("metric") == "tradeability_missing_limit_rows").select(
        F.col("value").cast("double").alias("observed")
    )
    c = counts

    def row(gate: str, observed: DataFrame, threshold, fail_cond, warn_cond=None) -> DataFrame:
        th = F.lit(None).cast("double") if threshold is None else F.lit(float(threshold))
        outcome = F.when(fail_cond, F.lit("failure"))
        if warn_cond is not None:
            outcome = outcome.when(warn_cond, F.lit("warning"))
        return observed.select(F.lit(gate).alias("gate"), F.col("observed"), th.alias("threshold"),
                               outcome.otherwise(F.lit("pass")).alias("outcome"))

    obs = F.col("observed")
    p = params
    rows = [
        row("min_official_ratio", ratios.select(F.col("official_ratio").alias("observed")), p.min_official_ratio,
            F.lit(p.min_official_ratio is not None) & (obs < F.lit(p.min_official_ratio if p.min_official_ratio is not None else 0.0))),
        row("missing_limit_rows", missing_limit_rows, None,
            F.lit(p.fail_on_missing_limit) & (obs > 0), (obs > 0)),
        row("incomplete_trading_date_count", c.select(F.col("incomplete_trading_date_count").cast("double").alias("observed")), None,
            F.lit(False), obs > 0),
        row("high_issue_count", c.select(F.col("high_issue_count").cast("double").alias("observed")), None,
            F.lit(p.fail_on_high_severity) & (obs > 0)),
        row("max_unresolved_adj_factor_jump", c.select(F.col("unresolved_adj_factor_jump_count").cast("double").alias("observed")),
            p.max_unresolved_adj_factor_jump,
            F.lit(p.max_unresolved_adj_factor_jump is not None) & (obs > F.lit(float(p.max_unresolved_adj_factor_jump or 0)))),
        row("max_missing_limit", c.select(F.col("missing_limit_count").cast("double").alias("observed")), p.max_missing_limit,
            F.lit(p.max_missing_limit is not None) & (obs > F.lit(float(p.max_missing_limit or 0)))),
    ]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


def promotion_state(missing_tables: list[str], unresolved_rows: DataFrame) -> DataFrame:
    """blocked_unassessable / blocked_unresolved_adj_factor_jumps / pass."""
    if missing_tables:
        return unresolved_rows.select(F.lit("blocked_unassessable").alias("promotion_blocking_quality_state"))
    return unresolved_rows.select(
        F.when(F.col("unresolved_rows") > 0, F.lit("blocked_unresolved_adj_factor_jumps")).otherwise(F.lit("pass"))
        .alias("promotion_blocking_quality_state")
    )


# -------------------------------------------------------------- extracts
def bad_dates(flags: DataFrame) -> DataFrame:
    """Dates flagged incomplete."""
    return flags.where(F.col("issue_type") == "INCOMPLETE_TRADING_DATE").select("trade_date", "issue_type", "issue_severity").distinct()


def bad_symbols(flags: DataFrame) -> DataFrame:
    """Securities with symbol-level issues."""
    return flags.where(F.col("issue_type").isin("MISSING_LIMIT", "UNRESOLVED_ADJ_FACTOR_JUMP", "MISSING_INDUSTRY_CODE")).select(
        "code", "issue_type", "issue_severity"
    ).distinct()


def execution_restricted(flags: DataFrame) -> DataFrame:
    """Every execution-restricted flag row."""
    return flags.where(F.col("execution_restricted"))
