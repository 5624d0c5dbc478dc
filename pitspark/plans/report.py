"""The quality report (C7, A7-A14, T1, S18): every section from one aggregate a table, as rows, JSON or Markdown.

One pass over the flags counts them by issue; the twelve issue counters follow from those few rows, since an issue's
rule says what it allows.  One GROUPING SETS pass over the unresolved jumps gives their totals and the breakdowns by year, size,
security, dividend proximity and triage class.  One pass over the tradeability states and one over the bars give the
remaining scalars.  The report has a bounded number of rows (years, classes and ``TOP_SECURITIES`` securities), in a fixed
order: section, position.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.market import PROXIMITY_ORDER, TRIAGE_ORDER, magnitude_bucket, magnitude_order, ordinal
from . import quality

SECTIONS = ("state", "missing_tables", "summary", "years", "magnitude_buckets", "dividend_proximity", "triage", "top_securities", "warnings", "failures")
COLUMNS = ("section", "position", "key", "text", "number", "rows", "securities", "earliest_date", "latest_date")
# Tables that the report needs, columns by which jumps can be assessed, promotion states.
QUALITY_TABLES = ("daily_bar_pit", "corporate_action_ledger", "tradeability_state_daily")
JUMP_COLUMNS = {"security_id", "trade_date", "price_basis", "close", "adj_factor"}
ACTION_DATES = {"ex_date", "book_date", "action_date"}
BLOCKED_TABLES, BLOCKED_JUMPS, FREE = "blocked_unassessable", "blocked_unresolved_adj_factor_jumps", "pass"


@dataclass(frozen=True)
class ReportInputs:
    """Tables of a report; an absent one is None."""

    bars: DataFrame | None
    ledger: DataFrame | None
    tradeability: DataFrame | None
    flags: DataFrame | None
    jumps: DataFrame | None  # classified jumps with their context (``quality.context_of``) and has_explaining_corporate_action


def _rows(df: DataFrame, section: Column | str, key: Column | str, position: Column | int = 0, **values: Column) -> DataFrame:
    kinds = {"position": "bigint", "key": "string", "text": "string", "number": "double", "rows": "bigint", "securities": "bigint", "earliest_date": "date", "latest_date": "date"}
    given = {"key": F.lit(key) if isinstance(key, str) else key, "position": F.lit(position) if isinstance(position, int) else position, **values}
    return df.select((F.lit(section) if isinstance(section, str) else section).alias("section"), *[given.get(c, F.lit(None)).cast(kinds[c]).alias(c) for c in COLUMNS[1:]])


def _one(spark: SparkSession) -> DataFrame:
    return spark.range(1)


def _counters(flags: DataFrame) -> DataFrame:
    """The twelve issue counters from one count by issue."""
    by_issue = flags.groupBy("issue_type", *quality.RULE_FIELDS).agg(F.count(F.lit(1)).alias("n"))  # a row for each issue
    sums = [F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0)).alias(name) for name, cond in quality.issue_count_conditions()]
    return by_issue.agg(*sums)


def _scalars(one_row: DataFrame) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(c).alias("key"), F.col(c).cast("double").alias("number")) for c in one_row.columns])
    return one_row.select(F.explode(pairs).alias("x")).select("x.*")


def _jump_sections(jumps: DataFrame, top: int) -> tuple[DataFrame, DataFrame]:
    """Totals of all jumps, and breakdowns of the unresolved ones, from one pass over the jumps."""
    change = F.abs(F.col("factor_ratio") - 1.0)
    tagged = jumps.select(
        "security_id", "trade_date", "has_explaining_corporate_action", F.date_format("trade_date", "yyyy").alias("year"),
        magnitude_bucket(change).alias("bucket"), magnitude_order(change).alias("bucket_order"), "dividend_proximity_bucket", "triage_class",
    )
    sets = {"years": "year", "magnitude_buckets": "bucket", "dividend_proximity": "dividend_proximity_bucket", "triage": "triage_class", "top_securities": "security_id"}
    grouped = tagged.groupingSets([["has_explaining_corporate_action"], *[["has_explaining_corporate_action", c] for c in sets.values()]], "has_explaining_corporate_action", *sets.values())
    facts = grouped.agg(
        F.grouping_id().alias("_set"), F.count(F.lit(1)).alias("rows"), F.countDistinct(tagged["security_id"]).alias("securities"),
        F.min("trade_date").alias("earliest_date"), F.max("trade_date").alias("latest_date"), F.min("bucket_order").alias("bucket_order"),
    )
    width = len(sets)
    full = (1 << width) - 1
    totals = facts.where(F.col("_set") == full).select("has_explaining_corporate_action", "rows")
    open_ = facts.where(~F.col("has_explaining_corporate_action"))
    order = {
        "years": F.col("year").cast("bigint"), "magnitude_buckets": F.col("bucket_order").cast("bigint"),
        "dividend_proximity": ordinal(F.col("dividend_proximity_bucket"), PROXIMITY_ORDER).cast("bigint"),
        "triage": ordinal(F.col("triage_class"), TRIAGE_ORDER).cast("bigint"), "top_securities": F.lit(0).cast("bigint"),
    }
    section = key = position = None
    for nth, (name, column) in enumerate(sets.items()):
        here = F.col("_set") == full - (1 << (width - 1 - nth))
        section = F.when(here, name) if section is None else section.when(here, name)
        key = F.when(here, F.col(column)) if key is None else key.when(here, F.col(column))
        position = F.when(here, order[name]) if position is None else position.when(here, order[name])
    parts = open_.where(F.col("_set") != full).select(section.alias("section"), position.alias("at"), key.alias("key"), "rows", "securities", "earliest_date", "latest_date")
    # Within a section by its own order, securities by rows; ranks beyond the top-n report are left out of that section only.
    rank = Window.partitionBy("section").orderBy("at", F.when(F.col("section") == "top_securities", -F.col("rows")).otherwise(0), "key")
    ranked = parts.withColumn("position", F.row_number().over(rank).cast("bigint")).where((F.col("section") != "top_securities") | (F.col("position") <= top))
    return totals, ranked


def assessable(bars: DataFrame | None, ledger: DataFrame | None) -> bool:
    """Whether factor jumps can be judged from the tables' columns."""
    return bars is not None and ledger is not None and JUMP_COLUMNS <= set(bars.columns) and "security_id" in ledger.columns and bool(ACTION_DATES & set(ledger.columns))


def quality_report(spark: SparkSession, tables: ReportInputs, params: quality.GateParams, top: int = quality.TOP_SECURITIES) -> DataFrame:
    """The report as rows of ``COLUMNS``; sections without content have no rows."""
    named = {"daily_bar_pit": tables.bars, "corporate_action_ledger": tables.ledger, "tradeability_state_daily": tables.tradeability}
    missing = [t for t in QUALITY_TABLES if named[t] is None]
    scalars = []
    if tables.bars is not None:
        gone = F.lit(False)
        for c in ("open", "high", "low", "close"):
            gone = gone | (F.col(c).isNull() if c in tables.bars.columns else F.lit(True))
        scalars.append(_scalars(tables.bars.agg(
            F.count(F.lit(1)).alias("daily_bar_rows"), F.count_if(F.col("price_basis") == "qfq_fallback").alias("qfq_fallback_rows"),
            F.count_if(gone).alias("missing_price_rows"), F.count_if(F.col("adj_factor").isNull() | (F.col("adj_factor") <= 0.0)).alias("zero_or_missing_adj_factor_rows"))))
    if tables.ledger is not None:
        scalars.append(_scalars(tables.ledger.agg(F.count(F.lit(1)).alias("corporate_action_rows"))))
    if tables.tradeability is not None:
        n = F.count(F.lit(1))
        official, fallback = (F.count_if(F.col("source_priority") == s) for s in ("official", "ohlc_fallback"))
        share = lambda c: F.when(n > 0, c / n).otherwise(F.lit(0.0))
        scalars.append(_scalars(tables.tradeability.agg(
            n.alias("tradeability_rows"), official.alias("tradeability_official_rows"), fallback.alias("tradeability_ohlc_fallback_rows"),
            F.count_if(F.col("up_limit").isNull() | F.col("down_limit").isNull()).alias("tradeability_missing_limit_rows"),
            F.count_if(F.col("is_suspended").isNull()).alias("tradeability_missing_suspend_rows"),
            share(official).alias("official_ratio"), share(fallback).alias("fallback_ratio"))))
    if tables.flags is not None:
        scalars.append(_scalars(_counters(tables.flags)))
    parts = [_rows(_one(spark), "missing_tables", t, k) for k, t in enumerate(missing, 1)]
    parts.append(_rows(_one(spark), "state", "adj_factor_jump_assessable", 1, text=F.lit(str(assessable(tables.bars, tables.ledger)).lower())))
    if tables.jumps is not None:
        totals, sections = _jump_sections(tables.jumps, top)
        explained = F.col("has_explaining_corporate_action")
        total = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("rows"))), F.lit(0))
        sums = totals.agg(total(F.lit(True)).alias("adj_factor_jump_rows"), total(explained).alias("explained_adj_factor_jump_rows"), total(~explained).alias("unresolved_adj_factor_jump_rows"))
        scalars.append(_scalars(sums))
        parts.append(_rows(sections, F.col("section"), F.col("key"), F.col("position"), **{c: F.col(c) for c in ("rows", "securities", "earliest_date", "latest_date")}))
    summary = None
    for s in scalars:
        summary = s if summary is None else summary.unionByName(s)
    if summary is not None:
        # a few dozen rows: checked against the gates, and numbered by name
        numbered = summary.withColumn("position", F.row_number().over(Window.partitionBy(F.lit("summary")).orderBy("key")))
        parts.append(_rows(numbered, "summary", F.col("key"), F.col("position"), number=F.col("number")))
        parts.append(_verdicts(summary, params))
    blocked = _rows(_one(spark), "state", "promotion_blocking_quality_state", 2, text=F.lit(BLOCKED_TABLES))
    if not missing:
        open_rows = summary.where("key = 'unresolved_adj_factor_jump_rows'").agg(F.coalesce(F.max("number"), F.lit(0.0)).alias("n"))
        blocked = _rows(open_rows, "state", "promotion_blocking_quality_state", 2, text=F.when(F.col("n") > 0, BLOCKED_JUMPS).otherwise(FREE))
    parts.append(blocked)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _verdicts(summary: DataFrame, p: quality.GateParams) -> DataFrame:
    """Warnings and failures of the gates."""
    key, value = F.col("key"), F.col("number")
    whole = value.cast("bigint").cast("string")
    said = lambda name: F.concat(F.lit(f"{name}="), whole)
    ways: list[tuple[str, int, Column, Column]] = []  # section, position, condition, text
    if p.min_official_ratio is not None:
        ways.append(("failures", 1, (key == "official_ratio") & (value < p.min_official_ratio), F.concat(F.lit("official_ratio "), F.format_string("%.6f", value), F.lit(f" below min_official_ratio {p.min_official_ratio:.6f}"))))
    ways.append(("failures" if p.fail_on_missing_limit else "warnings", 2, (key == "tradeability_missing_limit_rows") & (value > 0), said("tradeability_missing_limit_rows")))
    ways.append(("warnings", 3, (key == "incomplete_trading_date_count") & (value > 0), said("incomplete_trading_date_count")))
    if p.fail_on_high_severity:
        ways.append(("failures", 4, (key == "high_issue_count") & (value > 0), said("high_issue_count")))
    for nth, (name, most) in enumerate((("unresolved_adj_factor_jump_count", p.max_unresolved_adj_factor_jump), ("missing_limit_count", p.max_missing_limit)), 5):
        if most is not None:
            ways.append(("failures", nth, (key == name) & (value > most), F.concat(said(name), F.lit(f" exceeds {most}"))))
    found = [F.when(cond, F.struct(F.lit(s).alias("section"), F.lit(n).cast("bigint").alias("position"), text.alias("text"))) for s, n, cond, text in ways]
    hits = summary.select("key", F.explode(F.array_compact(F.array(*found))).alias("x"))
    return _rows(hits, F.col("x.section"), F.col("key"), F.col("x.position"), text=F.col("x.text"))


def _ordered(report: DataFrame) -> list:
    """The report's rows in order: bounded by years, classes and the top-n section."""
    rank = {name: k for k, name in enumerate(SECTIONS)}
    return sorted(report.collect(), key=lambda r: (rank[r["section"]], r["position"], r["key"]))


def as_json(report: DataFrame) -> str:
    """The report as one JSON object, a list of entries for each section in order."""
    out: dict[str, list] = {name: [] for name in SECTIONS}
    for r in _ordered(report):
        fields = {c: r[c] for c in COLUMNS[2:] if r[c] is not None}
        out[r["section"]].append({c: v.strftime("%Y%m%d") if hasattr(v, "strftime") else v for c, v in fields.items()})
    return json.dumps(out, ensure_ascii=False, indent=2)


def as_markdown(report: DataFrame) -> str:
    """The report as Markdown, a table for each section that has rows."""
    lines, rows = ["# Market data quality"], _ordered(report)
    for name in SECTIONS:
        mine = [r for r in rows if r["section"] == name]
        columns = [c for c in COLUMNS[2:] if any(r[c] is not None for r in mine)]
        if mine:
            text = lambda v: "" if v is None else v.strftime("%Y%m%d") if hasattr(v, "strftime") else f"{v:g}" if isinstance(v, float) else str(v)
            lines += ["", f"## {name}", "", "| " + " | ".join(columns) + " |", "|" + " --- |" * len(columns)]
            lines += ["| " + " | ".join(text(r[c]) for c in columns) + " |" for r in mine]
    return "\n".join(lines) + "\n"
