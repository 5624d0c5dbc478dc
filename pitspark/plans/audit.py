"""Raw-data audit, dataset registry, inventory and contract checks
(C8, C9, A4, A16, A17, P17).

Every check is a one-row aggregate over the whole table (no sampling), so
the result is deterministic; the checks are unioned into one small frame and
only that frame is ever shown to a caller.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import parse_date_key
from .normalized import CONTRACT_COLUMNS

CHECK_COLUMNS = ["check_id", "severity", "result", "observed", "details"]
YEAR_COLUMNS = ("trade_date", "end_date", "ann_date", "cal_date")


@dataclass(frozen=True)
class AuditCheck:
    check_id: str
    severity: str
    run: Callable[[Mapping[str, DataFrame]], DataFrame]


def _row(df: DataFrame, check_id: str, severity: F.Column | str, result: F.Column, observed: F.Column, details: F.Column) -> DataFrame:
    sev = F.lit(severity) if isinstance(severity, str) else severity
    return df.select(F.lit(check_id).alias("check_id"), sev.alias("severity"), result.alias("result"),
                     observed.cast("bigint").alias("observed"), details.alias("details"))


def _skip(spark_df_source: Mapping[str, DataFrame], check_id: str, severity: str, details: str) -> DataFrame:
    any_df = next(iter(spark_df_source.values()))
    one = any_df.sparkSession.range(1)
    return _row(one, check_id, severity, F.lit("skip" if severity == "blocking" else "pass"), F.lit(None), F.lit(details))


def check_pit_leak(t: Mapping[str, DataFrame]) -> DataFrame:
    """Announcements dated after their period end (full scan)."""
    df = t.get("pit_fina_indicator")
    if df is None:
        return _skip(t, "pit_leak_sample", "blocking", "pit_fina_indicator table absent; skipping PIT leak check.")
    ann, end = parse_date_key("ann_date"), parse_date_key("end_date")
    a = df.agg(F.count(F.lit(1)).alias("n"), F.count_if(ann.isNotNull() & end.isNotNull() & (ann > end)).alias("bad"))
    return _row(
        a, "pit_leak_sample",
        F.when(F.col("n") == 0, F.lit("advisory")).otherwise(F.lit("blocking")),
        F.when((F.col("n") > 0) & (F.col("bad") > 0), F.lit("fail")).otherwise(F.lit("pass")),
        F.col("bad"),
        F.concat(F.lit("rows="), F.col("n").cast("string"), F.lit("; ann_date>end_date rows="), F.col("bad").cast("string")),
    )


def check_adj_factor(t: Mapping[str, DataFrame]) -> DataFrame:
    """Adjustment factors <= 0 (full scan)."""
    df = t.get("raw_adj_factor")
    if df is None or t.get("raw_kline_unadj") is None:
        return _skip(t, "adj_factor_consistency", "blocking", "raw_kline_unadj or raw_adj_factor absent; skipping consistency check.")
    a = df.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("adj_factor") <= 0.0).alias("bad"))
    return _row(
        a, "adj_factor_consistency",
        F.when(F.col("n") == 0, F.lit("advisory")).otherwise(F.lit("blocking")),
        F.when((F.col("n") > 0) & (F.col("bad") > 0), F.lit("fail")).otherwise(F.lit("pass")),
        F.col("bad"),
        F.concat(F.lit("rows="), F.col("n").cast("string"), F.lit("; adj_factor<=0 rows="), F.col("bad").cast("string")),
    )


def check_calendar_coverage(t: Mapping[str, DataFrame]) -> DataFrame:
    """Distinct bar days outside the calendar's [min, max] (range only)."""
    cal, bars = t.get("raw_trade_cal"), t.get("raw_kline_unadj")
    if cal is None:
        return _skip(t, "trade_calendar_coverage", "advisory", "raw_trade_cal absent; skipping calendar coverage check.")
    if bars is None:
        return _skip(t, "trade_calendar_coverage", "advisory", "raw_kline_unadj absent; calendar exists but no kline data to verify.")
    # the span is three single values: scalar subqueries, so the bars are not joined with anything
    n, lo, hi = (cal.agg(f.alias("v")).scalar() for f in (F.count(F.lit(1)), F.min("cal_date"), F.max("cal_date")))
    days = bars.select("trade_date").distinct()
    days = days.withColumn("_out", (F.col("trade_date") < lo) | (F.col("trade_date") > hi))
    j = days.agg(F.count_if("_out").alias("bad"), F.count("trade_date").alias("days"))
    j = j.select("bad", "days", n.alias("n"), lo.alias("lo"), hi.alias("hi"))
    return _row(
        j, "trade_calendar_coverage",
        F.when(F.col("n") == 0, F.lit("advisory")).otherwise(F.lit("blocking")),
        F.when((F.col("n") > 0) & (F.col("bad") > 0), F.lit("fail")).otherwise(F.lit("pass")),
        F.col("bad"),
        F.concat(F.lit("bar days="), F.col("days").cast("string"), F.lit("; outside ["), F.col("lo"), F.lit(", "),
                 F.col("hi"), F.lit("]="), F.col("bad").cast("string")),
    )


def year_column(df: DataFrame) -> str | None:
    return next((c for c in YEAR_COLUMNS if c in df.columns), None)


def rows_per_year(t: Mapping[str, DataFrame]) -> DataFrame | None:
    """Rows per year of every raw_*/pit_* table, by its first date column."""
    out = None
    for name in sorted(t):
        df = t[name]
        if not (name.startswith("raw_") or name.startswith("pit_")):
            continue
        col = year_column(df)
        if col is None:
            continue
        c = F.col(col).cast("string")
        part = (
            df.where(c.isNotNull() & (c != ""))
            .groupBy(F.substring(c, 1, 4).alias("year"))
            .agg(F.count(F.lit(1)).alias("rows"))
            .select(F.lit(name).alias("table_name"), F.lit(col).alias("date_column"), "year", "rows")
        )
        out = part if out is None else out.unionByName(part)
    return out


def check_missingness(t: Mapping[str, DataFrame]) -> DataFrame:
    """C9d: the table with the fewest rows in any year (advisory)."""
    per_year = rows_per_year(t)
    if per_year is None:
        return _skip(t, "missingness_by_year", "advisory", "No raw_* tables found.")
    worst = per_year.groupBy("table_name").agg(F.min("rows").alias("min_rows")).agg(
        F.min_by("table_name", F.struct("min_rows", "table_name")).alias("worst"), F.min("min_rows").alias("min_rows")
    )
    return _row(worst, "missingness_by_year", "advisory", F.lit("pass"), F.col("min_rows"),
                F.concat(F.lit("Table with fewest rows/year: "), F.col("worst"), F.lit(" ("), F.col("min_rows").cast("string"), F.lit(")")))


def check_survivorship(t: Mapping[str, DataFrame]) -> DataFrame:
    """C9e: delisted names present (advisory, never fails)."""
    df = t.get("stock_basic_ref")
    if df is None:
        return _skip(t, "survivorship_delisted_present", "advisory", "stock_basic_ref absent; skipping survivorship check.")
    a = df.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("delist_date").isNotNull() & (F.col("delist_date") != "")).alias("d"))
    return _row(a, "survivorship_delisted_present", "advisory", F.lit("pass"), F.col("d"),
                F.concat(F.col("d").cast("string"), F.lit("/"), F.col("n").cast("string"), F.lit(" rows have delist_date set")))


def _coverage(table: str, check_id: str) -> Callable[[Mapping[str, DataFrame]], DataFrame]:
    def run(t: Mapping[str, DataFrame]) -> DataFrame:
        df = t.get(table)
        if df is None:
            return _skip(t, check_id, "advisory", f"{table} absent.")
        a = df.agg(F.count(F.lit(1)).alias("n"))
        return _row(a, check_id, "advisory", F.lit("pass"), F.col("n"), F.concat(F.lit(f"{table} has "), F.col("n").cast("string"), F.lit(" row(s)")))

    return run


AUDIT_REGISTRY: list[AuditCheck] = [
    AuditCheck("pit_leak_sample", "blocking", check_pit_leak),
    AuditCheck("adj_factor_consistency", "blocking", check_adj_factor),
    AuditCheck("trade_calendar_coverage", "blocking", check_calendar_coverage),
    AuditCheck("missingness_by_year", "advisory", check_missingness),
    AuditCheck("survivorship_delisted_present", "advisory", check_survivorship),
    AuditCheck("suspend_coverage", "advisory", _coverage("raw_suspend_d", "suspend_coverage")),
    AuditCheck("stk_limit_coverage", "advisory", _coverage("raw_stk_limit", "stk_limit_coverage")),
]
DEFAULT_BLOCKING = ("pit_leak_sample", "adj_factor_consistency", "trade_calendar_coverage")


def run_audit(tables: Mapping[str, DataFrame], checks: list[str] | None = None) -> DataFrame:
    """Run the registered checks (all when ``checks`` is None)."""
    selected = [c for c in AUDIT_REGISTRY if checks is None or c.check_id in checks]
    out = None
    for c in selected:
        part = c.run(tables)
        out = part if out is None else out.unionByName(part)
    return out


def audit_blocked(audit: DataFrame, blocking: tuple[str, ...] | None = None) -> DataFrame:
    """One-row verdict: any failing check among the blocking ones.  ``None``
    means the default set; an empty tuple means no blocking checks."""
    ids = DEFAULT_BLOCKING if blocking is None else blocking
    return audit.agg(F.count_if(F.col("check_id").isin(*ids) & (F.col("result") == "fail")).alias("blocking_failures")).select(
        (F.col("blocking_failures") > 0).alias("blocked"), "blocking_failures"
    )


# ----------------------------------------------------------- inventory
RAW_TABLE_NAMES = {"stock_basic_ref"}
RESEARCH_TABLE_NAMES = {"security_master_ref", "industry_classification_static", "name_change_history",
                        "market_trade_calendar", "daily_bar_pit", "fundamental_snapshot_pit", "corporate_action_ledger",
                        "corporate_action_exception_ledger", "tradeability_state_daily", "stock_bar_normalized_daily"}


def layer_of(table_name: F.Column, schema_name: F.Column | None = None) -> F.Column:
    """Meta / raw / research / audit / other by name (first match wins)."""
    meta = schema_name == "meta" if schema_name is not None else F.lit(False)
    return (
        F.when(meta, F.lit("meta"))
        .when(table_name.isin(*RAW_TABLE_NAMES) | table_name.startswith("raw_"), F.lit("raw"))
        .when(table_name.isin(*RESEARCH_TABLE_NAMES) | table_name.endswith("_pit"), F.lit("research"))
        .when(table_name.contains("audit") | table_name.contains("quality"), F.lit("audit"))
        .otherwise(F.lit("other"))
    )


def table_inventory(tables: Mapping[str, DataFrame], with_types: bool = False) -> DataFrame:
    """Rows, columns (and optionally the name:type list) per table."""
    out = None
    for name in sorted(tables):
        df = tables[name]
        cols = [F.lit(name).alias("table_name"), layer_of(F.lit(name)).alias("layer"), F.col("row_count"),
                F.lit(len(df.columns)).cast("bigint").alias("column_count")]
        if with_types:
            cols.append(F.lit(", ".join(f"{f.name}:{f.dataType.simpleString()}" for f in df.schema.fields)).alias("columns"))
        part = df.agg(F.count(F.lit(1)).alias("row_count")).select(*cols)
        out = part if out is None else out.unionByName(part)
    return out


def dataset_registry(entries: list[tuple[str, str, DataFrame | None, F.Column | None, F.Column | None]]) -> DataFrame:
    """A4: (dataset_id, status, row_count, earliest_date, latest_date) per built
    dataset; ``status`` 'amber-if-rows' turns amber when the table has rows."""
    out = None
    for dataset_id, status, df, lo, hi in entries:
        if df is None:
            continue
        a = df.agg(
            F.count(F.lit(1)).alias("row_count"),
            (F.min(lo) if lo is not None else F.lit(None).cast("date")).alias("earliest_date"),
            (F.max(hi) if hi is not None else F.lit(None).cast("date")).alias("latest_date"),
        )
        st = (F.when(F.col("row_count") == 0, F.lit("green")).otherwise(F.lit("amber"))
              if status == "amber-if-rows" else F.lit(status))
        part = a.select(F.lit(dataset_id).alias("dataset_id"), st.alias("status"), "row_count", "earliest_date", "latest_date")
        out = part if out is None else out.unionByName(part)
    return out


def contract_check(tables: Mapping[str, DataFrame], required_tables: tuple[str, ...] = (
        "stock_bar_normalized_daily", "daily_bar_pit", "tradeability_state_daily")) -> list[tuple[str, str, str]]:
    """Required tables and the ordered 16 contract columns.

    A metadata check on schemas only (no data is read).  Only a missing
    ``industry_name`` (with ``industry_code`` present) is a warning.
    """
    out: list[tuple[str, str, str]] = []
    for t in required_tables:
        out.append((f"table:{t}", "pass" if t in tables else "fail", "present" if t in tables else "missing"))
    bars = tables.get("stock_bar_normalized_daily")
    if bars is not None:
        cols = bars.columns
        missing = [c for c in CONTRACT_COLUMNS if c not in cols]
        if not missing:
            ordered = [c for c in cols if c in CONTRACT_COLUMNS] == CONTRACT_COLUMNS
            out.append(("columns", "pass" if ordered else "fail", "ordered" if ordered else "order differs"))
        elif missing == ["industry_name"] and "industry_code" in cols:
            out.append(("columns", "warning", "industry_name missing"))
        else:
            out.append(("columns", "fail", "missing: " + ", ".join(missing)))
    return out
