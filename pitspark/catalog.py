"""Named queries over the driver tables (the keys of ``__spark_entry__.queries``).

Each entry takes ``(spark, sf_dir)`` and returns a lazy DataFrame whose dates
are rendered as yyyyMMdd text and timestamps as 'yyyy-MM-dd HH:mm:ss' text,
the public form of every dataset.
"""

from __future__ import annotations

import datetime
import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, LongType, ShortType, TimestampNTZType, TimestampType

from .plans import actions, normalized, quality, report, tradeability
from .plans.research import Research
from .session import checkpoint_dir, cut_lineage, partitions_for, shuffles_dropped

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
_BUILDS: dict[tuple[str, str], Research] = {}
_BUILD_ROWS: dict[tuple[str, str], int] = {}


def research_for(spark: SparkSession, sf_dir: str) -> Research:
    """One research build per (Spark application, input folder).

    Reused tables are stored under the session's checkpoint folder
    (``spark.checkpoint.dir``, which must be set), so every query of the session scans them instead of
    re-deriving the chain.  ``PITSPARK_STORE=0`` keeps everything lazy.
    """
    key = (spark.sparkContext.applicationId, os.path.realpath(sf_dir))
    build = _BUILDS.get(key)
    if key not in _BUILD_ROWS:
        _BUILD_ROWS[key] = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()  # from the files' footers
    partitions_for(spark, _BUILD_ROWS[key])
    if build is None:
        store = None
        if os.environ.get("PITSPARK_STORE", "1") != "0":
            base = checkpoint_dir(spark)
            store = f"{base.rstrip('/')}/research-{uuid.uuid4().hex[:12]}"
        build = Research.from_driver(spark, sf_dir, store=store)
        _BUILDS[key] = build
    return build


def render(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, DateType):
            cols.append(F.date_format(F.col(f.name), "yyyyMMdd").alias(f.name))
        elif isinstance(f.dataType, (TimestampType, TimestampNTZType)):
            cols.append(F.date_format(F.col(f.name), "yyyy-MM-dd HH:mm:ss").alias(f.name))
        elif isinstance(f.dataType, (IntegerType, ShortType)):
            cols.append(F.col(f.name).cast(LongType()).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def query(name: str):
    def deco(fn: Callable[[Research], DataFrame]) -> Callable[[Research], DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return render(fn(research_for(spark, sf_dir)))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return fn

    return deco


# ------------------------------------------------------------ dimensions
@query("security_master")
def _security_master(r: Research) -> DataFrame:
    """A-share security master."""
    return r.security_master


@query("board_counts")
def _board_counts(r: Research) -> DataFrame:
    """Securities per board and exchange."""
    return r.security_master.groupBy("board", "exchange").agg(F.count(F.lit(1)).alias("securities"))


@query("static_industry")
def _static_industry(r: Research) -> DataFrame:
    return r.industry_static


@query("trade_calendar")
def _trade_calendar(r: Research) -> DataFrame:
    return r.trade_calendar


@query("name_st_windows")
def _names(r: Research) -> DataFrame:
    """Name history with the ST flag."""
    return r.name_change_history.drop("source_table", "ingested_at")


@query("st_daily")
def _st_daily(r: Research) -> DataFrame:
    """Calendar days inside ST windows."""
    return r.st_daily


# ------------------------------------------------------------------ bars
@query("daily_bar_pit")
def _daily_bar_pit(r: Research) -> DataFrame:
    return r.daily_bar_pit


@query("adjusted_prices")
def _adjusted(r: Research) -> DataFrame:
    """Price basis, adjusted OHLC and unit-normalised size columns."""
    return r.daily_bar_pit.select(
        "security_id", "trade_date", "price_basis", "open_adj", "high_adj", "low_adj", "close_adj",
        "adjusted_price_source", "volume_shares", "turnover_value_cny", "total_shares", "total_mcap_cny",
    )


@query("fundamental_available_date")
def _fundamentals(r: Research) -> DataFrame:
    return r.fundamental_snapshot_pit


@query("industry_asof")
def _industry_asof(r: Research) -> DataFrame:
    """Every PIT industry row valid on each bar day."""
    return normalized.industry_matches(r.daily_bar_pit, r.industry_classification_pit)


@query("canonical_industry")
def _canonical(r: Research) -> DataFrame:
    return normalized.canonical_industry(normalized.industry_matches(r.daily_bar_pit, r.industry_classification_pit))


@query("limit_merge_latest")
def _limit_merge(r: Research) -> DataFrame:
    """Both limit sources merged, latest ingest wins."""
    return r.raw_stk_limit


@query("suspend_key")
def _suspend_key(r: Research) -> DataFrame:
    return tradeability.suspend_key(r.raw_suspend_d)


@query("limit_key")
def _limit_key(r: Research) -> DataFrame:
    return tradeability.limit_key(r.raw_stk_limit).drop("has_limit_row")


@query("tradeability_state")
def _tradeability(r: Research) -> DataFrame:
    return r.tradeability_state_daily


@query("normalized_bars")
def _normalized(r: Research) -> DataFrame:
    """The 16-column consumer contract."""
    return r.stock_bar_normalized_daily


@query("prev_close")
def _prev_close(r: Research) -> DataFrame:
    """Previous normalized close per bar."""
    return r.daily_bar_pit.select("security_id", "trade_date", "close_adj", normalized.previous_close(r.daily_bar_pit).alias("prev_close"))


@query("index_bars")
def _index_bars(r: Research) -> DataFrame:
    return r.index_daily_bar_pit


# --------------------------------------------------------------- actions
@query("action_rows")
def _action_rows(r: Research) -> DataFrame:
    return actions.action_rows(r.raw_dividend).select(*actions.LEDGER_COLUMNS)


@query("adj_jumps")
def _adj_jumps(r: Research) -> DataFrame:
    """Significant adjustment-factor jumps."""
    return r.jump_facts.select(*actions.JUMP_COLUMNS)


@query("unexplained_jumps")
def _unexplained(r: Research) -> DataFrame:
    """Jumps no dividend action explains."""
    return r.jump_facts.where(~F.col("has_action")).select("security_id", "previous_trade_date", "trade_date", "factor_ratio")


@query("explained_flag")
def _explained_flag(r: Research) -> DataFrame:
    """Explained-by-ledger flag on every jump."""
    return r.classified_jumps.select("security_id", "trade_date", "has_explaining_corporate_action")


@query("nearest_dividend")
def _nearest(r: Research) -> DataFrame:
    """Nearest implemented dividend distance per jump."""
    return r.jump_facts.select("security_id", "trade_date", F.col("nearest_days").alias("nearest_implemented_dividend_days"))


@query("suspend_in_window")
def _suspend_window(r: Research) -> DataFrame:
    """Suspension inside each jump window."""
    return r.jump_facts.select("security_id", "previous_trade_date", "trade_date", "has_suspend_window")


@query("inferred_repairs")
def _repairs(r: Research) -> DataFrame:
    return actions.repairs_of(r.jump_facts)


@query("corporate_action_ledger")
def _ledger(r: Research) -> DataFrame:
    return r.corporate_action_ledger


@query("exception_ledger")
def _exceptions(r: Research) -> DataFrame:
    return r.corporate_action_exception_ledger


# --------------------------------------------------------------- quality
GATES = quality.GateParams(min_official_ratio=0.5, fail_on_missing_limit=False, fail_on_high_severity=True,
                           max_unresolved_adj_factor_jump=100, max_missing_limit=1000)


@query("missing_limit")
def _missing_limit(r: Research) -> DataFrame:
    """P10: bars without complete official limits."""
    return quality.missing_limit_rows(r.tradeability_state_daily).select("security_id", "trade_date", "up_limit", "down_limit")


@query("missing_industry")
def _missing_industry(r: Research) -> DataFrame:
    return quality.missing_industry_rows(r.normalized_bars)


@query("incomplete_dates")
def _incomplete(r: Research) -> DataFrame:
    """W6 + J15: thin trading dates with their neighbours' counts."""
    return quality.incomplete_dates(r.normalized_bars)


@query("date_row_counts")
def _date_counts(r: Research) -> DataFrame:
    """Normalized rows per trading date with neighbour counts."""
    return quality.date_counts(r.normalized_bars)


@query("affected_window")
def _affected(r: Research) -> DataFrame:
    """60-bars-before / 10-bars-after window of every exception."""
    return quality.affected_windows(r.corporate_action_exception_ledger, r.daily_bar_pit)


@query("usability_flags")
def _flags(r: Research) -> DataFrame:
    """Usability flags (without the creation timestamp)."""
    return r.usability_flags.select(*quality.FLAG_COLUMNS)


@query("issue_counts")
def _issue_counts(r: Research) -> DataFrame:
    return quality.issue_counts(r.usability_flags)


@query("issue_counts_by_type")
def _issue_by_type(r: Research) -> DataFrame:
    return quality.issue_counts_by_type(r.usability_flags)


@query("quality_scalars")
def _scalars(r: Research) -> DataFrame:
    return quality.quality_scalars(r.daily_bar_pit, r.corporate_action_ledger, r.tradeability_state_daily)


@query("source_ratios")
def _ratios(r: Research) -> DataFrame:
    return quality.source_ratios(r.tradeability_state_daily)


@query("quality_gates")
def _gates(r: Research) -> DataFrame:
    """C7 with fixed gate parameters (see ``GATES``)."""
    scalars = quality.quality_scalars(r.daily_bar_pit, r.corporate_action_ledger, r.tradeability_state_daily)
    return quality.quality_gates(quality.source_ratios(r.tradeability_state_daily), quality.issue_counts(r.usability_flags),
                                 scalars, GATES)


@query("quality_report")
def _quality_report(r: Research) -> DataFrame:
    """The whole quality report as rows."""
    jumps = quality.context_of(r.classified_jumps)
    return report.quality_report(r.spark, report.ReportInputs(r.daily_bar_pit, r.corporate_action_ledger, r.tradeability_state_daily, r.usability_flags, jumps), GATES)


@query("jump_totals")
def _jump_totals(r: Research) -> DataFrame:
    return quality.jump_totals(r.classified_jumps)


@query("jump_years")
def _jump_years(r: Research) -> DataFrame:
    return quality.jump_years(r.unresolved_jumps)


@query("magnitude_summary")
def _magnitude(r: Research) -> DataFrame:
    return quality.magnitude_summary(r.unresolved_jumps)


@query("top_securities")
def _top(r: Research) -> DataFrame:
    return quality.top_securities(r.unresolved_jumps)


@query("dividend_proximity")
def _proximity(r: Research) -> DataFrame:
    return quality.dividend_proximity(r.unresolved_context)


@query("triage_summary")
def _triage(r: Research) -> DataFrame:
    return quality.triage_summary(r.unresolved_context)


@query("triage_no_dividend")
def _triage_nodiv(r: Research) -> DataFrame:
    return quality.triage_without_dividends(r.unresolved_jumps)


@query("nearest_dividend_row")
def _nearest_row(r: Research) -> DataFrame:
    """Nearest implemented dividend (date and days) per unresolved jump."""
    earlier = F.datediff("trade_date", "done_before") == F.col("nearest_days")  # a tie goes to the earlier one
    return r.unresolved_jumps.select("security_id", "trade_date", F.when(earlier, F.col("done_before")).otherwise(F.col("done_after")).alias("nearest_implemented_dividend_ex_date"),
                                     F.col("nearest_days").alias("nearest_implemented_dividend_days"))


@query("jump_examples")
def _examples(r: Research) -> DataFrame:
    return quality.jump_examples(r.unresolved_context)


@query("bad_dates")
def _bad_dates(r: Research) -> DataFrame:
    return quality.bad_dates(r.usability_flags)


@query("bad_symbols")
def _bad_symbols(r: Research) -> DataFrame:
    return quality.bad_symbols(r.usability_flags)


@query("execution_restricted")
def _restricted(r: Research) -> DataFrame:
    return quality.execution_restricted(r.usability_flags).select(*quality.FLAG_COLUMNS)


# ------------------------------------------------------- keyed writes
from .operators import keyed as _keyed  # noqa: E402
from .plans import audit as _audit, reference as _reference, registry as _registries  # noqa: E402
from .sources import feeds as _feeds  # noqa: E402

KLINE = ["ts_code", "trade_date", "open", "high", "low", "close", "pre_close", "change", "pct_chg", "vol", "amount", "source_table"]


@query("upsert_replace")
def _upsert(r: Research) -> DataFrame:
    """Feed A's bars replace the unadjusted bars with the same key."""
    target = r.src("raw_kline_unadj").select(*KLINE)
    batch = _feeds.normalize_feed_a(r.raw.feeds["feed_a"])
    return _keyed.upsert_replace(target, batch, ["ts_code", "trade_date"])


@query("append_dedup")
def _append(r: Research) -> DataFrame:
    """D3: limit rows of both sources appended, exact duplicates dropped."""
    cols = ["ts_code", "trade_date", "up_limit", "down_limit"]
    return _keyed.append_dedup(r.src("raw_stk_limit").select(*cols), r.raw.supplemental["raw_stk_limit"].select(*cols))


def _raw(r: Research, spec) -> tuple[str, DataFrame]:
    """A registered dataset's table, from the source or else the supplemental provider, and the name it is stored under."""
    side = "source" if spec.table in r.raw.source else "supplemental"
    return f"{side}/{spec.table}", (r.raw.source if side == "source" else r.raw.supplemental)[spec.table]


def _raw_profile(r: Research, spec, df: DataFrame):
    name, _ = _raw(r, spec)
    return r.profile(name, df, _registries.dataset_span(spec))


@query("high_water_mark")
def _hwm(r: Research) -> DataFrame:
    """Last value of every registered dataset's incremental axis, as its profile has it."""
    from .sources.schemas import DATASETS

    rows = [(s.dataset_id, s.axis, _raw_profile(r, s, _raw(r, s)[1]).last) for s in DATASETS.values()]
    return r.spark.createDataFrame(rows, "dataset_id string, axis string, last_date string")


PREVIOUS_SYNC_END = "20000101"
REQUESTED_SINCE = "19990601"


@query("incremental_filter")
def _incremental(r: Research) -> DataFrame:
    """Rows a sync would pull after a previous sync that ended before
    2000-01-01, never before the requested 1999-06-01."""
    df = r.src("raw_daily_basic").select("ts_code", "trade_date")
    from .functions.dates import parse_date_key

    d = df.withColumn("_d", parse_date_key("trade_date"))
    last = d.where(F.col("trade_date") < PREVIOUS_SYNC_END).agg(F.max("_d").alias("_last")).select(
        F.greatest(F.date_add("_last", 1), F.to_date(F.lit(REQUESTED_SINCE), "yyyyMMdd")).alias("_since"))
    # the mark is one value: a scalar subquery, so the filter runs inside the scan's stage and nothing is joined
    return d.where(F.col("_d") >= last.scalar()).select("ts_code", "trade_date")


@query("feed_a_normalize")
def _feed_a(r: Research) -> DataFrame:
    return _feeds.normalize_feed_a(r.raw.feeds["feed_a"])


@query("feed_b_normalize")
def _feed_b(r: Research) -> DataFrame:
    return _feeds.normalize_feed_b(r.raw.feeds["feed_b"])


@query("conform_fill")
def _conform_fill(r: Research) -> DataFrame:
    """A thin close-only frame conformed to the full daily layout."""
    thin = r.src("raw_kline_qfq").select("ts_code", "trade_date", "close")
    return _feeds.conform_to_dataset(thin, "daily", source_table="provider.thin").drop("ingested_at")


@query("event_normalize")
def _event_normalize(r: Research) -> DataFrame:
    return _feeds.normalize_suspend_events(r.raw.feeds["provider_suspend_d"])


@query("dividend_normalize")
def _dividend_normalize(r: Research) -> DataFrame:
    return _feeds.normalize_dividend_events(r.raw.feeds["provider_dividend"])


@query("limit_normalize")
def _limit_normalize(r: Research) -> DataFrame:
    return _feeds.normalize_limit_events(r.raw.feeds["provider_stk_limit"])


@query("share_float_normalize")
def _share_float_normalize(r: Research) -> DataFrame:
    return _feeds.normalize_share_float_events(r.raw.feeds["provider_share_float"])


@query("repurchase_normalize")
def _repurchase_normalize(r: Research) -> DataFrame:
    return _feeds.normalize_repurchase_events(r.raw.feeds["provider_repurchase"])


@query("share_float_events")
def _share_float(r: Research) -> DataFrame:
    """Shares set free, in the conformed layout."""
    return r.event("raw_share_float")


@query("repurchase_events")
def _repurchase(r: Research) -> DataFrame:
    """Repurchases, in the conformed layout."""
    return r.event("raw_repurchase")


@query("index_ingest")
def _index_ingest(r: Research) -> DataFrame:
    """Index bars delivered twice, ingested once."""
    d = r.raw.supplemental["raw_index_daily"]
    return _feeds.ingest_index_daily(d.unionByName(d))


@query("index_basic_latest")
def _index_basic_latest(r: Research) -> DataFrame:
    """A second delivery of index metadata overrides the first."""
    b = r.raw.supplemental["index_basic_ref"]
    first = b.withColumn("_order", F.lit(1))
    second = b.withColumn("name", F.upper("name")).withColumn("_order", F.lit(2))
    return _feeds.latest_per_key(first.unionByName(second), "ts_code", "_order")


@query("weight_ingest")
def _weights(r: Research) -> DataFrame:
    return _feeds.ingest_benchmark_weights(r.raw.supplemental["benchmark_weight_snapshot_pit"])


@query("membership_intervals")
def _membership(r: Research) -> DataFrame:
    """Benchmark membership intervals from monthly weight snapshots."""
    return _reference.membership_intervals(r.benchmark_weight_snapshot_pit)


@query("close_intervals")
def _close(r: Research) -> DataFrame:
    """W8 on the PIT industry rows."""
    rows = r.industry_classification_pit.select(*_reference.INTERVAL_COLUMNS)
    return _reference.close_industry_intervals(rows)


@query("industry_unpivot")
def _unpivot(r: Research) -> DataFrame:
    """Level codes of the membership feed as closed PIT intervals."""
    return _reference.industry_rows_from_members(r.src("raw_index_member_all"))


@query("staging_registry")
def _staging(r: Research) -> DataFrame:
    """A5: staged reference tables with row counts and date spans."""
    tables = {
        "industry_classification_pit": r.industry_classification_pit,
        "benchmark_membership_pit": _reference.membership_intervals(r.benchmark_weight_snapshot_pit),
        "benchmark_weight_snapshot_pit": r.benchmark_weight_snapshot_pit,
        "index_basic_ref": r.index_basic_ref,
        "raw_index_daily": r.raw_index_daily,
        **{t: getattr(r, t) for t in ("raw_dividend", "raw_stk_limit", "raw_suspend_d")},
        **{t: r.event(t) for t in ("raw_share_float", "raw_repurchase")},
    }
    return _registries.staging_registry(r.spark, {n: r.profile(f"staged/{n}", df, _registries.STAGED[n]) for n, df in tables.items() if df is not None})


# ----------------------------------------------------------------- audits
def _audit_tables(r: Research) -> dict[str, DataFrame]:
    return {k: r.src(k) for k in r.raw.source}


@query("raw_audit")
def _raw_audit(r: Research) -> DataFrame:
    """The seven raw-data checks over whole tables."""
    return _audit.run_audit(_audit_tables(r))


@query("rows_per_year")
def _rows_per_year(r: Research) -> DataFrame:
    return _audit.rows_per_year(_audit_tables(r))


@query("calendar_coverage")
def _calendar_coverage(r: Research) -> DataFrame:
    return _audit.check_calendar_coverage(_audit_tables(r))


@query("table_inventory")
def _inventory(r: Research) -> DataFrame:
    """Row and column counts of the research tables."""
    return _audit.table_inventory(_research_tables(r))


def _research_tables(r: Research) -> dict[str, DataFrame]:
    return {
        "security_master_ref": r.security_master, "industry_classification_static": r.industry_static,
        "name_change_history": r.name_change_history, "market_trade_calendar": r.trade_calendar,
        "daily_bar_pit": r.daily_bar_pit, "fundamental_snapshot_pit": r.fundamental_snapshot_pit,
        "corporate_action_ledger": r.corporate_action_ledger,
        "corporate_action_exception_ledger": r.corporate_action_exception_ledger,
        "tradeability_state_daily": r.tradeability_state_daily, "stock_bar_normalized_daily": r.stock_bar_normalized_daily,
        "industry_classification_pit": r.industry_classification_pit, "raw_dividend": r.raw_dividend,
        "raw_stk_limit": r.raw_stk_limit, "raw_suspend_d": r.raw_suspend_d,
    }


@query("membership_incremental")
def _membership_incremental(r: Research) -> DataFrame:
    """Membership kept as a state: the first snapshots, then the others year by year, each reading only itself and the open intervals."""
    weights = r.benchmark_weight_snapshot_pit
    year = F.year("trade_date")
    state = cut_lineage(_reference.membership_state(weights.where(year <= STATE_YEARS[0])))
    for since, until in zip(STATE_YEARS, [*STATE_YEARS[1:], 9999], strict=True):
        state = cut_lineage(_reference.extend_membership(state, weights.where((year > since) & (year <= until))))
    return state.select("benchmark_id", "security_id", "effective_at", "removed_at")


STATE_YEARS = [1995, 1996, 1998]


@query("contract_check")
def _contract(r: Research) -> DataFrame:
    """Contract checks; each verdict row carries the checked row count."""
    verdicts = _audit.contract_check(_research_tables(r))
    counted = r.stock_bar_normalized_daily.agg(F.count(F.lit(1)).alias("rows_checked"))
    out = None
    for check, status, detail in verdicts:
        part = counted.select(F.lit(check).alias("check"), F.lit(status).alias("status"), F.lit(detail).alias("detail"), "rows_checked")
        out = part if out is None else out.unionByName(part)
    return out


@query("dataset_registry")
def _registry(r: Research) -> DataFrame:
    """A4: built datasets with status, row count, span and note."""
    tables = {
        "daily_bar_pit": r.daily_bar_pit, "fundamental_snapshot_pit": r.fundamental_snapshot_pit, "industry_classification_static": r.industry_static,
        "market_trade_calendar": r.trade_calendar, "name_change_history": r.name_change_history, "security_master_ref": r.security_master,
        "corporate_action_ledger": r.corporate_action_ledger, "corporate_action_exception_ledger": r.corporate_action_exception_ledger,
        "tradeability_state_daily": r.tradeability_state_daily, "benchmark_weight_snapshot_pit": r.benchmark_weight_snapshot_pit,
        "industry_classification_pit": r.industry_classification_pit, "index_basic_ref": r.index_basic_ref, "index_daily_bar_pit": r.index_daily_bar_pit,
    }
    profiles = {e.dataset_id: r.profile(f"research/{e.dataset_id}", tables[e.dataset_id], e.span) for e in _registries.REGISTRY if tables[e.dataset_id] is not None}
    return _registries.dataset_registry(r.spark, profiles)


# --------------------------------------------------------------- streaming
TABLE_DIGITS = 4  # files of the bar table are cut by year
MONTH_DIGITS = 6  # or by month, where corrections come by month and would else touch every file


def _bar_table(r: Research, purpose: str, digits: int = TABLE_DIGITS):
    """The unadjusted bars as version 1 of a table of their own, and a landing folder beside it."""
    from .operators.versioned import VersionedTable
    from .streaming.ingest import date_partition

    root = f"{(r.store or checkpoint_dir(r.spark)).rstrip('/')}/{purpose}-{uuid.uuid4().hex[:12]}"
    bars = date_partition(r.src("raw_kline_unadj").select(*KLINE), digits)
    table = VersionedTable(r.spark, f"{root}/table", bars.schema, ["ts_code", "trade_date"], "part")
    table.replace(bars)
    return table, f"{root}/landing", f"{root}/checkpoint"


@query("stream_upsert")
def _stream_upsert(r: Research) -> DataFrame:
    """Feed A corrections streamed from a landing folder into the
    unadjusted-bar table with a keyed replace per micro-batch."""
    from .operators.versioned import by_key_range
    from .streaming.ingest import date_partition, start_keyed_ingest

    table, landing, checkpoint = _bar_table(r, "stream")
    corrections = date_partition(_feeds.normalize_feed_a(r.raw.feeds["feed_a"]), TABLE_DIGITS).withColumn("delivery", F.lit(1))
    by_key_range(corrections, "part", ["ts_code", "trade_date"]).write.partitionBy("part").parquet(landing)
    q = start_keyed_ingest(r.spark, landing=landing, schema=corrections.schema, table=table, checkpoint=checkpoint, max_files_per_trigger=32)
    q.awaitTermination()
    return table.read().drop("part")


LANDED_ROWS = 4_000_000  # of the largest delivery in one file: the micro-batches, which each cost some seconds, stay few


def bar_deliveries(bars: DataFrame) -> list[DataFrame]:
    """Three deliveries of the same feed: all bars; volume of days 1 to 10 in other units; days 8 to 12 without change columns."""
    day = F.substring("trade_date", 7, 2).cast("int")
    second = bars.where(day <= 10).withColumn("vol", F.col("vol") * 100.0)
    third = bars.where(day.between(8, 12)).withColumns({"change": F.lit(None).cast("double"), "pct_chg": F.lit(None).cast("double")})
    return [bars, second, third]


@query("stream_deliveries")
def _stream_deliveries(r: Research) -> DataFrame:
    """Overlapping deliveries that land in the wrong order; of each key the latest delivery stays."""
    from .operators.versioned import by_bounds
    from .streaming.ingest import date_partition, start_keyed_ingest

    table, landing, checkpoint = _bar_table(r, "deliveries")
    feed = date_partition(_feeds.normalize_feed_a(r.raw.feeds["feed_a"]), TABLE_DIGITS)
    bounds = table.bounds(8, LANDED_ROWS)
    schema = None
    for number, rows in reversed(list(enumerate(bar_deliveries(feed), 1))):
        landed = rows.withColumn("delivery", F.lit(number))
        with shuffles_dropped(r.spark):
            by_bounds(landed, "part", ["ts_code", "trade_date"], bounds).write.parquet(f"{landing}/arrived={number}")
        schema = landed.schema
    q = start_keyed_ingest(r.spark, landing=f"{landing}/*", schema=schema, table=table, checkpoint=checkpoint, max_files_per_trigger=8)
    q.awaitTermination()
    return table.read().drop("part")


@query("incremental_files")
def _incremental_files(r: Research) -> DataFrame:
    """Bars from the day after a previous run's mark on, read from the files of the years that reach it."""
    from .operators.keyed import effective_since

    table, _, _ = _bar_table(r, "incremental")
    last = table.read().where(F.col("trade_date") < PREVIOUS_SYNC_END).agg(F.max(F.to_date("trade_date", "yyyyMMdd"))).first()[0]
    since = effective_since(last, datetime.date(1999, 6, 1))
    mark = since.strftime("%Y%m%d")
    return table.read_since("trade_date", mark, mark[:TABLE_DIGITS]).drop("part")


@query("table_versions")
def _table_versions(r: Research) -> DataFrame:
    """What readers of each version of a table see: replaced, upserted, replayed, reset, appended without repeats."""
    from .streaming.ingest import date_partition

    table, _, _ = _bar_table(r, "versions", MONTH_DIGITS)
    corrections = date_partition(_feeds.normalize_feed_a(r.raw.feeds["feed_a"]), MONTH_DIGITS).where(F.substring("trade_date", 5, 2) == "03")
    table.upsert(corrections, delivery=1)
    table.upsert(corrections, delivery=1)  # a replay
    table.reset()
    table.replace(_keyed.append_dedup(table.read(1), corrections, table.deal), dealt=True)
    out = None
    for version, step in enumerate(["replace", "upsert", "replay", "reset", "append"], 1):
        seen = table.read(version).agg(F.lit(version).alias("version"), F.lit(step).alias("step"), F.count(F.lit(1)).alias("rows"),
                                       F.count_if(F.col("source_table") == "feed_a.daily").alias("corrected"),
                                       F.min("trade_date").alias("first_date"), F.max("trade_date").alias("last_date"))
        out = seen if out is None else out.unionByName(seen)
    return out


# ------------------------------------------------------- official industry
from .plans import industry as _industry  # noqa: E402

OFFICIAL = _industry.ImportParams(levels=("L1", "L2", "L3"), min_effective_date="19960221", cutover_date="19990730")


def _official(r: Research) -> _industry.OfficialImport:
    """One official import per research build (kept on the build)."""
    done = r.__dict__.get("_official_import")
    if done is None:
        f = r.raw.feeds
        done = _industry.official_industry_rows(f["official_ledger"], f["official_codes"], f["official_crosswalk"],
                                                f["official_snapshot"], OFFICIAL)
        r.__dict__["_official_import"] = done
    return done


@query("hierarchy_levels")
def _hier(r: Research) -> DataFrame:
    """Code table -> level codes."""
    return _industry.hierarchy_levels(r.raw.feeds["official_codes"])


@query("crosswalk_map")
def _cross(r: Research) -> DataFrame:
    """Old -> new level codes (unique mappings, section L1 fallback)."""
    return _industry.crosswalk_map(r.raw.feeds["official_crosswalk"], _industry.hierarchy_levels(r.raw.feeds["official_codes"]))


@query("cutover_anchors")
def _anchors(r: Research) -> DataFrame:
    """C14: anchor records for snapshot securities without a cutover-day record."""
    f = r.raw.feeds
    return _industry.cutover_anchors(_industry.snapshot_codes(f["official_snapshot"]),
                                     _industry.stock_records(f["official_ledger"]), OFFICIAL)


@query("empirical_map")
def _empirical(r: Research) -> DataFrame:
    """Old code -> level code from before/after-cutover record pairs."""
    f = r.raw.feeds
    recs = _industry.stock_records(f["official_ledger"])
    snap = _industry.snapshot_codes(f["official_snapshot"])
    allr = recs.unionByName(_industry.cutover_anchors(snap, recs, OFFICIAL))
    return _industry.empirical_map(allr, _industry.hierarchy_levels(f["official_codes"]), OFFICIAL)


@query("official_industry_rows")
def _official_rows(r: Research) -> DataFrame:
    """Closed PIT industry rows of the official import."""
    return _official(r).rows


@query("official_import_counters")
def _official_counters(r: Research) -> DataFrame:
    return _official(r).counters


def adjudication_candidates(official: DataFrame) -> DataFrame:
    """Adjudication records proposed against the official L1 rows: by the
    code number mod 5 — 0 left-edge backfill with web evidence, 1 the same
    with file evidence (unsupported), 2 listing-lag backfill, 3 provider-gap
    confirmation (supported, not extending), 4 a backfill overlapping the
    previous interval (rejected)."""
    o = official.where(F.col("industry_schema") == "sw2021_l1")
    d = F.regexp_extract("security_id", "^[0-9]+", 0).cast("bigint") % 5
    day = F.expr("INTERVAL 1 DAY")
    end = F.col("effective_at")
    kind = (F.when(d == 0, F.lit("external_left_edge_backfill")).when(d == 1, F.lit("external_left_edge_backfill"))
            .when(d == 2, F.lit("listing_lag_backfill")).when(d == 3, F.lit("provider_gap_confirmation"))
            .otherwise(F.lit("listing_lag_backfill")))
    start = (F.when(d == 3, end).when(d == 4, end - day * 400).when(d == 2, end - day * 100).otherwise(end - day * 365))
    stop = F.when(d == 3, F.coalesce(F.col("removed_at"), end + day * 10)).otherwise(end)
    url = F.when(d == 1, F.lit("file:///ledger")).otherwise(F.lit("https://example.org/evidence"))
    return o.select(
        "security_id", start.alias("start_date"), stop.alias("end_date"), "industry_schema", F.lit("L1").alias("industry_level"),
        "industry_code", kind.alias("source_type"), url.alias("evidence_url"), end.alias("evidence_date"),
        end.alias("available_at"), F.lit("medium").alias("confidence"), F.lit("derived").alias("adjudication_note"),
        F.lit(None).cast("string").alias("legacy_security_id"),
    )


@query("manual_adjudication")
def _manual(r: Research) -> DataFrame:
    """C17: supported, extending adjudications applied to the official rows."""
    rows = _official(r).rows
    closed, _ = _industry.apply_adjudications(rows, adjudication_candidates(rows))
    return closed


# ------------------------------------------------------------------ sinks
@query("export_normalized_csv")
def _export_csv(r: Research) -> DataFrame:
    """The normalized bars written as CSV with a header and read back."""
    from .sources import sinks as _sinks

    base = r.store or checkpoint_dir(r.spark)
    path = f"{base.rstrip('/')}/export-{uuid.uuid4().hex[:12]}/stock_bar_normalized_daily"
    bars = r.stock_bar_normalized_daily
    _sinks.export_table(bars, path, "csv")
    return _sinks.read_export(r.spark, path, bars.schema, "csv")


@query("sync_state")
def _sync_state(r: Research) -> DataFrame:
    """The state after two runs over all registered datasets: in the first the forecasts come without their key, the second
    brings them and early figures without theirs."""
    from .sources.schemas import DATASETS

    profile = lambda spec, df: _raw_profile(r, spec, df)
    good = {s.dataset_id: (lambda s=s: _raw(r, s)[1]) for s in DATASETS.values()}
    first = _registries.sync(r.spark, good | {"forecast": lambda: _raw(r, DATASETS["forecast"])[1].drop("ann_date")}, profile)
    second = {"forecast": good["forecast"], "express": lambda: _raw(r, DATASETS["express"])[1].drop("end_date")}
    return _registries.sync(r.spark, second, profile, first)
