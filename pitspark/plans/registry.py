"""Registries (A4, A5, A17) and synchronisation state (D7, D9) from table profiles; no data table is scanned for a stored one."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from ..operators.keyed import STATE_COLUMNS, record_state
from ..operators.profile import Profile, Span
from ..sources.schemas import DATASETS, DatasetSpec


@dataclass(frozen=True)
class Entry:
    """A built dataset: status ('amber-if-rows' turns amber when it has rows), span and a note on what it is good for."""

    dataset_id: str
    status: str
    span: Span
    note: str


def _day(column: str) -> Span:
    return Span(column, column)


REGISTRY = [
    Entry("daily_bar_pit", "green", _day("trade_date"), "one bar a security and day; unadjusted prices first, adjusted ones marked by their source"),
    Entry("fundamental_snapshot_pit", "amber", _day("announcement_date"), "usable from the first trading day after the announcement"),
    Entry("industry_classification_static", "amber", Span(), "present industry only, without history"),
    Entry("market_trade_calendar", "green", _day("trade_date"), "days on which any listed security has a basic row"),
    Entry("name_change_history", "green", Span("coalesce(start_date, announcement_date)", "coalesce(end_date, announcement_date)"), "source of the special-treatment windows"),
    Entry("security_master_ref", "green", Span("list_date", "coalesce(delist_date, list_date)"), "listed securities with their board"),
    Entry("corporate_action_ledger", "green", _day("book_date"), "implemented dividends and inferred factor repairs"),
    Entry("corporate_action_exception_ledger", "amber-if-rows", _day("trade_date"), "factor jumps that no booking explains; rows keep a security window from promotion"),
    Entry("tradeability_state_daily", "green", _day("trade_date"), "suspensions and limit locks with their source"),
    Entry("benchmark_weight_snapshot_pit", "green", _day("trade_date"), "benchmark weights as delivered"),
    Entry("industry_classification_pit", "green", Span("effective_at", "coalesce(removed_at, effective_at)"), "industry intervals by schema"),
    Entry("index_basic_ref", "green", _day("list_date"), "index names and base values"),
    Entry("index_daily_bar_pit", "green", _day("trade_date"), "index bars"),
]
STAGED = {
    "industry_classification_pit": Span("effective_at", "coalesce(removed_at, effective_at)"),
    "benchmark_membership_pit": Span("effective_at", "coalesce(removed_at, effective_at)"),
    "benchmark_weight_snapshot_pit": _day("trade_date"), "index_basic_ref": _day("list_date"), "raw_index_daily": _day("trade_date"),
    "raw_dividend": _day("coalesce(ex_date, ann_date)"), "raw_stk_limit": _day("trade_date"), "raw_suspend_d": _day("trade_date"),
    "raw_share_float": _day("float_date"), "raw_repurchase": _day("coalesce(end_date, ann_date)"),
}


def dataset_span(spec: DatasetSpec) -> Span:
    return Span() if spec.axis_column is None else _day(spec.axis_column)


#: Spans by the name of a stored table, for profiles taken while it is written.
SPANS = {f"research/{e.dataset_id}": e.span for e in REGISTRY} | {f"{side}/{s.table}": dataset_span(s) for s in DATASETS.values() for side in ("source", "supplemental")}


def dataset_registry(spark: SparkSession, profiles: Mapping[str, Profile]) -> DataFrame:
    """A4: one row for each built dataset; absent ones are left out."""
    rows = []
    for e in REGISTRY:
        p = profiles.get(e.dataset_id)
        if p is not None:
            status = ("amber" if p.rows else "green") if e.status == "amber-if-rows" else e.status
            rows.append((e.dataset_id, status, p.rows, p.first, p.last, e.note))
    return spark.createDataFrame(rows, "dataset_id string, status string, row_count bigint, earliest_date string, latest_date string, note string")


def staging_registry(spark: SparkSession, profiles: Mapping[str, Profile]) -> DataFrame:
    """A5: one row for each staged table; absent or empty ones are left out."""
    rows = [(name, "pit_reference_staging", "green", profiles[name].rows, profiles[name].first, profiles[name].last) for name in STAGED if name in profiles and profiles[name].rows]
    return spark.createDataFrame(rows, "dataset_id string, boundary_role string, status string, row_count bigint, earliest_date string, latest_date string")


def validated(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """The delivery, if it has the dataset's primary key."""
    for k in spec.primary_key:
        if k not in df.columns:
            raise ValueError(f"{spec.dataset_id}: the delivery lacks the key column {k}")
    return df


def sync(spark: SparkSession, deliveries: Mapping[str, Callable[[], DataFrame]], profile: Callable[[DatasetSpec, DataFrame], Profile], state: DataFrame | None = None) -> DataFrame:
    """The state after a run over the given deliveries, each dataset for itself.

    A dataset is taken in (``profile`` stores or measures it) and recorded with status, span and rows, or with the reason why
    not; a failed one keeps no marks.  The rows replace those of ``state`` for the same datasets.
    """
    kind = "dataset_id string, status string, start_date string, last_date string, row_count bigint, error string"
    rows = []
    for dataset_id, load in deliveries.items():
        spec = DATASETS[dataset_id]
        try:
            p = profile(spec, validated(load(), spec))
            rows.append((dataset_id, "ok", p.first, p.last, p.rows, None))
        except (ValueError, AnalysisException) as e:
            rows.append((dataset_id, "error", None, None, None, str(e).splitlines()[0]))
    new = spark.createDataFrame(rows, kind).select(*STATE_COLUMNS)
    return new if state is None else record_state(state, new)
