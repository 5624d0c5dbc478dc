"""The research-layer build: raw provider tables -> point-in-time datasets.

``Research`` wires the plans together lazily; every attribute is a DataFrame
built on first use and shared by later ones, so a single action plans the
whole chain once and Spark reuses identical exchanges within it.
``materialize`` writes the heavily reused tables (the bar spine, ledgers) to
the session's checkpoint folder and reads them back, cutting lineage so a
lost executor recomputes from files, not from the raw layer.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ..sources.conform import conform_event_table, conform_index_table, conform_pit_table, empty_table, INDUSTRY_PIT
from ..sources.derive import SPINE_PROJECTIONS, RawSources, raw_sources
from ..operators.profile import Profile, Span, measured, profiled_write
from ..session import shuffles_dropped
from . import actions, bars, normalized, tradeability
from .registry import SPANS


class Research:
    """Lazy research build over two provider databases.

    With ``store`` set (a folder on shared storage), every table that later
    steps reuse is written there once as Parquet on first use and read back:
    the lineage is cut at that table, a lost executor recomputes from files,
    and later queries in the session scan the stored table instead of
    re-planning the whole chain.
    """

    def __init__(self, spark: SparkSession, raw: RawSources, store: str | None = None):
        self.spark = spark
        self.store = store.rstrip("/") if store else None
        if self.store:
            # the provider landing zone: each provider table stored once, on first use
            raw = RawSources(_LazyStore(self, "source", raw.source), _LazyStore(self, "supplemental", raw.supplemental),
                             _LazyStore(self, "feeds", raw.feeds or {}))
        self.raw = raw
        self.profiles: dict[str, Profile] = {}
        self.sources = {"source": raw.source, "supplemental": raw.supplemental}

    @classmethod
    def from_driver(cls, spark: SparkSession, sf_dir: str, store: str | None = None) -> "Research":
        """Provider layer derived from the driver tables; with ``store`` the
        derivation spine is stored once and the raw tables are projections of it."""
        keep = None
        if store:
            root = store.rstrip("/")
            keep = lambda name, df, key: _Bucketed(spark, f"{root}/{name}", df, key).frame()
        return cls(spark, raw_sources(spark, sf_dir, keep), store)

    def _keep(self, name: str, df: DataFrame | None, bucket_by: str | None = None) -> DataFrame | None:
        """Store ``df`` under ``name``.

        With ``bucket_by`` the table is written bucketed by that key and
        sorted by it and the trade date, so later per-security windows and
        joins on the key read co-partitioned buckets instead of shuffling.
        """
        if df is None or not self.store:
            return df
        span = SPANS.get(name)
        kept = _Bucketed(self.spark, f"{self.store}/{name}", df, bucket_by, span) if bucket_by else _Stored(self.spark, f"{self.store}/{name}", df, span)
        frame = kept.frame()
        if kept.profile is not None:
            self.profiles[name] = kept.profile
        return frame

    def profile(self, name: str, df: DataFrame, span: Span) -> Profile:
        """Rows and span of a table: as measured while it was written, else by one aggregate that is remembered."""
        if name not in self.profiles:
            self.profiles[name] = measured(df, span)
        return self.profiles[name]

    def src(self, name: str) -> DataFrame:
        return self.raw.source[name]

    # dimensions
    @cached_property
    def security_master(self) -> DataFrame:
        return bars.security_master(self.src("stock_basic_ref"))

    @cached_property
    def industry_static(self) -> DataFrame:
        return bars.industry_static(self.src("stock_basic_ref"))

    @cached_property
    def name_change_history(self) -> DataFrame:
        return bars.name_change_history(self.src("raw_namechange"), self.security_master)

    @cached_property
    def trade_calendar(self) -> DataFrame:
        return self._keep("research/market_trade_calendar", bars.trade_calendar(self.src("raw_daily_basic"), self.security_master))

    @cached_property
    def st_daily(self) -> DataFrame:
        return bars.st_daily(self.trade_calendar, self.name_change_history)

    # bars and fundamentals
    @cached_property
    def daily_bar_pit(self) -> DataFrame:
        return self._keep("research/daily_bar_pit", bars.daily_bar_pit(
            self.src("raw_daily_basic"), self.src("raw_kline_unadj"), self.src("raw_kline_qfq"),
            self.src("raw_adj_factor"), self.security_master, self.name_change_history,
        ), bucket_by="security_id")

    @cached_property
    def fundamental_snapshot_pit(self) -> DataFrame:
        return bars.fundamental_snapshot_pit(self.src("pit_fina_indicator"), self.security_master, self.trade_calendar)

    # optional reference imports
    @cached_property
    def industry_classification_pit(self) -> DataFrame:
        df = conform_pit_table(self.sources, "industry_classification_pit")
        return df if df is not None else empty_table(self.spark, INDUSTRY_PIT)

    @cached_property
    def benchmark_weight_snapshot_pit(self) -> DataFrame | None:
        return conform_pit_table(self.sources, "benchmark_weight_snapshot_pit")

    @cached_property
    def index_basic_ref(self) -> DataFrame | None:
        return conform_index_table(self.sources, "index_basic_ref")

    @cached_property
    def raw_index_daily(self) -> DataFrame | None:
        return conform_index_table(self.sources, "raw_index_daily")

    @cached_property
    def index_daily_bar_pit(self) -> DataFrame | None:
        return None if self.raw_index_daily is None else bars.index_daily_bar_pit(self.raw_index_daily)

    def event(self, table: str) -> DataFrame:
        return conform_event_table(self.spark, self.sources, table)[0]

    @cached_property
    def raw_dividend(self) -> DataFrame:
        return self.event("raw_dividend")

    @cached_property
    def raw_suspend_d(self) -> DataFrame:
        return self.event("raw_suspend_d")

    @cached_property
    def raw_stk_limit(self) -> DataFrame:
        """Limits from every source, latest ingest wins."""
        first, copies = conform_event_table(self.spark, self.sources, "raw_stk_limit")
        return tradeability.merge_limit_sources(copies) if copies else first

    # ledgers and states
    @cached_property
    def jump_facts(self) -> DataFrame:
        """Significant jumps with the evidence of all events; the ledgers and the quality report read it."""
        jumps = actions.significant_jumps(self.daily_bar_pit)
        return self._keep("research/jump_facts", actions.jump_facts(jumps, actions.action_rows(self.raw_dividend), self.raw_dividend, self.raw_suspend_d), bucket_by="security_id")

    @cached_property
    def corporate_action_ledger(self) -> DataFrame:
        columns = actions.LEDGER_COLUMNS
        return self._keep("research/corporate_action_ledger", actions.action_rows(self.raw_dividend).select(*columns).unionByName(actions.repairs_of(self.jump_facts).select(*columns)), bucket_by="security_id")

    @cached_property
    def corporate_action_exception_ledger(self) -> DataFrame:
        return self._keep("research/corporate_action_exception_ledger", actions.exceptions_of(self.jump_facts.where(~actions.is_explained())), bucket_by="security_id")

    @cached_property
    def tradeability_state_daily(self) -> DataFrame:
        return self._keep("research/tradeability_state_daily", tradeability.tradeability_state(self.daily_bar_pit, self.raw_suspend_d, self.raw_stk_limit), bucket_by="security_id")

    @cached_property
    def normalized_bars(self) -> DataFrame:
        """C5 with DateType trade_date (see ``normalized.contract`` for the public form)."""
        return self._keep("research/normalized_bars", normalized.normalized_bars(self.daily_bar_pit, self.tradeability_state_daily, self.industry_classification_pit), bucket_by="code")

    @cached_property
    def stock_bar_normalized_daily(self) -> DataFrame:
        return normalized.contract(self.normalized_bars)

    # lineage cuts
    def materialize(self, root: str, names: tuple[str, ...] = ("daily_bar_pit", "corporate_action_ledger",
                                                            "corporate_action_exception_ledger", "tradeability_state_daily")) -> None:
        """Write the named tables under ``root`` (a shared folder) and read them back."""
        for name in names:
            path = f"{root.rstrip('/')}/{name}"
            getattr(self, name).write.mode("overwrite").parquet(path)
            self.__dict__[name] = self.spark.read.parquet(path)

    # quality
    @cached_property
    def usability_flags(self) -> DataFrame:
        from . import quality

        return self._keep("research/usability_flags", quality.usability_flags(self.daily_bar_pit, self.tradeability_state_daily, self.normalized_bars,
                                       self.corporate_action_exception_ledger), bucket_by="code")

    @cached_property
    def classified_jumps(self) -> DataFrame:
        return self.jump_facts.withColumn("has_explaining_corporate_action", actions.is_explained())

    @cached_property
    def unresolved_jumps(self) -> DataFrame:
        from . import quality

        return quality.unresolved(self.classified_jumps)

    @cached_property
    def unresolved_context(self) -> DataFrame:
        from . import quality

        return quality.context_of(self.unresolved_jumps)


class _LazyStore(Mapping):
    """Provider tables stored on first access (only the tables a query uses)."""

    def __init__(self, owner: "Research", prefix: str, tables: dict[str, DataFrame]):
        self.owner, self.prefix, self.tables, self.done = owner, prefix, tables, {}

    def __getitem__(self, key: str) -> DataFrame:
        if key not in self.done:
            df = self.tables[key]
            self.done[key] = df if key in SPINE_PROJECTIONS else self.owner._keep(f"{self.prefix}/{key}", df)
        return self.done[key]

    def __contains__(self, key: object) -> bool:
        return key in self.tables

    def __iter__(self):
        return iter(self.tables)

    def __len__(self) -> int:
        return len(self.tables)


def _written(df: DataFrame, span: Span | None, write: Callable[[DataFrame], None]) -> Profile | None:
    """Write a table, and measure it on the way if its span is known."""
    with shuffles_dropped(df.sparkSession):
        if span is not None:
            return profiled_write(df, span, write)
        write(df)
    return None


class _Bucketed:
    """A DataFrame written once as a bucketed, sorted table at ``path``.

    The table is registered in the session catalog (external, at ``path``)
    because bucket metadata lives in the catalog; the bucket count follows
    ``spark.sql.shuffle.partitions`` so joins with freshly shuffled inputs line up.
    """

    def __init__(self, spark: SparkSession, path: str, df: DataFrame, key: str, span: Span | None = None):
        self.spark, self.path, self.df, self.key, self.span = spark, path, df, key, span
        self.profile: Profile | None = None

    def frame(self) -> DataFrame:
        import hashlib

        table = "pit_" + hashlib.sha1(self.path.encode()).hexdigest()[:16]
        n = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        sort = [self.key] + (["trade_date"] if "trade_date" in self.df.columns else [])
        write = lambda df: df.write.mode("overwrite").option("path", self.path).bucketBy(n, self.key).sortBy(*sort).saveAsTable(table)
        self.profile = _written(self.df, self.span, write)
        return self.spark.table(table)


class _Stored:
    """A DataFrame written to Parquet the first time it is read."""

    def __init__(self, spark: SparkSession, path: str, df: DataFrame, span: Span | None = None):
        self.spark, self.path, self.df, self.span = spark, path, df, span
        self.profile: Profile | None = None

    def frame(self) -> DataFrame:
        self.profile = _written(self.df, self.span, lambda df: df.write.mode("overwrite").parquet(self.path))
        return self.spark.read.parquet(self.path)
