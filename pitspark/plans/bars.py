"""Dimensions and the point-in-time daily bar spine.

Physical plan of the spine (``daily_bar_pit``): the five inputs keyed by
(security_id, trade_date) are each hash-exchanged once on that key and joined
with consecutive sort-merge joins that share the partitioning; the security
master (one row per security) is joined last on security_id, which the
adaptive planner turns into a broadcast hash join once it has measured it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import parse_date_key
from ..functions.market import A_SHARE_EXCHANGES, board, exchange_of, is_st_name
from ..functions.text import blank_to_null
from ..operators.temporal import in_interval_set, interval_set_days, interval_sets, next_asof

BAR_KEYS = ["security_id", "trade_date"]


def security_master(stock_basic: DataFrame) -> DataFrame:
    """A-share securities with exchange and board."""
    s = stock_basic
    return s.where(exchange_of("ts_code").isin(*A_SHARE_EXCHANGES)).select(
        F.col("ts_code").alias("security_id"),
        "symbol",
        F.col("name").alias("current_name"),
        exchange_of("ts_code").alias("exchange"),
        board("ts_code", "symbol").alias("board"),
        "area",
        parse_date_key("list_date").alias("list_date"),
        parse_date_key(blank_to_null("delist_date")).alias("delist_date"),
        "is_hs",
        F.lit(True).alias("is_a_share"),
        "ingested_at",
    )


def industry_static(stock_basic: DataFrame) -> DataFrame:
    """The provider's current industry text, scope-labelled."""
    return stock_basic.where(exchange_of("ts_code").isin(*A_SHARE_EXCHANGES)).select(
        F.col("ts_code").alias("security_id"),
        F.col("name").alias("current_name"),
        F.col("industry").alias("industry_name"),
        F.lit("current_static").alias("classification_scope"),
    )


def name_change_history(namechange: DataFrame, master: DataFrame) -> DataFrame:
    """P4 + J1: names of A-share securities with the ST flag."""
    n = namechange.join(master.select(F.col("security_id").alias("ts_code")), "ts_code", "left_semi")
    return n.select(
        F.col("ts_code").alias("security_id"),
        "name",
        parse_date_key("start_date").alias("start_date"),
        parse_date_key(blank_to_null("end_date")).alias("end_date"),
        parse_date_key(blank_to_null("ann_date")).alias("announcement_date"),
        "change_reason",
        "source_table",
        "ingested_at",
        is_st_name("name", "change_reason").alias("is_st_name"),
    )


def trade_calendar(daily_basic: DataFrame, master: DataFrame) -> DataFrame:
    """A1: observed trading days = distinct daily_basic dates of A-share securities."""
    d = daily_basic.select("ts_code", parse_date_key("trade_date").alias("trade_date"))
    d = d.join(master.select(F.col("security_id").alias("ts_code")), "ts_code", "left_semi")
    return d.select("trade_date").distinct()


def st_windows(names: DataFrame) -> DataFrame:
    """Closed ST windows ``[coalesce(start, announcement), end]`` (NULL end = open)."""
    return names.where(F.col("is_st_name")).select(
        "security_id",
        F.coalesce("start_date", "announcement_date").alias("st_start"),
        F.col("end_date").alias("st_end"),
    )


def st_sets(names: DataFrame) -> DataFrame:
    """The ST days of each security as one set of intervals."""
    return interval_sets(st_windows(names), key="security_id", start="st_start", end="st_end", out="st_days")


def st_daily(calendar: DataFrame, names: DataFrame) -> DataFrame:
    """Every calendar day inside an ST window of a security (distinct)."""
    days = interval_set_days(st_sets(names), calendar, key="security_id", intervals="st_days", day="trade_date")
    return days.select("trade_date", "security_id", F.lit(True).alias("is_st"))


def _keyed(df: DataFrame, prefix: str, columns: list[str]) -> DataFrame:
    return df.select(
        F.col("ts_code").alias("security_id"),
        parse_date_key("trade_date").alias("trade_date"),
        *[F.col(c).alias(f"{prefix}{c}") for c in columns],
        F.lit(True).alias(f"{prefix}present"),
    )


PRICE_COLS = ["open", "high", "low", "close", "pre_close", "change", "pct_chg", "vol", "amount", "source_table", "ingested_at"]
BASIC_COLS = ["turnover_rate", "turnover_rate_f", "volume_ratio", "pe", "pe_ttm", "pb", "ps", "ps_ttm", "dv_ratio",
              "dv_ttm", "total_share", "float_share", "free_share", "total_mv", "circ_mv", "source_table", "ingested_at"]


def daily_bar_pit(
    daily_basic: DataFrame,
    unadj: DataFrame,
    qfq: DataFrame,
    adj: DataFrame,
    master: DataFrame,
    names: DataFrame,
) -> DataFrame:
    """J2 + P5–P8: one row per A-share (security, day) with a factor and a price.

    Driven by daily_basic; an unadjusted bar wins over a qfq one (``price_basis``);
    bars without an adjustment factor are dropped (inner join), as are bars with
    neither price.
    """
    d = _keyed(daily_basic, "d_", BASIC_COLS)
    u = _keyed(unadj, "u_", PRICE_COLS)
    q = _keyed(qfq, "q_", PRICE_COLS)
    a = _keyed(adj, "a_", ["adj_factor", "source_table", "ingested_at"])
    # one row per security: the master with the security's ST days as a set, looked up row by row
    m = master.select("security_id", "exchange", "board").join(st_sets(names), "security_id", "left")
    # the master (one row per security) filters the driving table first, so
    # every later join is keyed by (security_id, trade_date) and can reuse the
    # security_id partitioning
    d = d.join(m, "security_id", "inner")
    j = (
        d.join(a, BAR_KEYS, "inner")
        .join(u, BAR_KEYS, "left")
        .join(q, BAR_KEYS, "left")
        .where(F.col("u_present").isNotNull() | F.col("q_present").isNotNull())
    )
    has_u = F.col("u_present").isNotNull()

    def pick(c: str) -> F.Column:
        return F.coalesce(F.col(f"u_{c}"), F.col(f"q_{c}"))

    def adjusted(c: str) -> F.Column:
        return F.when(has_u, F.col(f"u_{c}") * F.col("a_adj_factor")).otherwise(F.col(f"q_{c}"))

    return j.select(
        "security_id",
        "trade_date",
        "exchange",
        "board",
        in_interval_set(F.col("trade_date"), F.col("st_days")).alias("is_st"),
        F.when(has_u, F.lit("unadjusted")).otherwise(F.lit("qfq_fallback")).alias("price_basis"),
        *[pick(c).alias(c) for c in ["open", "high", "low", "close", "pre_close", "change", "pct_chg"]],
        F.col("a_adj_factor").alias("adj_factor"),
        *[adjusted(c).alias(f"{c}_adj") for c in ["open", "high", "low", "close"]],
        F.when(has_u, F.lit("raw_times_adj_factor")).otherwise(F.lit("qfq_diagnostic_only")).alias("adjusted_price_source"),
        (pick("vol") * 100.0).alias("volume_shares"),
        (pick("amount") * 1000.0).alias("turnover_value_cny"),
        F.col("d_turnover_rate").alias("turnover_rate_pct"),
        F.col("d_turnover_rate_f").alias("turnover_rate_free_float_pct"),
        *[F.col(f"d_{c}").alias(c) for c in ["volume_ratio", "pe", "pe_ttm", "pb", "ps", "ps_ttm", "dv_ratio", "dv_ttm"]],
        (F.col("d_total_share") * 10000.0).alias("total_shares"),
        (F.col("d_float_share") * 10000.0).alias("float_shares"),
        (F.col("d_free_share") * 10000.0).alias("free_float_shares"),
        (F.col("d_total_mv") * 10000.0).alias("total_mcap_cny"),
        (F.col("d_circ_mv") * 10000.0).alias("float_mcap_cny"),
        pick("source_table").alias("price_source"),
        F.col("d_source_table").alias("liquidity_source"),
        F.col("a_source_table").alias("adj_factor_source"),
        F.greatest(pick("ingested_at"), F.col("d_ingested_at"), F.col("a_ingested_at")).alias("ingested_at"),
    )


FUNDAMENTAL_COLS = ["eps", "roe", "roa", "gross_margin", "netprofit_margin", "current_ratio", "debt_to_assets",
                    ("revenue_ps", "revenue_per_share_cny"), "netprofit_yoy", "dt_netprofit_yoy", ("or_yoy", "revenue_yoy"),
                    "q_sales_yoy", "assets_yoy", "equity_yoy"]


def fundamental_snapshot_pit(fina: DataFrame, master: DataFrame, calendar: DataFrame) -> DataFrame:
    """Fundamentals become available on the first trading day strictly after
    the announcement; blank announcements and those with no later trading day
    are dropped."""
    f = fina.join(master.select(F.col("security_id").alias("ts_code")), "ts_code", "left_semi")
    f = f.select(
        F.col("ts_code").alias("security_id"),
        parse_date_key(blank_to_null("ann_date")).alias("announcement_date"),
        parse_date_key("end_date").alias("period_end"),
        *[F.col(c[0]).alias(c[1]) if isinstance(c, tuple) else F.col(c) for c in FUNDAMENTAL_COLS],
    ).where(F.col("announcement_date").isNotNull())
    f = next_asof(f, point="announcement_date", calendar=calendar, calendar_col="trade_date", out="available_date")
    cols = ["security_id", "announcement_date", "period_end", "available_date"] + [
        c[1] if isinstance(c, tuple) else c for c in FUNDAMENTAL_COLS
    ]
    return f.where(F.col("available_date").isNotNull()).select(*cols)


def index_daily_bar_pit(index_daily: DataFrame) -> DataFrame:
    """Index bars renamed to the research layout."""
    return index_daily.select(
        F.col("ts_code").alias("index_code"), "trade_date", "open", "high", "low", "close", "pre_close", "change",
        "pct_chg", F.col("vol").alias("volume"), F.col("amount").alias("turnover_value"), "source_table", "ingested_at",
    )
