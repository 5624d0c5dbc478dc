"""Tradeability state per bar.

Suspension and limit events are pre-aggregated to one row per
(security, day) before they meet the bars, so the joins are 1:1 and the
partial aggregates run map-side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.market import FULL_DAY_TIMING_MARK, LIMIT_TOLERANCE, SUSPEND_TYPES
from ..operators.keyed import latest_wins
from ..sources.conform import SOURCE_RANK

BAR_KEYS = ["security_id", "trade_date"]


def merge_limit_sources(copies: list[tuple[str, DataFrame]]) -> DataFrame:
    """Union all copies; per (ts_code, trade_date) keep the latest
    ``ingested_at`` (NULLs last), ties to the source copy over the supplemental."""
    if not copies:
        raise ValueError("no limit table to merge")
    union = None
    for alias, df in copies:
        part = df.select("ts_code", "trade_date", "up_limit", "down_limit", "source_table", "ingested_at",
                         F.lit(SOURCE_RANK[alias]).alias("source_rank"))
        union = part if union is None else union.unionByName(part)
    union = union.where(F.col("ts_code").isNotNull() & F.col("trade_date").isNotNull())
    best = latest_wins(union, keys=["ts_code", "trade_date"],
                       order=[F.col("ingested_at").desc_nulls_last(), F.col("source_rank").asc()])
    return best.drop("source_rank")


def suspend_key(suspend: DataFrame) -> DataFrame:
    """A2: per (security, day): any event, and any full-day suspension."""
    timing = F.coalesce(F.col("suspend_timing"), F.lit(""))
    full_day = F.col("suspend_type").isin(*SUSPEND_TYPES) & ((timing == "") | timing.contains(FULL_DAY_TIMING_MARK))
    return (
        suspend.where(F.col("ts_code").isNotNull() & F.col("trade_date").isNotNull())
        .groupBy(F.col("ts_code").alias("security_id"), "trade_date")
        .agg(F.lit(True).alias("has_suspend_event"), F.bool_or(full_day).alias("has_full_day_suspend_event"))
    )


def limit_key(limits: DataFrame) -> DataFrame:
    """A3: widest limits per (security, day)."""
    return (
        limits.where(F.col("ts_code").isNotNull() & F.col("trade_date").isNotNull())
        .groupBy(F.col("ts_code").alias("security_id"), "trade_date")
        .agg(F.max("up_limit").alias("up_limit"), F.min("down_limit").alias("down_limit"), F.lit(True).alias("has_limit_row"))
    )


def tradeability_state(bars: DataFrame, suspend: DataFrame, limits: DataFrame) -> DataFrame:
    """C4: suspension flag, limit-lock flags and the evidence source per bar."""
    b = bars.select(*BAR_KEYS, "open", "high", "low", "volume_shares", "turnover_value_cny")
    j = b.join(suspend_key(suspend), BAR_KEYS, "left").join(limit_key(limits), BAR_KEYS, "left")
    o, h, lo = F.col("open"), F.col("high"), F.col("low")
    up, down = F.col("up_limit"), F.col("down_limit")
    suspended = (
        F.when(o.isNull() | (o <= 0.0), F.lit(True))
        .when(
            F.coalesce(F.col("has_full_day_suspend_event"), F.lit(False))
            & (F.coalesce(F.col("volume_shares"), F.lit(0.0)) == 0.0)
            & (F.coalesce(F.col("turnover_value_cny"), F.lit(0.0)) == 0.0),
            F.lit(True),
        )
        .otherwise(F.lit(False))
    )
    tol = LIMIT_TOLERANCE
    up_lock = F.when(up.isNotNull(), (o >= up - tol) & (h >= up - tol) & (lo >= up - tol)).otherwise(F.lit(False))
    down_lock = F.when(down.isNotNull(), (o <= down + tol) & (h <= down + tol) & (lo <= down + tol)).otherwise(F.lit(False))
    official = F.coalesce(F.col("has_suspend_event"), F.lit(False)) | F.col("has_limit_row").isNotNull()
    return j.select(
        *BAR_KEYS,
        suspended.alias("is_suspended"),
        "up_limit",
        "down_limit",
        up_lock.alias("is_limit_up_open_lock"),
        down_lock.alias("is_limit_down_open_lock"),
        F.when(official, F.lit("official")).otherwise(F.lit("ohlc_fallback")).alias("source_priority"),
    )
