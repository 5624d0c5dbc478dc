"""Reference staging: benchmark membership, industry intervals, registry
(W8, W9, C10, A5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import parse_date_key
from ..functions.text import clean_text, nullable_text
from ..operators.temporal import close_intervals, extend_islands, islands

# Industry levels -> (schema, code column of the membership feed).
INDUSTRY_LEVELS = {"L1": ("sw2021_l1", "l1_code"), "L2": ("sw2021_l2", "l2_code"), "L3": ("sw2021_l3", "l3_code")}
INTERVAL_COLUMNS = ["security_id", "industry_schema", "industry_code", "effective_at", "removed_at"]


def membership_intervals(weights: DataFrame) -> DataFrame:
    """Benchmark membership intervals from weight snapshots."""
    return islands(weights, group=["benchmark_id"], member=["security_id"], snapshot="trade_date").select(
        "benchmark_id", "security_id", "effective_at", "removed_at"
    )


MEMBERSHIP = {"group": ["benchmark_id"], "member": ["security_id"], "snapshot": "trade_date"}


def membership_state(weights: DataFrame) -> DataFrame:
    """Membership intervals with the last snapshot of each, from which later snapshots go on."""
    return islands(weights, **MEMBERSHIP, seen_out="last_seen")


def extend_membership(state: DataFrame, weights: DataFrame) -> DataFrame:
    """The state after further weight snapshots."""
    return extend_islands(state, weights, **MEMBERSHIP)


def close_industry_intervals(rows: DataFrame) -> DataFrame:
    """W8 on industry rows: cut at the next start per (security, schema),
    ordered by (effective_at, industry_code)."""
    return close_intervals(rows, keys=["security_id", "industry_schema"], effective="effective_at",
                           removed="removed_at", tiebreak=["industry_code"])


def industry_rows_from_members(members: DataFrame, levels: tuple[str, ...] = ("L1", "L2", "L3")) -> DataFrame:
    """Unpivot level codes to one row per level, drop blank codes and
    start dates, deduplicate, then close the intervals."""
    unknown = sorted(set(levels) - set(INDUSTRY_LEVELS))
    if unknown:
        raise ValueError(f"no such level: {', '.join(unknown)}")
    base = members.select(
        F.col("ts_code").cast("string").alias("security_id"),
        nullable_text("in_date").alias("_in"),
        nullable_text("out_date").alias("_out"),
        *[clean_text(INDUSTRY_LEVELS[lv][1]).alias(lv) for lv in levels],
    ).where(F.col("_in").isNotNull())
    stack = ", ".join(f"'{INDUSTRY_LEVELS[lv][0]}', `{lv}`" for lv in levels)
    long = base.selectExpr("security_id", "_in", "_out", f"stack({len(levels)}, {stack}) AS (industry_schema, industry_code)")
    rows = long.where(F.col("industry_code") != "").select(
        "security_id", "industry_schema", "industry_code",
        parse_date_key("_in").alias("effective_at"), parse_date_key("_out").alias("removed_at"),
    ).distinct()
    return close_industry_intervals(rows).select(*INTERVAL_COLUMNS)


def staging_registry(tables: dict[str, DataFrame | None]) -> DataFrame:
    """A5: row count and date span per staged table (absent or empty ones skipped)."""
    spans = {
        "industry_classification_pit": (F.col("effective_at"), F.coalesce("removed_at", "effective_at")),
        "benchmark_membership_pit": (F.col("effective_at"), F.coalesce("removed_at", "effective_at")),
        "benchmark_weight_snapshot_pit": (F.col("trade_date"), F.col("trade_date")),
        "index_basic_ref": (F.col("list_date"), F.col("list_date")),
        "raw_index_daily": (F.col("trade_date"), F.col("trade_date")),
        "raw_dividend": (F.coalesce("ex_date", "ann_date"), F.coalesce("ex_date", "ann_date")),
        "raw_stk_limit": (F.col("trade_date"), F.col("trade_date")),
        "raw_suspend_d": (F.col("trade_date"), F.col("trade_date")),
        "raw_share_float": (F.col("float_date"), F.col("float_date")),
        "raw_repurchase": (F.coalesce("end_date", "ann_date"), F.coalesce("end_date", "ann_date")),
    }
    out = None
    for name, (lo, hi) in spans.items():
        df = tables.get(name)
        if df is None:
            continue
        part = df.agg(F.count(F.lit(1)).alias("row_count"), F.min(lo).alias("earliest_date"), F.max(hi).alias("latest_date")).select(
            F.lit(name).alias("dataset_id"), F.lit("pit_reference_staging").alias("boundary_role"), F.lit("green").alias("status"),
            "row_count", "earliest_date", "latest_date",
        ).where(F.col("row_count") > 0)
        out = part if out is None else out.unionByName(part)
    return out
