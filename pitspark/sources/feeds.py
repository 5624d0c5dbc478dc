"""Provider feed normalisers (S9–S15): table-level re-shaping into the raw layout.

Every normaliser is a ``select`` over the whole provider frame (no per-row
Python): renames, text clean-up, date re-formatting and tolerant number
parsing all run as built-in expressions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

from ..functions.text import clean_text, nullable_text, number_or_null
from .conform import require_columns
from .schemas import DATASETS

# Feed A (Chinese headers) column names -> raw layout names.
FEED_A_COLUMNS = {
    "日期": "trade_date",
    "开盘": "open",
    "收盘": "close",
    "最高": "high",
    "最低": "low",
    "成交量": "vol",
    "成交额": "amount",
    "涨跌幅": "pct_chg",
    "涨跌额": "change",
}
KLINE_FIELDS = ["ts_code", "trade_date", "open", "high", "low", "close", "pre_close", "change", "pct_chg", "vol", "amount"]


def _date_text(c) -> F.Column:
    """'2024-01-02' / '20240102' -> '20240102'."""
    t = F.trim(c.cast(StringType()))
    return F.when((F.length(t) == 8) & t.rlike("^[0-9]{8}$"), t).otherwise(F.translate(t, "-", ""))


def suffix_by_symbol(symbol: F.Column) -> F.Column:
    """Feed A heuristic: symbols starting with 6 are SH, everything else SZ."""
    return F.when(symbol.startswith("6"), F.lit("SH")).otherwise(F.lit("SZ"))


def normalize_feed_a(df: DataFrame, *, source_table: str = "feed_a.daily", volume_scale: float = 1.0,
                     amount_scale: float = 1.0) -> DataFrame:
    """Chinese-header bars (+ bare ``symbol``) -> raw unadjusted bars.

    ``pre_close`` is not delivered by this feed and stays NULL; unit scales
    default to 1.0 (values pass through as delivered).
    """
    require_columns(df, {"symbol", "日期"}, "feed_a")
    sym = F.trim(F.col("symbol").cast(StringType()))
    cols = {dst: F.col(src) for src, dst in FEED_A_COLUMNS.items() if src in df.columns}
    out = [
        F.concat(sym, F.lit("."), suffix_by_symbol(sym)).alias("ts_code"),
        _date_text(cols.pop("trade_date")).alias("trade_date"),
    ]
    for name in ["open", "high", "low", "close"]:
        out.append(cols.get(name, F.lit(None)).cast(DoubleType()).alias(name))
    out.append(F.lit(None).cast(DoubleType()).alias("pre_close"))
    out.append(cols.get("change", F.lit(None)).cast(DoubleType()).alias("change"))
    out.append(cols.get("pct_chg", F.lit(None)).cast(DoubleType()).alias("pct_chg"))
    out.append((cols.get("vol", F.lit(None)).cast(DoubleType()) * volume_scale).alias("vol"))
    out.append((cols.get("amount", F.lit(None)).cast(DoubleType()) * amount_scale).alias("amount"))
    out.append(F.lit(source_table).alias("source_table"))
    return df.select(*out)


def normalize_feed_b(df: DataFrame, *, source_table: str = "feed_b.k_data") -> DataFrame:
    """All-text positional rows ('sh.600001', ISO dates) -> raw bars.

    Blank or unparseable numbers become NULL; ``change`` is not delivered.
    """
    require_columns(df, {"code", "date", "open", "high", "low", "close", "preclose", "volume", "amount", "pctChg"}, "feed_b")
    code = F.col("code").cast(StringType())
    ts_code = F.concat(F.split_part(code, F.lit("."), F.lit(2)), F.lit("."), F.upper(F.split_part(code, F.lit("."), F.lit(1))))
    return df.select(
        ts_code.alias("ts_code"),
        F.regexp_replace(F.col("date"), "-", "").alias("trade_date"),
        number_or_null("open").alias("open"),
        number_or_null("high").alias("high"),
        number_or_null("low").alias("low"),
        number_or_null("close").alias("close"),
        number_or_null("preclose").alias("pre_close"),
        F.lit(None).cast(DoubleType()).alias("change"),
        number_or_null("pctChg").alias("pct_chg"),
        number_or_null("volume").alias("vol"),
        number_or_null("amount").alias("amount"),
        F.lit(source_table).alias("source_table"),
    )


def conform_to_dataset(df: DataFrame, dataset_id: str, *, source_table: str) -> DataFrame:
    """Keep the dataset's fields (absent ones as typed NULL), fail when a
    primary-key column is missing, stamp ``source_table`` and ``ingested_at``."""
    spec = DATASETS[dataset_id]
    missing_pk = [k for k in spec.primary_key if k not in df.columns]
    if missing_pk:
        raise ValueError(f"Dataset '{dataset_id}': primary key column '{missing_pk[0]}' missing from response")
    cols = []
    for name, dtype in spec.fields:
        cols.append((F.col(name) if name in df.columns else F.lit(None)).cast(dtype).alias(name))
    return df.select(*cols, F.lit(source_table).alias("source_table"), F.current_timestamp().alias("ingested_at"))


def normalize_suspend_events(df: DataFrame, *, source_table: str = "provider.suspend_d") -> DataFrame:
    """S12 (suspensions): the day comes from ``trade_date`` or else
    ``suspend_date`` and the type from ``suspend_type`` or else
    ``reason_type``; texts are trimmed and sentinel words blanked."""

    def first_present(a: str, b: str) -> F.Column:
        ca = F.col(a).cast(StringType()) if a in df.columns else F.lit(None).cast(StringType())
        cb = F.col(b).cast(StringType()) if b in df.columns else F.lit(None).cast(StringType())
        return F.when(ca.isNotNull() & (ca != ""), ca).otherwise(cb)

    return df.select(
        clean_text("ts_code").alias("ts_code"),
        nullable_text(first_present("trade_date", "suspend_date")).alias("trade_date"),
        clean_text("suspend_timing").alias("suspend_timing"),
        clean_text(first_present("suspend_type", "reason_type")).alias("suspend_type"),
        F.lit(source_table).alias("source_table"),
    )


def normalize_dividend_events(df: DataFrame, *, source_table: str = "provider.dividend") -> DataFrame:
    """S12 (dividends): texts cleaned, blank date texts -> NULL, tolerant numbers."""
    nums = ["stk_div", "stk_bo_rate", "stk_co_rate", "cash_div", "cash_div_tax"]
    return df.select(
        clean_text("ts_code").alias("ts_code"),
        nullable_text("end_date").alias("end_date"),
        nullable_text("ann_date").alias("ann_date"),
        clean_text("div_proc").alias("div_proc"),
        *[number_or_null(c).alias(c) for c in nums],
        *[nullable_text(c).alias(c) for c in ["record_date", "ex_date", "pay_date", "div_listdate"]],
        F.lit(source_table).alias("source_table"),
    )


def normalize_limit_events(df: DataFrame, *, source_table: str = "provider.stk_limit") -> DataFrame:
    """S12 (limits): code cleaned, blank day -> NULL, tolerant numbers."""
    return df.select(
        clean_text("ts_code").alias("ts_code"), nullable_text("trade_date").alias("trade_date"),
        *[number_or_null(c).alias(c) for c in ("up_limit", "down_limit")], F.lit(source_table).alias("source_table"),
    )


def normalize_share_float_events(df: DataFrame, *, source_table: str = "provider.share_float") -> DataFrame:
    """S12 (shares set free): texts cleaned, blank days -> NULL, tolerant numbers."""
    return df.select(
        clean_text("ts_code").alias("ts_code"), *[nullable_text(c).alias(c) for c in ("ann_date", "float_date")],
        *[number_or_null(c).alias(c) for c in ("float_share", "float_ratio")], *[clean_text(c).alias(c) for c in ("holder_name", "share_type")],
        F.lit(source_table).alias("source_table"),
    )


def normalize_repurchase_events(df: DataFrame, *, source_table: str = "provider.repurchase") -> DataFrame:
    """S12 (repurchases): texts cleaned, blank days -> NULL, tolerant numbers."""
    return df.select(
        clean_text("ts_code").alias("ts_code"), *[nullable_text(c).alias(c) for c in ("ann_date", "end_date")], clean_text("proc").alias("proc"), nullable_text("exp_date").alias("exp_date"),
        *[number_or_null(c).alias(c) for c in ("vol", "amount", "high_limit", "low_limit")], F.lit(source_table).alias("source_table"),
    )


def ingest_index_daily(df: DataFrame) -> DataFrame:
    """Drop rows without code, date or close; drop exact duplicates.
    An empty result is an error for the caller to report (see ``require_rows``)."""
    code = clean_text("ts_code")
    day = nullable_text("trade_date")
    close = number_or_null("close")
    return df.select(
        code.alias("ts_code"), day.alias("trade_date"), close.alias("close"),
        *[number_or_null(c).alias(c) for c in ["open", "high", "low", "pre_close", "change", "pct_chg", "vol", "amount"]],
    ).where((F.col("ts_code") != "") & F.col("trade_date").isNotNull() & F.col("close").isNotNull()).dropDuplicates()


def latest_per_key(df: DataFrame, key: str, order: str) -> DataFrame:
    """The last delivered row per key wins (``order`` = delivery order)."""
    w = Window.partitionBy(key).orderBy(F.col(order).desc())
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn", order)


def ingest_benchmark_weights(df: DataFrame, benchmark_id: str | None = None) -> DataFrame:
    """Drop rows without day, member or weight; weight as double; dedupe."""
    bench = F.lit(benchmark_id) if benchmark_id else F.col("benchmark_id")
    return df.select(
        bench.alias("benchmark_id"),
        clean_text("security_id").alias("security_id"),
        nullable_text("trade_date").alias("trade_date"),
        F.col("weight").cast(DoubleType()).alias("weight"),
    ).where(F.col("trade_date").isNotNull() & (F.col("security_id") != "") & F.col("weight").isNotNull()).dropDuplicates()


def require_rows(df: DataFrame, message: str) -> DataFrame:
    """Fail when ``df`` is empty (one ``limit(1)`` probe, no full count)."""
    if not df.limit(1).take(1):
        raise ValueError(message)
    return df

