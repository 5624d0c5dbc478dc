"""Normalized daily bars — the 16-column consumer contract."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.temporal import interval_join

BAR_KEYS = ["security_id", "trade_date"]
# The ordered public columns of the normalized-bar contract.
CONTRACT_COLUMNS = [
    "trade_date", "code", "open", "high", "low", "close", "prev_close", "volume", "amount", "turnover_rate",
    "is_st", "is_paused", "limit_up", "limit_down", "industry_code", "industry_name",
]


def industry_matches(bars: DataFrame, industry_pit: DataFrame) -> DataFrame:
    """Every PIT industry row valid on the bar day, ``[effective_at, removed_at)``.

    Equi-join on security_id with the half-open interval as residual.
    """
    b = bars.select(*BAR_KEYS)
    i = industry_pit.select("security_id", "industry_schema", "industry_code", "industry_name", "effective_at", "removed_at")
    return interval_join(b, i, point="trade_date", start="effective_at", end="removed_at", on="security_id", closed="left")


def level_rank(schema_col: str = "industry_schema") -> F.Column:
    s = F.col(schema_col)
    return F.when(s == "sw2021_l1", F.lit(1)).when(s.like("%_l1"), F.lit(2)).otherwise(F.lit(3))


def canonical_industry(matches: DataFrame) -> DataFrame:
    """One industry per bar — sw2021_l1 first, then other level-1 schemas,
    then the rest; ties by schema and code (NULLs last)."""
    w = Window.partitionBy(*BAR_KEYS).orderBy(
        level_rank().asc(), F.col("industry_schema").asc_nulls_last(), F.col("industry_code").asc_nulls_last()
    )
    return (
        matches.withColumn("_rn", F.row_number().over(w))
        .where(F.col("_rn") == 1)
        .select(*BAR_KEYS, "industry_code", "industry_name", "industry_schema")
    )


def previous_close(bars: DataFrame) -> F.Column:
    """Previous adjusted close of the security, else today's pre_close on the
    same basis (qfq rows as is, unadjusted rows times the factor)."""
    w = Window.partitionBy("security_id").orderBy("trade_date")
    same_basis = F.when(F.col("price_basis") == "qfq_fallback", F.col("pre_close")).otherwise(
        F.col("pre_close") * F.col("adj_factor")
    )
    return F.coalesce(F.lag("close_adj").over(w), same_basis)


def normalized_bars(bars: DataFrame, tradeability: DataFrame, industry_pit: DataFrame) -> DataFrame:
    """Adjusted OHLC, previous close, limits on the bar's price basis and
    the canonical industry; every bar is kept (left joins only).

    ``trade_date`` stays a DateType here; ``contract`` renders the public text form.
    """
    t = tradeability.select(*BAR_KEYS, "is_suspended", "up_limit", "down_limit")
    ind = canonical_industry(industry_matches(bars, industry_pit))
    b = bars.select(
        *BAR_KEYS, "open_adj", "high_adj", "low_adj", "close_adj", "pre_close", "adj_factor", "price_basis",
        "volume_shares", "turnover_value_cny", "turnover_rate_pct", "is_st",
    ).withColumn("prev_close", previous_close(bars))
    j = b.join(t, BAR_KEYS, "left").join(ind, BAR_KEYS, "left")
    qfq = F.col("price_basis") == "qfq_fallback"

    def limit(c: str) -> F.Column:
        return F.when(F.col(c).isNull(), F.lit(None)).when(qfq, F.col(c)).otherwise(F.col(c) * F.col("adj_factor"))

    return j.select(
        "trade_date",
        F.col("security_id").alias("code"),
        F.col("open_adj").alias("open"),
        F.col("high_adj").alias("high"),
        F.col("low_adj").alias("low"),
        F.col("close_adj").alias("close"),
        "prev_close",
        F.col("volume_shares").alias("volume"),
        F.col("turnover_value_cny").alias("amount"),
        F.col("turnover_rate_pct").alias("turnover_rate"),
        F.coalesce(F.col("is_st"), F.lit(False)).alias("is_st"),
        F.coalesce(F.col("is_suspended"), F.lit(False)).alias("is_paused"),
        limit("up_limit").alias("limit_up"),
        limit("down_limit").alias("limit_down"),
        F.coalesce(F.col("industry_code"), F.lit("UNKNOWN")).alias("industry_code"),
        F.coalesce(F.col("industry_name"), F.col("industry_code"), F.lit("UNKNOWN")).alias("industry_name"),
    )


def contract(normalized: DataFrame) -> DataFrame:
    """The public layout: ordered columns, ``trade_date`` as yyyyMMdd text."""
    return normalized.withColumn("trade_date", F.date_format("trade_date", "yyyyMMdd")).select(*CONTRACT_COLUMNS)
