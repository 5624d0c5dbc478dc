"""Conforming provider tables to the raw-layer contract.

* two-source resolution: the supplemental database wins for reference tables;
  for events every source holding the table is listed, supplemental first;
* required-column checks raise ``ValueError`` listing the missing names;
* ``conform`` selects, casts, turns blank text into NULL, parses date text
  into ``DateType`` and fills absent optional columns with typed NULLs;
* an absent optional table becomes a typed empty DataFrame.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, DoubleType, StringType, StructField, StructType, TimestampType

from ..functions.dates import parse_date_key
from ..functions.text import blank_to_null

SOURCE, SUPPLEMENTAL = "source", "supplemental"
SOURCE_RANK = {SOURCE: 1, SUPPLEMENTAL: 2}

S, D, T, DT = StringType(), DoubleType(), TimestampType(), DateType()


def preferred_source(sources: Mapping[str, Mapping[str, DataFrame]], table: str) -> tuple[str, DataFrame] | None:
    """Supplemental copy if present, else source copy, else None."""
    for alias in (SUPPLEMENTAL, SOURCE):
        df = sources.get(alias, {}).get(table)
        if df is not None:
            return alias, df
    return None


def sources_with_table(sources: Mapping[str, Mapping[str, DataFrame]], table: str) -> list[tuple[str, DataFrame]]:
    return [(a, sources[a][table]) for a in (SUPPLEMENTAL, SOURCE) if table in sources.get(a, {})]


def require_columns(df: DataFrame, required: Iterable[str], label: str) -> None:
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"{label} is missing required columns: {', '.join(missing)}")


def conform(
    df: DataFrame,
    fields: list[tuple[str, DataType]],
    *,
    dates: Iterable[str] = (),
    blank_null: Iterable[str] = (),
    defaults: Mapping[str, object] | None = None,
    optional: Iterable[str] = (),
) -> DataFrame:
    """Select ``fields`` in order with their types.

    ``dates`` are parsed from provider text into DateType (blank -> NULL);
    ``blank_null`` text columns get ``NULLIF(x, '')``; ``defaults`` replace
    NULL; ``optional`` columns absent from ``df`` become typed NULLs.
    """
    dates, blank_null, optional = set(dates), set(blank_null), set(optional)
    defaults = dict(defaults or {})
    types = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for name, dtype in fields:
        if name not in types:
            if name in optional or name in defaults:
                c = F.lit(defaults.get(name)).cast(dtype if name not in dates else S)
            else:
                raise ValueError(f"missing required column: {name}")
        else:
            c = F.col(name)
        if name in dates:
            c = parse_date_key(c, types.get(name))
        elif name in blank_null:
            c = blank_to_null(c)
        else:
            c = c.cast(dtype)
        if name in defaults and defaults[name] is not None:
            c = F.coalesce(c, F.lit(defaults[name]).cast(dtype))
        out.append(c.alias(name))
    return df.select(*out)


def empty_table(spark: SparkSession, fields: list[tuple[str, DataType]]) -> DataFrame:
    schema = StructType([StructField(n, t, True) for n, t in fields])
    return spark.createDataFrame([], schema)


# ---------------------------------------------------------------- layouts
INDUSTRY_PIT = [("security_id", S), ("industry_schema", S), ("industry_code", S), ("industry_name", S),
                ("effective_at", DT), ("removed_at", DT)]
BENCHMARK_MEMBERSHIP_PIT = [("benchmark_id", S), ("security_id", S), ("effective_at", DT), ("removed_at", DT)]
BENCHMARK_WEIGHT_PIT = [("benchmark_id", S), ("security_id", S), ("trade_date", DT), ("weight", D)]
INDEX_BASIC = [("ts_code", S), ("name", S), ("market", S), ("publisher", S), ("category", S), ("base_date", DT),
               ("base_point", D), ("list_date", DT)]
INDEX_DAILY = [("ts_code", S), ("trade_date", DT), ("close", D), ("open", D), ("high", D), ("low", D),
               ("pre_close", D), ("change", D), ("pct_chg", D), ("vol", D), ("amount", D), ("source_table", S),
               ("ingested_at", T)]
DIVIDEND = [("ts_code", S), ("end_date", DT), ("ann_date", DT), ("div_proc", S), ("stk_div", D), ("stk_bo_rate", D),
            ("stk_co_rate", D), ("cash_div", D), ("cash_div_tax", D), ("record_date", DT), ("ex_date", DT),
            ("pay_date", DT), ("div_listdate", DT), ("source_table", S), ("ingested_at", T)]
STK_LIMIT = [("ts_code", S), ("trade_date", DT), ("up_limit", D), ("down_limit", D), ("source_table", S),
             ("ingested_at", T)]
SUSPEND = [("ts_code", S), ("trade_date", DT), ("suspend_timing", S), ("suspend_type", S), ("source_table", S),
           ("ingested_at", T)]
SHARE_FLOAT = [("ts_code", S), ("ann_date", DT), ("float_date", DT), ("float_share", D), ("float_ratio", D),
               ("holder_name", S), ("share_type", S), ("source_table", S), ("ingested_at", T)]
REPURCHASE = [("ts_code", S), ("ann_date", DT), ("end_date", DT), ("proc", S), ("exp_date", DT), ("vol", D),
              ("amount", D), ("high_limit", D), ("low_limit", D), ("source_table", S), ("ingested_at", T)]
EVENT_LAYOUTS = {
    "raw_dividend": DIVIDEND,
    "raw_stk_limit": STK_LIMIT,
    "raw_suspend_d": SUSPEND,
    "raw_share_float": SHARE_FLOAT,
    "raw_repurchase": REPURCHASE,
}
_DATE_FIELDS = {name: [n for n, t in fields if t == DT] for name, fields in EVENT_LAYOUTS.items()}


def conform_pit_table(sources, table: str) -> DataFrame | None:
    """Industry / membership / weight PIT tables (supplemental preferred)."""
    found = preferred_source(sources, table)
    if found is None:
        return None
    alias, df = found
    if table == "industry_classification_pit":
        require_columns(df, {"security_id", "industry_schema", "industry_code", "effective_at", "removed_at"}, f"{alias}.{table}")
        return conform(df, INDUSTRY_PIT, dates=["effective_at", "removed_at"], optional=["industry_name"])
    if table == "benchmark_membership_pit":
        require_columns(df, {"benchmark_id", "security_id", "effective_at", "removed_at"}, f"{alias}.{table}")
        return conform(df, BENCHMARK_MEMBERSHIP_PIT, dates=["effective_at", "removed_at"])
    if table == "benchmark_weight_snapshot_pit":
        require_columns(df, {"benchmark_id", "security_id", "trade_date", "weight"}, f"{alias}.{table}")
        return conform(df, BENCHMARK_WEIGHT_PIT, dates=["trade_date"])
    raise ValueError(f"{table} is no point-in-time table")


def conform_index_table(sources, table: str) -> DataFrame | None:
    """Index reference and index daily bars (supplemental preferred)."""
    found = preferred_source(sources, table)
    if found is None:
        return None
    alias, df = found
    layout = INDEX_BASIC if table == "index_basic_ref" else INDEX_DAILY if table == "raw_index_daily" else None
    if layout is None:
        raise ValueError(f"{table} is no index table")
    require_columns(df, {n for n, _ in layout}, f"{alias}.{table}")
    return conform(df, layout, dates=[n for n, t in layout if t == DT], defaults={"source_table": table} if table == "raw_index_daily" else None)


def conform_event_table(spark: SparkSession, sources, table: str) -> tuple[DataFrame, list[tuple[str, DataFrame]]]:
    """Event tables; blank date text -> NULL; absent -> typed empty.

    Returns the conformed first (supplemental-preferred) copy and every
    conformed copy with its source alias (limits merge all of them, D2).
    """
    layout = EVENT_LAYOUTS[table]
    copies = sources_with_table(sources, table)
    if not copies:
        return empty_table(spark, layout), []
    required = {n for n, _ in layout}
    for alias, df in copies:
        require_columns(df, required, f"{alias}.{table}")
    conformed = [(a, conform(df, layout, dates=_DATE_FIELDS[table], defaults={"source_table": table})) for a, df in copies]
    return conformed[0][1], conformed
