"""Sinks (S16–S18): normalized-bar export, quality extracts, report files.

Writers are distributed (one file per partition); only report frames that
are a handful of rows are ever collected, and only by the caller.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..plans import quality


def export_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: tuple[str, ...] = ()) -> str:
    """Write a table as Parquet or as CSV with a header row."""
    fmt = fmt.lower()
    if fmt not in ("parquet", "csv"):
        raise ValueError(f"unsupported export format: {fmt}")
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "parquet":
        w.parquet(path)
    else:
        w.option("header", "true").csv(path)
    return path


def read_export(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet") -> DataFrame:
    if fmt == "csv":
        return spark.read.schema(schema).option("header", "true").csv(path)
    return spark.read.schema(schema).parquet(path)


def write_quality_extracts(flags: DataFrame, out_dir: str) -> dict[str, str]:
    """Bad dates, bad symbols and execution-restricted rows as CSV folders."""
    out = {}
    for name, df in {
        "bad_dates": quality.bad_dates(flags),
        "bad_symbols": quality.bad_symbols(flags),
        "execution_restricted": quality.execution_restricted(flags).drop("created_at"),
    }.items():
        out[name] = export_table(df, f"{out_dir.rstrip('/')}/{name}", "csv")
    return out


def write_report(df: DataFrame, path: str) -> str:
    """A small report frame (gates, audit checks, summaries) as JSON lines."""
    df.coalesce(1).write.mode("overwrite").json(path)
    return path


def write_quality_report(report: DataFrame, path: str, fmt: str = "json") -> str:
    """The assembled quality report (``plans.report``) as one JSON or Markdown file in the folder ``path``."""
    from ..plans.report import as_json, as_markdown

    text = {"json": as_json, "markdown": as_markdown}[fmt](report)
    report.sparkSession.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return path
