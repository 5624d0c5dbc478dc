"""Keyed writes and deduplication.

Tables here are plain DataFrames; "writing" a keyed batch produces the new
table version as a DataFrame, and ``write_snapshot`` stores it as a new
Parquet folder (readers never see a half-written table, and the old version
stays readable until the pointer moves).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_wins(df: DataFrame, *, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first by ``order`` (planned with a per-key group limit)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def upsert_replace(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``target`` whose key appears in ``batch`` are replaced by the
    whole batch.  Duplicates inside the batch are all kept; a NULL key never
    matches (plain equality), so such rows are simply appended."""
    batch_keys = batch.select(*keys).where(_all_not_null(keys))
    kept = target.join(batch_keys, list(keys), "left_anti")
    return kept.unionByName(batch.select(*target.columns))


def _all_not_null(keys: Sequence[str]) -> Column:
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return cond


def append_dedup(target: DataFrame, batch: DataFrame, deal: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """D3: append, then drop whole-row duplicates.

    deal: brings equal rows together in the partitions that the caller needs next, so that dropping them takes no shuffle of its own.
    """
    rows = target.unionByName(batch.select(*target.columns))
    return deal(rows).distinct().select(*target.columns) if deal else rows.distinct()


def replace_tables(current: dict[str, DataFrame], batch: dict[str, DataFrame], *, allowed: Sequence[str], mode: str) -> dict[str, DataFrame]:
    """Refresh the selected tables in 'replace' or 'append' mode; names not
    in ``allowed`` are rejected."""
    unknown = sorted(set(batch) - set(allowed))
    if unknown:
        raise ValueError(f"not among the tables to refresh: {', '.join(unknown)}")
    if mode not in ("replace", "append"):
        raise ValueError(f"a refresh is 'replace' or 'append', not {mode}")
    out = dict(current)
    for name, df in batch.items():
        out[name] = df if mode == "replace" or name not in current else append_dedup(current[name], df)
    return out


def high_water_mark(df: DataFrame, axis: str | None) -> DataFrame:
    """One-row frame with the largest value on the incremental axis
    (``None`` axis = static dataset -> NULL mark)."""
    if axis is None:
        return df.sparkSession.range(1).select(F.lit(None).cast("date").alias("last_date"))
    return df.agg(F.max(axis).alias("last_date"))


def effective_since(last_date: _dt.date | None, since: _dt.date | None, static: bool = False) -> _dt.date | None:
    """Next day after the mark, but never before the requested start."""
    if static:
        return None
    nxt = last_date + _dt.timedelta(days=1) if last_date is not None else None
    if nxt is None:
        return since
    if since is None:
        return nxt
    return max(nxt, since)


def incremental_filter(df: DataFrame, axis: str, since: Column | _dt.date | None) -> DataFrame:
    """D8 applied to a source: keep rows on/after ``since`` (pushed to the scan)."""
    if since is None:
        return df
    s = since if isinstance(since, Column) else F.lit(since)
    return df.where(F.col(axis) >= s)


def reset_table(df: DataFrame) -> DataFrame:
    """Empty table with the same schema."""
    return df.limit(0)


def write_snapshot(df: DataFrame, root: str, name: str, version: str, partition_by: Sequence[str] = ()) -> str:
    """Write ``df`` as version ``version`` of table ``name`` under ``root``.

    A new folder per version means a failed or lost write never damages the
    table readers use; callers publish the new path after the write succeeds.
    """
    path = f"{root.rstrip('/')}/{name}/v={version}"
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


STATE_COLUMNS = ["dataset_id", "status", "start_date", "last_date", "row_count", "error"]


def record_state(state: DataFrame, updates: DataFrame) -> DataFrame:
    """Sync-state table with one row per dataset; an update replaces the
    dataset's row (keyed replace on ``dataset_id``)."""
    return upsert_replace(state.select(*STATE_COLUMNS), updates.select(*STATE_COLUMNS), ["dataset_id"])
