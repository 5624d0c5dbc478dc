"""What a table holds, measured while it is written: row count and span, by ``DataFrame.observe``.

A registry, an inventory and a synchronisation state read these few numbers instead of the tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Span:
    """First and last value of a table as SQL expressions of its rows (dates or yyyyMMdd text); None has no span."""

    first: str | None = None
    last: str | None = None


@dataclass(frozen=True)
class Profile:
    rows: int
    first: str | None
    last: str | None


def _metrics(df: DataFrame, span: Span) -> list[Column]:
    def edge(of: str, expression: str | None) -> Column:
        if expression is None:
            return F.lit(None).cast("string")
        kind = df.select(F.expr(expression)).schema[0].dataType.simpleString()
        text = f"date_format({of}({expression}), 'yyyyMMdd')" if kind in ("date", "timestamp", "timestamp_ntz") else f"{of}({expression})"
        return F.expr(text)

    return [F.count(F.lit(1)).alias("rows"), *[c.alias(n) for c, n in ((edge("min", span.first), "first"), (edge("max", span.last), "last")) if span.first is not None]]


def profiled_write(df: DataFrame, span: Span, write: Callable[[DataFrame], None]) -> Profile:
    """Write ``df`` and return what was written; no second pass."""
    seen = Observation(f"profile-{uuid.uuid4().hex}")
    write(df.observe(seen, *_metrics(df, span)))
    found = seen.get
    return Profile(int(found["rows"] or 0), found.get("first"), found.get("last"))


def measured(df: DataFrame, span: Span) -> Profile:
    """The profile of a table that nothing has written here: one aggregate."""
    found = df.agg(*_metrics(df, span)).first().asDict()
    return Profile(int(found["rows"] or 0), found.get("first"), found.get("last"))
