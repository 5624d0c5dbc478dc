"""DuckDB oracle SQL for the correctness gate.

Each query is a ``WITH`` chain over the driver views: the raw provider layer
(``derive_sql``), the research layer (``pipeline_sql``) and a final SELECT.
Only the CTEs a query references (transitively) are emitted.
"""

from __future__ import annotations

import re

from .derive_sql import CTES as DERIVE_CTES
from .pipeline_sql import CTES as PIPELINE_CTES
from .queries_sql import QUERIES

ALL_CTES: list[tuple[str, str]] = DERIVE_CTES + PIPELINE_CTES
_NAMES = [name for name, _ in ALL_CTES]
_BODY = dict(ALL_CTES)
_WORD = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


_LITERAL = re.compile(r"'(?:[^']|'')*'")


def _refs(sql: str) -> set[str]:
    """CTE names used in ``sql`` (words inside string literals do not count)."""
    return {w for w in _WORD.findall(_LITERAL.sub("''", sql)) if w in _BODY}


def compose(final_sql: str) -> str:
    """WITH chain of the CTEs ``final_sql`` needs, dependencies first."""
    order: list[str] = []
    seen: set[str] = set()

    def visit(name: str) -> None:
        if name in seen:
            return
        seen.add(name)
        for dep in sorted(_refs(_BODY[name]) - {name}, key=_NAMES.index):
            visit(dep)
        order.append(name)

    for name in sorted(_refs(final_sql), key=_NAMES.index):
        visit(name)
    if not order:
        return final_sql
    return "WITH " + ",\n".join(f"{n} AS ({_BODY[n]}\n)" for n in order) + "\n" + final_sql


def oracle_sql() -> dict[str, str]:
    return {key: compose(sql) for key, sql in QUERIES.items()}
