"""Date keys.

Provider tables carry dates as text: ``yyyyMMdd`` from most feeds,
``yyyy-MM-dd`` or ``yyyy-MM-dd HH:mm:ss`` from others, blanks and sentinel
words for "no date".  Inside the library every date is a ``DateType`` so that
interval and as-of predicates compare days, not strings; at the contract
boundary dates are written back as ``yyyyMMdd`` text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, TimestampNTZType, TimestampType

from .text import clean_text

KEY_FORMAT = "yyyyMMdd"


def col_of(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_date_key(c: Column | str, data_type=None) -> Column:
    """Any provider date representation -> DateType (NULL when blank or invalid).

    ``yyyyMMdd`` (8 characters) is read as is; anything longer is read from its
    first ten characters as ``yyyy-MM-dd``.  An 8-digit text that is not a real
    day (``20001345``) becomes NULL instead of failing the job.
    """
    if isinstance(data_type, DateType):
        return col_of(c)
    if isinstance(data_type, (TimestampType, TimestampNTZType)):
        return F.to_date(col_of(c))
    text = clean_text(col_of(c).cast(StringType()))
    return (
        F.when(text == "", F.lit(None).cast(DateType()))
        .when(F.length(text) == 8, F.try_to_date(text, KEY_FORMAT))
        .otherwise(F.try_to_date(F.substring(text, 1, 10), "yyyy-MM-dd"))
    )


def date_key(c: Column | str) -> Column:
    """DateType -> ``yyyyMMdd`` text (NULL stays NULL)."""
    return F.date_format(col_of(c), KEY_FORMAT)


def days_apart(a: Column | str, b: Column | str) -> Column:
    """Absolute distance in days between two dates."""
    return F.abs(F.datediff(col_of(b), col_of(a)))


def year_key(c: Column | str) -> Column:
    return F.date_format(col_of(c), "yyyy")
