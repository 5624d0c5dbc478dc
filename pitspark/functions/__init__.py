"""Column-level helpers (built-in Spark expressions only, no Python UDFs)."""

from .dates import date_key, days_apart, parse_date_key
from .market import board, is_st_name, magnitude_bucket, severity, triage_class
from .text import clean_text, nullable_text, normalize_security_id

__all__ = [
    "board",
    "clean_text",
    "date_key",
    "days_apart",
    "is_st_name",
    "magnitude_bucket",
    "normalize_security_id",
    "nullable_text",
    "parse_date_key",
    "severity",
    "triage_class",
]
