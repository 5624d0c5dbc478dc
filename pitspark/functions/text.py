"""Text cleaning and security-code normalisation (per-row, JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

# Words a provider uses for "no value" (compared lower-cased).
SENTINEL_WORDS = ["none", "nan", "nat"]


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(c: Column | str) -> Column:
    """Trimmed text; NULL and sentinel words become ''."""
    t = F.trim(_c(c).cast(StringType()))
    return F.when(t.isNull() | F.lower(t).isin(*SENTINEL_WORDS), F.lit("")).otherwise(t)


def nullable_text(c: Column | str) -> Column:
    """Trimmed text; blanks and sentinel words become NULL."""
    t = clean_text(c)
    return F.when(t == "", F.lit(None).cast(StringType())).otherwise(t)


def blank_to_null(c: Column | str) -> Column:
    """``NULLIF(CAST(c AS STRING), '')`` — blank text to NULL without trimming."""
    return F.nullif(_c(c).cast(StringType()), F.lit(""))


def number_or_null(c: Column | str) -> Column:
    """Text -> double; blank or unparseable -> NULL."""
    t = clean_text(c)
    return F.when(t == "", F.lit(None).cast(DoubleType())).otherwise(t.try_cast(DoubleType()))


def strip_integral_fraction(c: Column | str) -> Column:
    """'801780.0' -> '801780' (only when the fraction is all zeros)."""
    t = clean_text(c)
    return F.regexp_replace(t, r"^([0-9]+)\.0+$", "$1")


def zfill(c: Column | str, width: int) -> Column:
    """Left-pad with zeros to ``width``; longer input is kept whole (unlike lpad)."""
    t = _c(c)
    return F.when(F.length(t) >= width, t).otherwise(F.lpad(t, width, "0"))


def digits_only(c: Column | str) -> Column:
    return F.regexp_replace(strip_integral_fraction(c), r"[^0-9]", "")


def normalize_security_id(c: Column | str) -> Column:
    """Loose code text -> 'NNNNNN.EX' (6 -> SH, 4/8 -> BJ, else SZ); '' when no digits."""
    digits = digits_only(c)
    symbol = zfill(digits, 6)
    exchange = (
        F.when(symbol.startswith("6"), F.lit("SH"))
        .when(symbol.startswith("4") | symbol.startswith("8"), F.lit("BJ"))
        .otherwise(F.lit("SZ"))
    )
    return F.when(digits == "", F.lit("")).otherwise(F.concat(symbol, F.lit("."), exchange))


def normalize_industry_code(c: Column | str) -> Column:
    digits = digits_only(c)
    return F.when(digits == "", F.lit("")).otherwise(zfill(digits, 6))
