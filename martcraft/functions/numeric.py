"""Numeric text handling and safe arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Plain decimal / scientific numerals only.  Spark's cast also accepts Java
# suffixes such as '1d' or '2f'; the warehouse's SAFE_CAST does not.
NUMERIC_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def safe_double(col: Column | str) -> Column:
    """SAFE_CAST(x AS FLOAT64): numeral text -> double, anything else -> NULL."""
    c = _c(col).cast("string")
    return F.when(c.rlike(NUMERIC_TEXT), c.try_cast("double"))


def strict_double(col: Column | str) -> Column:
    """CAST(x AS FLOAT64): NULL stays NULL, bad text fails the job
    (``raise_error``), whatever the ANSI setting is."""
    c = _c(col).cast("string")
    bad = c.isNotNull() & ~c.rlike(NUMERIC_TEXT)
    return F.when(bad, F.raise_error(F.lit("strict cast to double failed"))).otherwise(c.try_cast("double"))


def clean_money(col: Column | str) -> Column:
    """strip ',', '₩', '%', trim; empty or bad -> NULL."""
    c = F.regexp_replace(F.trim(_c(col).cast("string")), "[,₩%]", "")
    return safe_double(F.nullif(c, F.lit("")))


def first_nonempty(*cols: Column | str) -> Column:
    """F8: first key whose text is non-empty (no fall-through on bad numbers)."""
    return F.coalesce(*[F.nullif(_c(c).cast("string"), F.lit("")) for c in cols])


def metric_or_zero(col: Column | str, as_long: bool = False) -> Column:
    """Empty metric -> 0, text -> double (-> bigint truncating when as_long)."""
    d = F.coalesce(safe_double(F.nullif(_c(col).cast("string"), F.lit(""))), F.lit(0.0))
    return d.cast("bigint") if as_long else d


def safe_ratio(num: Column | str, den: Column | str) -> Column:
    """SAFE_DIVIDE: NULL when the denominator is 0 or NULL."""
    return F.try_divide(_c(num), _c(den))


def js_round(col: Column | str) -> Column:
    """JavaScript Math.round: floor(x + 0.5) (-2.5 -> -2, unlike SQL ROUND)."""
    return F.floor(_c(col) + F.lit(0.5))


def vat_excluded(col: Column | str, scale: int = 2) -> Column:
    return F.round(_c(col) / F.lit(1.1), scale)
