"""Date helpers (F9, F10, PRJ10).  Bounds are literals so Catalyst folds them
into partition filters."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col):
    return F.col(col) if isinstance(col, str) else col


def years_before(as_of: dt.date, years: int) -> Column:
    return F.add_months(F.lit(as_of), -12 * years)


def days_before(as_of: dt.date, days: int) -> Column:
    return F.date_sub(F.lit(as_of), days)


def since(col, as_of: dt.date, *, years: int | None = None, days: int | None = None) -> Column:
    """PRJ10: ``col >= as_of - N years / days`` (inclusive)."""
    bound = years_before(as_of, years) if years is not None else days_before(as_of, days or 0)
    return _c(col) >= bound


def normalise_date(col) -> Column:
    """'yyyyMMdd', 'yyyy.MM.dd', 'yyyy-MM-dd' (optionally with a time) -> date."""
    s = F.trim(_c(col).cast("string"))
    dashed = F.regexp_replace(s, r"\.", "-")
    return F.coalesce(
        F.when(s.rlike(r"^\d{8}$"), F.try_to_date(s, "yyyyMMdd")),
        F.when(dashed.rlike(r"^\d{4}-\d{2}-\d{2}"), F.try_to_date(F.substring(dashed, 1, 10), "yyyy-MM-dd")),
    )


def lag_days(as_of: dt.date, col) -> Column:
    return F.datediff(F.lit(as_of), _c(col))
