"""Helpers for landed JSON records: parse once into map<string,string>.

Values that are objects or arrays keep their raw JSON text, scalars their
text, so "first non-empty key" and safe numeric parsing work uniformly.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martcraft.functions.numeric import first_nonempty, safe_double

RECORD = T.MapType(T.StringType(), T.StringType())


def parse_record(col: Column | str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.from_json(c, RECORD)


def s(rec: Column, *keys: str) -> Column:
    """First key whose value is not NULL/empty, as text (reference ``_s``).
    ``rec`` may be a parsed map or a struct of string fields."""
    return first_nonempty(*[rec[k] for k in keys])


def f(rec: Column, *keys: str) -> Column:
    """Numeric value of the first non-empty key; bad text -> NULL, no
    fall-through to later keys (reference ``_f``)."""
    return safe_double(s(rec, *keys))


def explode_list(text: Column) -> Column:
    """JSON array text -> one raw JSON text per element (non-outer)."""
    return F.explode(F.from_json(text, T.ArrayType(T.StringType())))


def is_list(text: Column) -> Column:
    return F.ltrim(F.coalesce(text, F.lit(""))).startswith("[")


def first_list(rec_text: Column, keys: list[str], parsed: Column | None = None) -> Column:
    """Reference ``_extract_list``: the response itself if it is a list, else
    the first candidate key holding a list, else the first list value."""
    rec = parsed if parsed is not None else parse_record(rec_text)
    cands = [F.when(is_list(rec[k]), rec[k]) for k in keys]
    any_list = F.try_element_at(F.filter(F.map_values(rec), lambda v: is_list(v)), F.lit(1))
    return F.when(is_list(rec_text), rec_text).otherwise(F.coalesce(*cands, any_list))
