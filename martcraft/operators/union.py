"""Unions (SO1-SO4) and schema alignment (SNK11, DQ2)."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class SchemaDriftError(ValueError):
    pass


def schema_drift(a: DataFrame, b: DataFrame) -> list[str]:
    """DQ2: differences between two schemas (order, type, presence)."""
    fa = {f.name: f.dataType for f in a.schema.fields}
    fb = {f.name: f.dataType for f in b.schema.fields}
    out = []
    for n in fa.keys() - fb.keys():
        out.append(f"only in left: {n}")
    for n in fb.keys() - fa.keys():
        out.append(f"only in right: {n}")
    for n in fa.keys() & fb.keys():
        if fa[n] != fb[n]:
            out.append(f"type differs: {n} {fa[n].simpleString()} vs {fb[n].simpleString()}")
    common_a = [n for n in a.columns if n in fb]
    common_b = [n for n in b.columns if n in fa]
    if common_a != common_b:
        out.append("column order differs")
    return sorted(out)


def _widen(a: T.DataType, b: T.DataType) -> T.DataType | None:
    if a == b:
        return a
    num = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType)
    if isinstance(a, num) and isinstance(b, num):
        if isinstance(a, (T.FloatType, T.DoubleType)) or isinstance(b, (T.FloatType, T.DoubleType)):
            return T.DoubleType()
        return T.LongType()
    if isinstance(a, T.NullType):
        return b
    if isinstance(b, T.NullType):
        return a
    return None


def common_schema(*dfs: DataFrame) -> dict[str, T.DataType]:
    """Columns of all frames in order of appearance, with the widened types."""
    if not dfs:
        raise ValueError("nothing to union")
    types: dict[str, T.DataType] = {}
    for df in dfs:
        for f in df.schema.fields:
            w = _widen(types[f.name], f.dataType) if f.name in types else f.dataType
            if w is None:
                raise SchemaDriftError(
                    f"column {f.name}: {types[f.name].simpleString()} vs {f.dataType.simpleString()}")
            types[f.name] = w
    return types


def align_union(*dfs: DataFrame) -> DataFrame:
    """SO3: union by name, missing columns become NULL, numeric types widen
    (bigint with double -> double); any other type clash raises."""
    types = common_schema(*dfs)

    def conform(df: DataFrame) -> DataFrame:
        have = set(df.columns)
        return df.select([
            (F.col(n) if n in have else F.lit(None)).cast(t).alias(n) for n, t in types.items()])

    return reduce(lambda x, y: x.unionByName(y), [conform(d) for d in dfs])


def current_view(base: DataFrame, intraday: DataFrame, as_of: dt.date,
                 date_col: str = "report_date") -> DataFrame:
    """SO2: closed days from the final table, the business day from its
    intraday twin.  Both filters are literal, so each side prunes partitions."""
    past = base.filter(F.col(date_col) < F.lit(as_of))
    today = intraday.filter(F.col(date_col) == F.lit(as_of))
    return align_union(past, today)
