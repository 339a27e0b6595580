"""Every registered query against its DuckDB oracle on the smallest scale."""

import math

import pytest

import __spark_entry__ as E
from conftest import SMALL
from martcraft.plans.catalog import QUERIES


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "isoformat"):
        return str(v)[:19]
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(cols, recs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in recs),
                  key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.mark.parametrize("name", sorted(set(E.oracle_sql()) & set(QUERIES)))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SMALL)
    srows = [tuple(r) for r in df.collect()]
    cur = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert _rows(df.columns, srows) == _rows(ocols, orows)


def test_every_query_has_oracle_or_is_documented():
    missing = set(QUERIES) - set(E.oracle_sql())
    assert missing <= set(getattr(E, "NO_ORACLE", {}))


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "net_sales" in df.columns
