"""Data-quality checks (DQ1, DQ2).

DQ1 for frames turns every table's MAX(date) into one row (a global aggregate that is
partial-aggregated per partition), unions them, and only then looks at the
result: one row per checked table is the only thing brought to the driver.

DQ1 for landed tables reads no row: the newest date folder that holds a data file, or, where the
date is a column of the files, the largest value of their footers (the maximum is pushed into the
Parquet scan, so Spark spreads the footers over tasks).  A missing or empty table is reported.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martcraft.operators.union import schema_drift
from martcraft.sinks import lake


@dataclass(frozen=True)
class FreshnessCheck:
    label: str
    table: str
    df: DataFrame | Callable[[], DataFrame]     # a reader may fail: the table is then stale
    date_col: str
    max_lag_days: int


@dataclass(frozen=True)
class TableCheck:
    label: str
    table: str
    path: str
    date_col: str
    max_lag_days: int


def _reported(rows: DataFrame, as_of: dt.date) -> DataFrame:
    """label, table_name, max_date, allowed_days -> the report's columns."""
    out = rows.select("label", "table_name", "max_date", F.datediff(F.lit(as_of), F.col("max_date")).alias("lag_days"),
                      "allowed_days")
    ok = F.col("max_date").isNotNull() & (F.col("lag_days") <= F.col("allowed_days"))
    latest = F.concat(F.lit("latest "), F.col("max_date").cast("string"), F.lit(" (lag "), F.col("lag_days").cast("string"),
                      F.lit(" / allowed "), F.col("allowed_days").cast("string"), F.lit(")"))
    return out.select("*", F.coalesce(ok, F.lit(False)).alias("ok"),
                      F.when(F.col("max_date").isNull(), F.lit("no data")).otherwise(latest).alias("detail"))


def newest_folder(spark: SparkSession, path: str, date_col: str) -> dt.date | None:
    """The newest ``date_col=day`` folder that holds a data file, from the folder listing alone."""
    folders = {v: d for v, d in lake.list_partitions(spark, path, date_col).items() if v[:4].isdigit()}
    for day in sorted(folders, reverse=True):
        if lake.has_data(spark, folders[day]):
            return dt.date.fromisoformat(day[:10])
    return None


def footer_session(spark: SparkSession) -> SparkSession:
    """A session on the same context that answers MAX from Parquet footers; the caller's settings stay as they are."""
    meta = spark.newSession()
    meta.conf.set("spark.sql.sources.useV1SourceList", "avro,csv,json,kafka,orc,text")
    meta.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return meta


def newest_in_footers(spark: SparkSession, path: str, date_col: str) -> DataFrame:
    """One row: the largest date in the files' footers (a date or whole-number column; others are read)."""
    return footer_session(spark).read.parquet(path).agg(F.max(date_col).alias("max_date"))


def newest_date(spark: SparkSession, path: str, date_col: str) -> dt.date | None:
    """The table's newest date without reading rows; None if it is missing, empty or lacks the column."""
    if not lake.table_exists(spark, path):
        return None
    if lake.list_partitions(spark, path, date_col):
        return newest_folder(spark, path, date_col)
    try:
        found = newest_in_footers(spark, path, date_col).first()[0]      # one row
    except AnalysisException:
        return None
    return found.date() if isinstance(found, dt.datetime) else found


def table_freshness(spark: SparkSession, checks: list[TableCheck], as_of: dt.date) -> DataFrame:
    rows = [(c.label, c.table, newest_date(spark, c.path, c.date_col), c.max_lag_days) for c in checks]
    return _reported(spark.createDataFrame(rows, "label string, table_name string, max_date date, allowed_days int"), as_of)


def freshness(checks: list[FreshnessCheck], as_of: dt.date) -> DataFrame:
    rows = []
    spark = SparkSession.active()
    for c in checks:
        try:
            df = c.df if isinstance(c.df, DataFrame) else c.df()
            mx = df.agg(F.max(F.col(c.date_col).cast("date")).alias("max_date"))
        except AnalysisException:                    # missing table or column: reported, the others go on
            mx = spark.range(1).select(F.lit(None).cast("date").alias("max_date"))
        rows.append(mx.select(F.lit(c.label).alias("label"), F.lit(c.table).alias("table_name"), "max_date",
                              F.lit(c.max_lag_days).alias("allowed_days")))
    return _reported(reduce(DataFrame.unionByName, rows), as_of)


class StaleDataError(RuntimeError):
    pass


def assert_fresh(result: DataFrame) -> list[dict]:
    """Raise (non-zero exit for the scheduler) when any table is stale."""
    rows = [r.asDict() for r in result.collect()]     # one row per checked table
    stale = [r for r in rows if not r["ok"]]
    if stale:
        raise StaleDataError("; ".join(f"{r['label']}: {r['detail']}" for r in stale))
    return rows


def check_drift(final: DataFrame, intraday: DataFrame) -> list[str]:
    """DQ2: column order / type / presence differences of a final-intraday pair."""
    return schema_drift(final, intraday)
