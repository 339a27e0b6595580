"""Landed CSV files, read by the names in their headers (SRC16, SRC17).

People save these files from spreadsheets: columns in any order, some left out, others added, a
byte order mark, quoted fields with line breaks.  The headers are read first (a line per file, on the driver);
files with one header are one scan, its columns chosen by name, and the scans are united by name.
A column that a file lacks is NULL there, a column nobody asked for is ignored, and of a name that
occurs twice the last one counts.  Files whose name starts with ``_`` or ``.`` are examples and skipped.

Rows without a date are dropped; rows whose date text is no date go to a quarantine instead of
failing the load.
"""

from __future__ import annotations

import csv
import io
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martcraft.functions.numeric import clean_money, safe_double

MANUAL_COLUMNS = ["report_date", "mall", "media", "campaign_id", "campaign_name", "landing",
                  "impressions", "clicks", "cost", "conversions", "conversion_value"]
HISTORY_COLUMNS = ["report_date", "mall", "ad_type", "landing", "url", "campaign", "adgroup",
                   "keyword", "device", "impressions", "clicks", "cost", "conversions",
                   "conversion_value"]
FILE = "_file"
#: a header line longer than this is refused (it is held on the driver)
MAX_HEADER_CHARS = 1 << 20


class Landed(NamedTuple):
    """``rows`` in the target schema; ``rejected``: file, reason and the raw texts of what could not be loaded."""
    rows: DataFrame
    rejected: DataFrame


# ------------------------------------------------------------- headers and scans
def csv_files(spark: SparkSession, path: str) -> list[str]:
    """The CSV files of a folder and its subfolders, or the one file ``path`` names."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    if fs.getFileStatus(p).isFile():
        return [p.toString()]
    out, todo = [], [p]
    while todo:
        for st in fs.listStatus(todo.pop()):
            name = st.getPath().getName()
            if name.startswith(("_", ".")):
                continue
            if st.isDirectory():
                todo.append(st.getPath())
            elif name.lower().endswith(".csv"):
                out.append(st.getPath().toString())
    return sorted(out)


def read_header(spark: SparkSession, path: str) -> tuple[str, ...]:
    """Column names of one file; () if it is empty.  A quoted name may hold line breaks."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(fs.open(p), "UTF-8"))
    try:
        text = ""
        while True:
            line = reader.readLine()
            if line is None:
                break
            text += line.removeprefix("﻿") if not text else "\n" + line
            if len(text) > MAX_HEADER_CHARS:
                raise ValueError(f"no header in the first {MAX_HEADER_CHARS} characters of {path}")
            if text.strip() and text.count('"') % 2 == 0:
                break
    finally:
        reader.close()
    return tuple(next(csv.reader(io.StringIO(text)), ()))


def read_by_header(spark: SparkSession, path: str, columns: list[str], multiline: bool = True) -> DataFrame:
    """``columns`` (text) and ``_file`` of all CSV files under ``path``: one scan per distinct header.

    ``multiline`` keeps line breaks inside quotes, for which a file is read by one task; exports known to
    have none can be split by ``multiline=False``."""
    by_header: dict[tuple[str, ...], list[str]] = {}
    for f in csv_files(spark, path):
        by_header.setdefault(read_header(spark, f), []).append(f)
    schema = ", ".join(f"`{c}` string" for c in [*columns, FILE])
    out = None
    for header, files in by_header.items():
        if not header:
            continue
        at = {name: i for i, name in enumerate(header)}
        scan = (spark.read.option("header", True).option("encoding", "UTF-8").option("multiLine", multiline)
                .option("escape", '"').option("mode", "PERMISSIVE")
                .schema(", ".join(f"c{i} string" for i in range(len(header)))).csv(files))
        rows = scan.select(*[(F.col(f"c{at[c]}") if c in at else F.lit(None).cast("string")).alias(c) for c in columns],
                           F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias(FILE))
        out = rows if out is None else out.unionByName(rows)
    return spark.createDataFrame([], schema) if out is None else out


def split_by_date(raw: DataFrame, columns: list[str], date_col: str = "report_date") -> tuple[DataFrame, DataFrame]:
    """(rows with a date in ``_day``, rejected): the date is the first ten characters, trimmed, as year-month-day."""
    text = F.substring(F.trim(F.col(date_col)), 1, 10)
    day = F.when(text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), text.try_cast("date"))
    dated = raw.withColumn("_text", F.coalesce(text, F.lit(""))).where(F.col("_text") != "").withColumn("_day", day)
    rejected = dated.where(F.col("_day").isNull()).select(
        F.col(FILE).alias("source"), F.concat(F.lit(f"{date_col} is no date: "), F.col("_text")).alias("reason"),
        F.struct(*columns).alias("raw"))
    return dated.where(F.col("_day").isNotNull()).drop("_text"), rejected


# ------------------------------------------------------------------ the two files
def _txt(c: str) -> Column:
    return F.nullif(F.trim(F.col(c)), F.lit(""))


def _code(c: str) -> Column:
    return F.lower(F.trim(F.coalesce(F.col(c), F.lit(""))))


def _trunc_long(c: Column) -> Column:
    return F.when(c.isNotNull(), F.floor(F.abs(c)) * F.signum(c)).cast("bigint")


def _int_or_zero(c: str) -> Column:
    """Commas removed, truncated toward zero; empty or bad text gives 0."""
    t = F.trim(F.regexp_replace(F.coalesce(F.col(c), F.lit("")), ",", ""))
    return F.coalesce(_trunc_long(safe_double(F.nullif(t, F.lit("")))), F.lit(0)).cast("bigint")


def load_manual_ads(spark: SparkSession, path: str, multiline: bool = True) -> Landed:
    """SRC16: manual ad rows; numbers cleaned (F7); impressions, clicks and cost default 0, conversions keep NULL."""
    good, rejected = split_by_date(read_by_header(spark, path, MANUAL_COLUMNS, multiline), MANUAL_COLUMNS)
    return Landed(good.select(
        F.col("_day").alias("report_date"), _code("mall").alias("mall"), _code("media").alias("media"),
        *[_txt(c).alias(c) for c in ["campaign_id", "campaign_name", "landing"]],
        *[F.coalesce(_trunc_long(clean_money(c)), F.lit(0)).alias(c) for c in ["impressions", "clicks"]],
        F.coalesce(clean_money("cost"), F.lit(0.0)).alias("cost"),
        *[clean_money(c).alias(c) for c in ["conversions", "conversion_value"]],
        F.col(FILE).alias("source"), F.current_timestamp().alias("loaded_at")), rejected)


def load_keyword_history(spark: SparkSession, path: str, multiline: bool = True) -> Landed:
    """SRC17: keyword history; integer-only cleaning truncates decimals, money too ('3.9' -> 3), bad -> 0."""
    good, rejected = split_by_date(read_by_header(spark, path, HISTORY_COLUMNS, multiline), HISTORY_COLUMNS)
    return Landed(good.select(
        F.col("_day").alias("report_date"), _code("mall").alias("mall"),
        *[_txt(c).alias(c) for c in ["ad_type", "landing", "url", "campaign", "adgroup", "keyword", "device"]],
        _int_or_zero("impressions").alias("impressions"), _int_or_zero("clicks").alias("clicks"),
        _int_or_zero("cost").cast("double").alias("cost"),
        _int_or_zero("conversions").alias("conversions"),
        _int_or_zero("conversion_value").cast("double").alias("conversion_value"),
        F.current_timestamp().alias("loaded_at")), rejected)


def read_manual_ads(spark: SparkSession, path: str) -> DataFrame:
    return load_manual_ads(spark, path).rows


def read_keyword_history(spark: SparkSession, path: str) -> DataFrame:
    return load_keyword_history(spark, path).rows
