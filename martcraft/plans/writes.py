"""Registered write, re-write and read-back queries for the sinks (SNK2-SNK11, SNK13).

Every query writes all rows of ``orders`` (one per order, dated by the first of its month, so that a date
holds many rows) with one mode, writes again as a re-run or a restatement would, and returns what the table
holds then.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martcraft.session import scratch_path
from martcraft.sinks import lake
from martcraft.sources.driver import table

FROM, TO = dt.date(1994, 1, 1), dt.date(1995, 12, 1)
DAY = "report_date"


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """report_date, mall, order_id, n (the order's amount in whole units)."""
    o = table(spark, sf_dir, "orders")
    return o.select(F.trunc("o_orderdate", "MM").alias(DAY),
                    F.when(F.col("o_orderkey") % 2 == 0, F.lit("brand_a")).otherwise(F.lit("brand_b")).alias("mall"),
                    F.col("o_orderkey").alias("order_id"), F.floor("o_totalprice").alias("n"))


def restated(df: DataFrame) -> DataFrame:
    """Orders of odd months with another amount: what a re-load of a range brings."""
    return df.filter(F.month(DAY) % 2 == 1).withColumn("n", F.col("n") + 1)


def _path(spark: SparkSession) -> str:
    return scratch_path(spark, f"writes/{uuid.uuid4().hex}")


def _back(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select(F.col(DAY).cast("date").alias(DAY), "mall", "order_id", "n")


def q_keep_if_empty(spark, sf):
    path, df = _path(spark), orders(spark, sf)
    lake.replace_table_keep_if_empty(df, path)
    lake.replace_table_keep_if_empty(df.filter("n < 0"), path)
    return _back(spark, path)


def q_replace(spark, sf):
    path, df = _path(spark), orders(spark, sf)
    lake.replace_table(df, path)
    lake.replace_table(restated(df), path)
    return _back(spark, path)


def _ranged(write):
    def query(spark, sf):
        path, df = _path(spark), orders(spark, sf)
        lake.partition_overwrite(df, path)
        for _ in range(2):
            write(restated(df), path)
        return _back(spark, path)
    return query


AS_OF, KEEP_DAYS = dt.date(1998, 8, 1), 3 * 365


def _name_row(df: DataFrame, source: str) -> DataFrame:
    """Manual-ads shaped rows, one per order; every seventh has no campaign name but a medium of its own."""
    unnamed = F.col("order_id") % 7 == 0
    order = F.col("order_id").cast("string")
    return df.select(
        F.when(unnamed, F.concat(F.lit("m"), order)).otherwise(F.lit("m")).alias("media"), "mall", DAY,
        F.when(~unnamed, order).alias("campaign_name"), F.lit("1").alias("campaign_id"),
        F.lit(None).cast("string").alias("landing"), F.col("n").alias("impressions"), F.col("order_id").alias("clicks"),
        F.lit(0.0).alias("cost"), F.lit(0.0).alias("conversions"), F.lit(0.0).alias("conversion_value"),
        F.lit(source).alias("source"), F.lit("x").alias("loaded_at"))


def q_merge(spark, sf):
    """The stored table has a column ``note`` that the restatement does not know: it stays."""
    path, df = _path(spark), orders(spark, sf)
    lake.merge_upsert(_name_row(df, "first").withColumn("note", F.lit("kept")), path)
    new = restated(df)
    later = new.filter(F.year(DAY) == 1996).withColumn(DAY, F.add_months(DAY, 240))
    for _ in range(2):
        lake.merge_upsert(_name_row(new.unionByName(later), "second"), path)
    return lake.read_table(spark, path).select(
        F.col(DAY).cast("date").alias(DAY), "mall", "campaign_name", "source", "note",
        F.col("impressions").alias("n"), F.col("clicks").alias("order_id"))


def q_append(spark, sf):
    path, df = _path(spark), orders(spark, sf)
    lake.append_snapshot(df.withColumn("snapshot_at", F.lit(1)), path)
    lake.append_snapshot(restated(df).withColumn("snapshot_at", F.lit(2)), path)
    return spark.read.parquet(path).select(DAY, "mall", "order_id", "n", "snapshot_at")


def q_snapshots(spark, sf):
    path, df = _path(spark), orders(spark, sf)
    for day, rows in ((FROM, df), (TO, df), (TO, restated(df))):
        lake.snapshot_partition(rows.withColumn("snapshot_date", F.lit(day)), path)
    return spark.read.parquet(path).select(F.col("snapshot_date").cast("date").alias("snapshot_date"), DAY, "mall", "order_id", "n")


def q_mart(spark, sf):
    path, df = _path(spark), orders(spark, sf)
    lake.write_mart(df, path, cluster_by=("mall",))
    lake.write_mart(restated(df), path, cluster_by=("mall",))
    return _back(spark, path)


def q_evolve(spark, sf):
    """SNK11: a stored table gains a column and a wider type; rows from before read the column as NULL."""
    path, df = _path(spark), orders(spark, sf)
    first = T.StructType([T.StructField("mall", T.StringType()), T.StructField("order_id", T.LongType()),
                          T.StructField("n", T.IntegerType()), T.StructField(DAY, T.DateType())])
    lake.ensure_table(spark, path, first, DAY)
    lake.load_declared(df.filter(F.year(DAY) < 1995).withColumn("n", F.col("n").cast("string")), path, DAY)
    wide = T.StructType([T.StructField("n", T.LongType()), T.StructField("note", T.StringType())])
    lake.ensure_table(spark, path, wide, DAY)
    lake.load_declared(df.filter(F.year(DAY) >= 1995).withColumn("note", F.lit("new")), path, DAY)
    return lake.read_table(spark, path)


def q_export(spark, sf):
    path, df = _path(spark), orders(spark, sf)
    lake.export_csv(df, path, ["mall", DAY, "n"])
    back = spark.read.option("header", True).csv(path)
    return back.select(F.col(back.columns[0]).alias("mall"), F.col(DAY).cast("date").alias(DAY), F.col("n").cast("long").alias("n"))


QUERIES = {
    "snk2_keep_if_empty": q_keep_if_empty,
    "snk3_replace": q_replace,
    "snk4_range_replace": _ranged(lambda df, path: lake.range_replace(df, path, FROM, TO, DAY)),
    "snk5_retention": _ranged(lambda df, path: lake.range_replace_with_retention(df, path, FROM, TO, AS_OF, KEEP_DAYS, DAY)),
    "snk6_atomic_range": _ranged(lambda df, path: lake.atomic_range_replace(df, path, FROM, TO, DAY)),
    "snk7_merge": q_merge,
    "snk8_append": q_append,
    "snk9_snapshots": q_snapshots,
    "snk10_mart": q_mart,
    "snk11_evolve": q_evolve,
    "snk13_export": q_export,
}
