"""Registered queries over landed tables as they live: all statistics in one pass, current views that follow the
business date, a catch-up of many exports in one write, and freshness from metadata."""

from __future__ import annotations

import datetime as dt
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martcraft.plans import quality
from martcraft.session import materialize, scratch_path
from martcraft.sinks import lake, views
from martcraft.sources import commerce as SC
from martcraft.sources import driver as D
from martcraft.sources.statistics import shape_stats
from martcraft.streaming import intraday


def q_all_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC3: the 23 reports from one scan of the responses."""
    return shape_stats(D.raw_stat_reports(spark, sf_dir)).drop("raw_json", "ingested_at")


VIEW_DATES = (dt.date(1997, 5, 1), dt.date(2001, 2, 1))


def q_current_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 14 current views, made once and read at two business dates."""
    tag = uuid.uuid4().hex[:8]
    stats = materialize(q_all_reports(spark, sf_dir))
    o = D.orders(spark, sf_dir)
    frames = {name: stats.where(F.col("report") == name).drop("report") for name in views.CURRENT_TABLES}
    frames |= {"orders": o, "order_items": D.order_items(spark, sf_dir, o),
               "order_attribution": SC.shape_order_attribution(D.raw_attribution(spark, sf_dir))}
    pairs = {}
    for name, df in frames.items():
        final, twin = f"{name}_{tag}", f"{name}_d0_{tag}"
        df.createOrReplaceTempView(final)
        df.withColumn("is_intraday", F.lit(True)).createOrReplaceTempView(twin)      # one column more than the final table
        pairs[f"{name}_{tag}"] = (final, twin)
    views.register_live_views(spark, pairs, VIEW_DATES[0])
    out = []
    for day in VIEW_DATES:
        views.set_business_date(spark, day)
        for name in frames:
            df = spark.table(f"{name}_{tag}_current")
            out.append(df.agg(F.count(F.lit(1)).alias("n_rows"), F.count("is_intraday").alias("n_today"),
                              F.max("report_date").alias("newest"))
                       .select(F.lit(day).alias("business_date"), F.lit(name).alias("table_name"), "n_rows", "n_today", "newest"))
    return reduce(DataFrame.unionByName, out)


EXPORTS = 40


def q_catch_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MB1: exports that gathered while the stream was down, each complete for the months it carries, in one write.

    Export e carries the months m with (m + e) mod 5 = 0, and amounts raised by e."""
    root = scratch_path(spark, f"catch-up-{uuid.uuid4().hex}")
    o = D.table(spark, sf_dir, "orders")
    month = F.trunc("o_orderdate", "MM")
    rows = o.select(month.alias("report_date"), F.col("o_orderkey").alias("order_id"), F.floor("o_totalprice").alias("n"),
                    F.explode(F.sequence(F.lit(0), F.lit(EXPORTS - 1))).alias("e")).where(
        (F.year("report_date") * 12 + F.month("report_date") + F.col("e")) % 5 == 0)
    landed = rows.withColumn("n", F.col("n") + F.col("e")).withColumn("export", F.format_string("export-%03d", "e")).drop("e")
    # the exports' names tell their order: files written together may have any times; the write sorts a task's rows
    # by export, so tasks follow the amount of rows and a large export is several part files
    landed.hint("rebalance", "export").write.partitionBy("export").parquet(f"{root}/landing")
    schema = T.StructType([f for f in landed.schema.fields if f.name != "export"] + [T.StructField("export", T.StringType())])
    intraday.intraday_refresh(spark, f"{root}/landing", schema, "parquet",
                              lambda b: b.drop("export"), f"{root}/orders", f"{root}/checkpoint",
                              landed_date=F.col("report_date"), export=F.col("export"), arrived=F.lit(0))
    return spark.read.parquet(f"{root}/orders").select(F.col("report_date").cast("date").alias("report_date"), "order_id", "n")


def q_table_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ1 from metadata: date folders, footers, a missing table, an empty one and a folder without a data file."""
    root = scratch_path(spark, f"fresh-{uuid.uuid4().hex}")
    o = D.table(spark, sf_dir, "orders").select(F.trunc("o_orderdate", "MM").alias("report_date"), "o_orderkey")
    lake.partition_overwrite(o, f"{root}/orders")
    o.select(F.col("report_date").alias("segments_date"), "o_orderkey").write.parquet(f"{root}/stats")
    o.where("o_orderkey < 0").write.parquet(f"{root}/empty")
    lake.partition_overwrite(o.where(F.year("report_date") < 2000), f"{root}/late")
    hollow = o.where("o_orderkey < 0").select("o_orderkey").coalesce(1)
    hollow.write.parquet(f"{root}/late/report_date=2001-08-01")
    lake.drop_files(spark, f"{root}/late/report_date=2001-08-01")
    checks = [quality.TableCheck("commerce orders", "orders", f"{root}/orders", "report_date", 40),
              quality.TableCheck("google ads", "stats", f"{root}/stats", "segments_date", 40),
              quality.TableCheck("empty table", "empty", f"{root}/empty", "report_date", 40),
              quality.TableCheck("missing table", "missing", f"{root}/missing", "report_date", 40),
              quality.TableCheck("late table", "late", f"{root}/late", "report_date", 40),
              quality.TableCheck("missing column", "stats", f"{root}/stats", "no_such_day", 40)]
    return quality.table_freshness(spark, checks, D.AS_OF)


QUERIES = {
    "src3_all_reports": q_all_reports,
    "p2_current_views": q_current_views,
    "mb1_catch_up": q_catch_up,
    "dq1_tables": q_table_freshness,
}
