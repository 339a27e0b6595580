"""Registered queries over landed files: CSV as people save it, written from ``orders`` and read back by header.

A third of the orders each goes to files whose columns are in the schema's order; in another
order, with a byte order mark, an extra column and two columns left out; and with line breaks and quotes inside
fields.  Some dates are empty or no dates.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martcraft.session import scratch_path
from martcraft.sinks.lake import BOM
from martcraft.sources import files
from martcraft.sources.driver import table


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("k"), (F.col("o_custkey") % 3).alias("v"), F.floor("o_totalprice").alias("tp"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))
    k, tp = F.col("k"), F.col("tp")
    text = lambda c: c.cast("string")
    thousands = F.format_number(tp, 0)
    return o.select(
        "v",
        F.when(k % 29 == 0, F.concat(F.lit("on "), "day")).when(k % 31 == 0, F.lit("  "))
        .when(k % 2 == 0, F.concat("day", F.lit(" 00:00:00"))).otherwise(F.col("day")).alias("report_date"),
        F.when(k % 2 == 0, F.lit(" Brand_A")).otherwise(F.lit("BRAND_B ")).alias("mall"),
        F.when(k % 4 < 2, F.lit("META")).otherwise(F.lit(" gfa")).alias("media"),
        F.when(k % 5 == 0, F.lit("   ")).otherwise(text(k % 50)).alias("campaign_id"),
        F.when(F.col("v") == 2, F.concat(F.lit('line one\nsaid "'), text(k % 7), F.lit('", end')))
        .otherwise(F.concat(F.lit("camp "), text(k % 7))).alias("campaign_name"),
        F.when(k % 2 == 0, F.lit(" own mall ")).otherwise(F.lit("")).alias("landing"),
        thousands.alias("impressions"),
        F.when(k % 11 == 0, F.lit("abc")).otherwise(F.concat(text(k % 100), F.lit(".9"))).alias("clicks"),
        F.when(k % 13 == 0, F.lit("")).otherwise(F.concat(F.lit("₩"), thousands)).alias("cost"),
        F.when(k % 3 == 0, F.lit("")).otherwise(F.concat(text(k % 40), F.lit("%"))).alias("conversions"),
        F.when(k % 6 == 0, F.lit("n/a")).otherwise(F.concat(text(tp), F.lit(".5"))).alias("conversion_value"),
        F.concat(F.lit("type "), text(k % 3)).alias("ad_type"), F.concat(F.lit("https://x.example/?a=1,2&b="), text(k % 9)).alias("url"),
        F.lit("campaign, all").alias("campaign"), F.lit("").alias("adgroup"),
        F.concat(F.lit('"'), text(k % 21), F.lit('"')).alias("keyword"), F.lit("PC").alias("device"), F.lit("seen").alias("note"))


def _save(rows: DataFrame, columns: list[str], lacking: list[str]) -> str:
    path = scratch_path(rows.sparkSession, f"csv/{uuid.uuid4().hex}")
    other = ["note", *[c for c in reversed(columns) if c not in lacking]]
    for v, names in ((0, columns), (1, other), (2, columns)):
        out = rows.where(F.col("v") == v).select(names)
        if v == 1:
            out = out.withColumnRenamed(names[0], BOM + names[0])
        (out.write.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False)
         .option("ignoreTrailingWhiteSpace", False).csv(f"{path}/export-{v}"))
    return path


def _manual(spark: SparkSession, sf_dir: str) -> files.Landed:
    return files.load_manual_ads(spark, _save(_texts(spark, sf_dir), files.MANUAL_COLUMNS, ["landing", "clicks"]))


def q_manual_ads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _manual(spark, sf_dir).rows.drop("source", "loaded_at")


def q_manual_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _manual(spark, sf_dir).rejected.select("reason", "raw.report_date", "raw.campaign_name", "raw.impressions")


def q_keyword_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _save(_texts(spark, sf_dir), files.HISTORY_COLUMNS, ["url", "conversions"])
    return files.load_keyword_history(spark, path).rows.drop("loaded_at")


QUERIES = {
    "src16_manual_ads": q_manual_ads,
    "src16_rejected": q_manual_rejected,
    "src17_keyword_history": q_keyword_history,
}
