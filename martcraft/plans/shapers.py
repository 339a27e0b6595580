"""Registered queries over shapers and views that the marts do not reach (SRC5, SRC6, SRC8, SRC12, SRC15, MB4, D1,
PRJ6, PRJ16, F9): records as their sources send them, written from the benchmark tables."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martcraft.session import scratch_path
from martcraft.sinks import lake
from martcraft.sources import ads as SA
from martcraft.sources import analytics as GA
from martcraft.sources import commerce as SC
from martcraft.sources import driver as D
from martcraft.streaming import intraday


def _text(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("c"), F.floor("o_totalprice").alias("tp"),
        F.to_date("o_orderdate").alias("day"))


def q_products(spark, sf_dir):
    """SRC5: one record per part; prices with a comma are no numbers, empty ones NULL."""
    p, k = D.table(spark, sf_dir, "part"), F.col("p_partkey")
    price = F.format_string("%.2f", F.col("p_retailprice"))
    rec = F.struct(_text(k).alias("product_no"), F.col("p_name").alias("product_name"),
                   F.when(k % 7 == 0, F.lit("1,000")).otherwise(price).alias("price"),
                   F.when(k % 5 == 0, F.lit("")).otherwise(price).alias("retail_price"),
                   F.when(k % 2 == 0, F.lit("T")).otherwise(F.lit("F")).alias("display"), F.lit("T").alias("selling"))
    raw = p.select(F.to_json(rec).alias("value"), (k % 2 + 1).alias("shop_no"), F.lit(D.BRAND_A).alias("mall"))
    return SC.snapshot_products(raw, D.AS_OF).drop("raw_json", "ingested_at")


def q_customers(spark, sf_dir):
    """SRC6: one record per customer, the group as a number or missing."""
    c, k = D.table(spark, sf_dir, "customer"), F.col("c_custkey")
    rec = F.struct(F.concat(F.lit("m"), _text(k)).alias("member_id"), F.when(k % 3 != 0, F.col("c_nationkey")).alias("group_no"),
                   F.lit("2020-01-02T03:04:05+09:00").alias("created_date"))
    raw = c.select(F.to_json(rec).alias("value"), F.lit(1).alias("shop_no"), F.lit(D.BRAND_A).alias("mall"))
    return SC.snapshot_customers(raw, D.AS_OF).drop("raw_json", "ingested_at")


def q_meta_records(spark, sf_dir):
    """SRC8: the full ad record; requested account where the record has none, bad numbers, nested fields as text."""
    o, k = _orders(spark, sf_dir), F.col("k")
    fields = {c: F.lit(None).cast("string") for c in [*SA.META_TEXT, *SA.META_NUMBERS]}
    fields |= {"account_id": F.when(k % 4 == 0, F.lit("")).otherwise(F.concat(F.lit("a"), _text(k % 3))),
               "campaign_id": F.concat(F.lit("c"), _text(k % 9)), "ad_id": _text(k), "ad_name": F.lit('the "ad", 1'),
               "date_start": F.date_format("day", "yyyy-MM-dd"), "spend": F.concat(_text("tp"), F.lit(".25")),
               "impressions": _text(k), "clicks": F.when(k % 6 == 0, F.lit("n/a")).otherwise(_text(k % 50)),
               "frequency": F.lit("1e0"), "ctr": F.lit("")}
    kind = F.when(k % 2 == 0, F.lit("purchase")).otherwise(F.lit("omni_purchase"))
    acts = F.array(F.struct(F.lit("like").alias("action_type"), F.lit("9").alias("value")),
                   F.struct(kind.alias("action_type"), _text(k % 5).alias("value")))
    rec = F.struct(*[v.alias(n) for n, v in fields.items()], acts.alias("actions"), acts.alias("action_values"))
    raw = o.select(F.to_json(rec).alias("value"), F.lit("asked").alias("account"))
    return SA.shape_meta(raw).select("account_id", "campaign_id", "ad_id", "ad_name", "objective", "spend", "impressions",
                                     "clicks", "frequency", "ctr", "actions", "outbound_clicks", "web_purchase_value",
                                     "web_purchase_count", "report_date")


def _report(o: DataFrame, *dims: Column) -> DataFrame:
    """Display-ad report rows: the day in three spellings, numbers as text, some empty or no numbers."""
    k = F.col("k")
    start = (F.when(k % 3 == 0, F.date_format("day", "yyyyMMdd")).when(k % 3 == 1, F.date_format("day", "yyyy.MM.dd"))
             .otherwise(F.concat(F.date_format("day", "yyyy-MM-dd"), F.lit(" 09:00"))))
    return o.select(start.alias("start"), F.concat(F.lit("acc"), _text(F.col("c") % 3)).alias("ad_account_id"), *dims,
                    F.when(k % 5 == 0, F.lit("")).otherwise(_text("tp")).alias("imp"),
                    F.when(k % 7 == 0, F.lit("x")).otherwise(F.concat(_text(k % 100), F.lit(".9"))).alias("click"),
                    F.concat(_text("tp"), F.lit(".5")).alias("cost"))


def q_creative_formats(spark, sf_dir):
    """SRC12 + PRJ6 + F9: creative formats dealt to the display and the message table."""
    fmt = F.element_at(F.array(F.lit("IMAGE_Banner"), F.lit("Message_image"), F.lit(None).cast("string"), F.lit("video")),
                       (F.col("k") % 4 + 1).cast("int"))
    display, message = SA.route_creative_formats(_report(_orders(spark, sf_dir), fmt.alias("creative_format")))
    return (display.withColumn("target", F.lit("display")).unionByName(message.withColumn("target", F.lit("message")),
                                                                       allowMissingColumns=True))


def q_ad_groups(spark, sf_dir):
    """SRC12: campaign and ad-group rows with their names; ids from 40 on have none."""
    o = _orders(spark, sf_dir)
    g = F.concat(F.lit("g"), _text(F.col("k") % 50))
    known = (o.where(F.col("k") % 50 < 40).select(
        F.concat(F.lit("acc"), _text(F.col("c") % 3)).alias("ad_account_id"), g.alias("id"),
        F.concat(F.lit("name "), _text(F.col("k") % 50)).alias("name"),
        F.concat(F.lit("c"), _text(F.col("k") % 50 % 7)).alias("campaign_id")).distinct())
    groups = SA.kakao_adgroup_rows(_report(o, g.alias("adgroup_id")),
                                   known.withColumnsRenamed({"id": "adgroup_id", "name": "adgroup_name"}))
    campaigns = SA.kakao_campaign_rows(_report(o, g.alias("campaign_id")), known.select(
        "ad_account_id", F.col("id").alias("campaign_id"), F.col("name").alias("campaign_name")))
    return groups.unionByName(campaigns, allowMissingColumns=True)


def q_items(spark, sf_dir):
    """SRC15: item report rows; empty counts are 0, fractions cut, a malformed date quarantined."""
    o, k = _orders(spark, sf_dir), F.col("k")
    rows = o.select(
        F.lit(D.BRAND_A).alias("brand"), F.lit("p").alias("property_id"),
        F.when(k % 13 == 0, F.lit("(other)")).otherwise(F.date_format("day", "yyyyMMdd")).alias("date"),
        F.concat(F.lit("item "), _text(k % 20)).alias("itemName"), _text(k).alias("itemId"), _text("tp").alias("itemsViewed"),
        F.when(k % 2 == 0, F.lit("")).otherwise(F.concat(_text(k % 30), F.lit(".9"))).alias("itemsAddedToCart"),
        F.lit("x").alias("itemsCheckedOut"), F.lit(None).cast("string").alias("itemsPurchased"),
        F.concat(_text("tp"), F.lit(".75")).alias("itemRevenue"))
    return GA.shape_items(rows, quarantine=True).drop("loaded_at")


def q_restatement_log(spark, sf_dir):
    """MB4: each arriving export leaves its snapshot in the log; a run without news adds nothing."""
    root = scratch_path(spark, f"restated-{uuid.uuid4().hex}")
    o = _orders(spark, sf_dir).select(F.trunc("day", "MM").alias("report_date"), F.col("tp").alias("spend"))
    schema = T.StructType([T.StructField("report_date", T.DateType()), T.StructField("spend", T.LongType())])

    def run() -> None:
        intraday.restatement_log(spark, f"{root}/landing", schema, "parquet", lambda b: b.groupBy("report_date").agg(
            F.sum("spend").alias("spend"), F.count(F.lit(1)).alias("orders")), f"{root}/log", f"{root}/checkpoint")

    for more in (0, 10):
        o.withColumn("spend", F.col("spend") + more).write.mode("append").parquet(f"{root}/landing")
        run()
    run()
    return spark.read.parquet(f"{root}/log").select("report_date", "spend", "orders", F.col("batch_id").cast("long").alias("batch_id"))


def q_brand_views(spark, sf_dir):
    """PRJ16: a view per brand over the orders, read back."""
    tag = f"o{uuid.uuid4().hex[:8]}"
    lake.register_brand_views(spark, {tag: D.orders(spark, sf_dir)}, [D.BRAND_A, D.BRAND_B])
    parts = [spark.table(f"{tag}_{b}").select(F.lit(b).alias("view_brand"), "mall", "order_id", "payment_amount")
             for b in (D.BRAND_A, D.BRAND_B)]
    return parts[0].unionByName(parts[1])


QUERIES = {
    "src5_products": q_products,
    "src6_customers": q_customers,
    "src8_meta_records": q_meta_records,
    "src12_creative_formats": q_creative_formats,
    "src12_ad_groups": q_ad_groups,
    "src15_items": q_items,
    "mb4_restatement_log": q_restatement_log,
    "prj16_brand_views": q_brand_views,
}
