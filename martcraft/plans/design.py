"""Marts described in the design notes but not built by the reference
(D1-D4, D6).  Same conventions: ratio of sums, explicit as_of."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martcraft.functions.numeric import safe_ratio

# Role -> (mart, columns) projections.
ROLE_VIEWS = {
    "v_mkt_media_daily": ("media_daily", ["report_date", "mall", "media", "sales_channel", "spend",
                                          "impressions", "clicks", "ctr", "conversions",
                                          "media_revenue", "roas_media"]),
    "v_mkt_brand_kpi": ("brand_kpi", ["report_date", "mall", "ad_spend", "media_reported_revenue",
                                      "store_revenue", "orders", "sessions", "users", "roas_real",
                                      "cac_per_order"]),
    "v_md_product_sales": ("product_sales", ["report_date", "mall", "product_no", "product_name", "qty",
                                             "gross_sales", "net_sales", "order_count"]),
    "v_md_sales_daily": ("sales_daily", ["report_date", "mall", "orders", "revenue", "aov"]),
    "v_fin_brand_kpi": ("brand_kpi", ["report_date", "mall", "ad_spend", "store_revenue", "orders",
                                      "roas_real", "cac_per_order"]),
    "v_fin_sales_daily": ("sales_daily", ["report_date", "mall", "orders", "revenue", "net_sales",
                                          "aov", "member_buyers"]),
}


def register_role_views(spark: SparkSession, marts: dict[str, DataFrame]) -> list[str]:
    done = []
    for view, (mart, cols) in ROLE_VIEWS.items():
        if mart in marts:
            marts[mart].select(*cols).createOrReplaceTempView(view)
            done.append(view)
    return done


def exec_weekly_kpi(brand_kpi: DataFrame) -> DataFrame:
    """Executive weekly KPI per brand (weeks start on Monday)."""
    s = F.sum
    return brand_kpi.groupBy(F.date_trunc("week", "report_date").cast("date").alias("week_start"),
                             "mall").agg(
        s("ad_spend").alias("ad_spend"), s("store_revenue").alias("revenue"),
        s("orders").alias("orders"), s("sessions").alias("sessions"),
        safe_ratio(s("store_revenue"), s("ad_spend")).alias("roas_real"),
        safe_ratio(s("ad_spend"), F.nullif(s("orders"), F.lit(0))).alias("cac_per_order"))


def keyword_daily(keyword_unified: DataFrame) -> DataFrame:
    """D3: keyword purpose table (API and history rows together)."""
    s = F.sum
    return keyword_unified.groupBy("report_date", "mall", "keyword").agg(
        s("impressions").alias("impressions"), s("clicks").alias("clicks"), s("cost").alias("cost"),
        s("conversions").alias("conversions"), s("conversion_value").alias("conversion_value"),
        safe_ratio(s("clicks"), s("impressions")).alias("ctr"),
        F.count_distinct("source").alias("sources"))


def campaign_daily(ad_unified: DataFrame) -> DataFrame:
    """D3: campaign purpose table across media."""
    s = F.sum
    return ad_unified.groupBy("report_date", "media", "campaign_id").agg(
        F.max("campaign_name").alias("campaign_name"), s("impressions").alias("impressions"),
        s("clicks").alias("clicks"), s("cost").alias("cost"), s("conversions").alias("conversions"),
        safe_ratio(s("conversion_value"), s("cost")).alias("roas"))


def creative_daily(flat: DataFrame) -> DataFrame:
    """D3: creative purpose table, the flattened ads (P5) by ad."""
    s = F.sum
    return flat.groupBy("report_date", "mall", "campaign_id", "ad_id").agg(
        F.max("ad_name").alias("ad_name"), s("spend").alias("cost"), s("impressions").alias("impressions"),
        s("clicks").alias("clicks"), s("purchase_cnt").alias("conversions"),
        s("purchase_value").alias("conversion_value"),
        safe_ratio(s("clicks"), s("impressions")).alias("ctr"),
        safe_ratio(s("purchase_value"), s("spend")).alias("roas"))


def order_key(col, prefixes: tuple[str, ...] = ()) -> Column:
    """Order number as both systems can be compared on: letters (upper case) and digits, without one of the
    source's own prefixes.  NULL for an id without a digit: it is no order number and matches nothing."""
    c = F.regexp_replace(F.upper(F.col(col).cast("string")), r"[^0-9A-Z]", "")
    if prefixes:
        c = F.regexp_replace(c, "^(" + "|".join(p.upper() for p in prefixes) + r")(?=\d)", "")
    return F.when(c.rlike(r"\d"), c)


# Fixed value: what the web tag puts before an order number.
WEB_PREFIXES = ("T",)


def transaction_reconciliation(transactions: DataFrame, orders: DataFrame, start: dt.date | None = None,
                               end: dt.date | None = None, web_prefixes: tuple[str, ...] = WEB_PREFIXES,
                               order_prefixes: tuple[str, ...] = ()) -> DataFrame:
    """Web transactions vs orders by brand and id, over [start, end] if
    given: status, revenue difference and duplicate firing (> 1 purchase
    event).  Each source's ids are brought to one form; ids that are no order
    numbers stay one-sided, by themselves.  Both sides are pre-aggregated per
    key so the full join cannot fan out."""
    def within(df: DataFrame, day: str) -> DataFrame:
        if start is not None:
            df = df.filter(F.col(day) >= F.lit(start))
        return df if end is None else df.filter(F.col(day) <= F.lit(end))

    def keyed(df: DataFrame, brand: str, id_col: str, prefixes: tuple[str, ...]) -> list[Column]:
        key = order_key(id_col, prefixes)
        return [F.col(brand).alias("brand"), key.alias("key"),
                F.when(key.isNull(), F.trim(F.col(id_col).cast("string"))).alias("odd")]

    t = within(transactions, "date")
    t = (t.groupBy(*keyed(t, "brand", "transaction_id", web_prefixes))
         .agg(F.sum("purchase_revenue").alias("ga_revenue"), F.sum("ecommerce_purchases").alias("ga_purchases"))
         .withColumnsRenamed({"odd": "ga_odd"}).withColumn("ga_brand", F.col("brand")))
    o = within(orders, "report_date")
    o = (o.groupBy(*keyed(o, "mall", "order_id", order_prefixes))
         .agg(F.sum("payment_amount").alias("order_revenue"))
         .withColumnsRenamed({"odd": "order_odd"}).withColumn("order_mall", F.col("brand")))
    # a NULL key equals no other; one-sided rows are told by the side that is there
    j = t.withColumn("in_ga", F.lit(True)).join(o.withColumn("in_orders", F.lit(True)), ["brand", "key"], "full")
    status = (F.when(F.col("in_orders").isNull(), F.lit("ga_only"))
               .when(F.col("in_ga").isNull(), F.lit("order_only"))
               .otherwise(F.lit("matched")))
    return j.select(F.coalesce("key", "ga_odd", "order_odd").alias("order_id"), status.alias("status"), "ga_brand",
                    "order_mall", "ga_revenue",
                    "order_revenue", (F.col("ga_revenue") - F.col("order_revenue")).alias("revenue_diff"),
                    (F.coalesce(F.col("ga_purchases"), F.lit(0)) > 1).alias("duplicate_firing"))


def restatement_convergence(snapshots: DataFrame) -> DataFrame:
    """Change of a day's figures between consecutive snapshots, by the time
    they were taken.  The window holds one account-day's snapshots (a handful),
    never a hot key."""
    w = Window.partitionBy("account_id", "report_date").orderBy("snapshot_at")
    return snapshots.select(
        "account_id", "report_date", "snapshot_date", "snapshot_at", "spend", "purchases",
        (F.col("spend") - F.lag("spend").over(w)).alias("spend_change"),
        (F.col("purchases") - F.lag("purchases").over(w)).alias("purchases_change"),
        F.row_number().over(w).alias("snapshot_seq"))


def campaign_attribution(ad_unified: DataFrame, sessions: DataFrame, attribution: DataFrame,
                         orders: DataFrame, as_of: dt.date, years: int = 2) -> DataFrame:
    """Per day x brand x campaign name, ad cost (all media), web sessions
    and the orders whose first touch was that campaign.  The three sides are
    aggregated to the same grain before the full joins, so nothing fans out;
    attributed orders are matched to the order table by order id."""
    lo = F.add_months(F.lit(as_of), -12 * years)
    ads = (ad_unified.filter((F.col("report_date") >= lo) & F.col("campaign_name").isNotNull())
           .groupBy("report_date", "mall", F.col("campaign_name").alias("campaign"))
           .agg(F.sum("cost").alias("ad_cost"), F.sum("clicks").alias("ad_clicks")))
    ga = (sessions.filter(F.col("date") >= lo)
          .groupBy(F.col("date").alias("report_date"), F.col("brand").alias("mall"),
                   F.col("session_campaign_name").alias("campaign"))
          .agg(F.sum("sessions").alias("sessions"), F.sum("ecommerce_purchases").alias("ga_purchases")))
    att = (attribution.filter((F.col("report_date") >= lo) & F.col("campaign").isNotNull())
           .select("report_date", "mall", "campaign", "order_id")
           # an order is stamped on its day or the next one
           .join(orders.filter(F.col("report_date") >= F.date_sub(lo, 1)).select("order_id", "mall", "payment_amount"),
                 ["order_id", "mall"], "left")
           .groupBy("report_date", "mall", "campaign")
           .agg(F.count_distinct("order_id").alias("attributed_orders"),
                F.sum("payment_amount").alias("attributed_revenue")))
    keys = ["report_date", "mall", "campaign"]
    j = ads.join(ga, keys, "full").join(att, keys, "full")
    return j.select(*keys, "ad_cost", "ad_clicks", "sessions", "ga_purchases", "attributed_orders",
                    "attributed_revenue",
                    safe_ratio(F.col("attributed_revenue"), F.col("ad_cost")).alias("roas_attributed"))
