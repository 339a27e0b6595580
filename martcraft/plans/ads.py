"""Advertising views and marts: P5, P6, P7, P8, P11, P12, P15, D7.

Brand mapping is a literal map lookup, the API-first fill is a left anti
join against the set of covered (media, brand, day) keys, and every rate is
a ratio of sums computed with ``try_divide``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martcraft.functions import actions as A
from martcraft.functions.classify import keyword_ad_type, sales_channel
from martcraft.functions.dates import since
from martcraft.functions.numeric import safe_double, safe_ratio
from martcraft.operators.union import align_union
from martcraft.session import materialize
from martcraft.sources.ads import brand_of, google_cost

UNIFIED_COLUMNS = ["report_date", "mall", "media", "campaign_id", "campaign_name", "landing",
                   "impressions", "clicks", "cost", "conversions", "conversion_value"]


# ------------------------------------------------------------------- P5
def meta_ads_flat(meta: DataFrame, accounts: dict) -> DataFrame:
    # each payload is parsed once, then picked from
    base = (meta.select("*", A.parse_actions("actions").alias("_acts"), A.parse_actions("action_values").alias("_vals"))
            .select("*", A.action_pick(F.col("_acts"), A.PURCHASE_TYPES).alias("_pc"),
                    A.action_pick(F.col("_vals"), A.PURCHASE_TYPES).alias("_pv")))
    pc_v = safe_double(F.col("_pc.value"))
    pv_v = safe_double(F.col("_pv.value"))
    z = lambda c: F.coalesce(c, F.lit(0.0))
    acts, vals = F.col("_acts"), F.col("_vals")
    return base.select(
        "report_date",
        brand_of(F.col("account_id"), accounts).alias("mall"),
        "account_id", "account_name", "campaign_id", "campaign_name",
        "adset_id", "adset_name", "ad_id", "ad_name", "objective", "optimization_goal",
        "spend", "impressions", "clicks", "reach", "frequency", "ctr", "cpc", "cpm",
        F.col("inline_link_clicks").alias("link_clicks"),
        A.action_value(acts, A.LANDING_VIEW_TYPES).alias("landing_page_views"),
        pc_v.alias("purchase_cnt"),
        pv_v.alias("purchase_value"),
        (pc_v + z(safe_double(F.col("_pc")["1d_ev"]))).alias("purchase_cnt_incl_ev"),
        (pv_v + z(safe_double(F.col("_pv")["1d_ev"]))).alias("purchase_value_incl_ev"),
        safe_double(F.col("_pc")["1d_click"]).alias("purchase_cnt_1dclick"),
        safe_double(F.col("_pv")["1d_click"]).alias("purchase_value_1dclick"),
        A.action_value(acts, A.ADD_TO_CART_TYPES).alias("add_to_cart_cnt"),
        A.action_value(acts, A.VIEW_CONTENT_TYPES).alias("view_content_cnt"),
        A.action_value(acts, A.REGISTER_TYPES).alias("register_cnt"),
        A.action_value(acts, A.LEAD_TYPES).alias("lead_cnt"),
        A.action_value(acts, A.CHECKOUT_TYPES).alias("initiate_checkout_cnt"),
        A.action_value(vals, A.ADD_TO_CART_TYPES).alias("add_to_cart_value"),
        A.action_value(vals, A.VIEW_CONTENT_TYPES).alias("view_content_value"),
        safe_ratio(pv_v, F.col("spend")).alias("roas"),
        safe_ratio(F.col("spend"), pc_v).alias("cost_per_purchase"),
    )


# ------------------------------------------------------------------- P6
def meta_campaign_daily(flat: DataFrame) -> DataFrame:
    s = F.sum
    return flat.groupBy("report_date", "mall", "account_id", "campaign_id").agg(
        F.max("campaign_name").alias("campaign_name"),
        s("spend").alias("spend"), s("impressions").alias("impressions"),
        s("clicks").alias("clicks"), s("link_clicks").alias("link_clicks"),
        safe_ratio(s("clicks"), s("impressions")).alias("ctr"),
        safe_ratio(s("spend"), s("clicks")).alias("cpc"),
        s("purchase_cnt").alias("purchase_cnt"),
        s("purchase_cnt_incl_ev").alias("purchase_cnt_incl_ev"),
        s("purchase_cnt_1dclick").alias("purchase_cnt_1dclick"),
        s("purchase_value").alias("purchase_value"),
        s("purchase_value_incl_ev").alias("purchase_value_incl_ev"),
        s("purchase_value_1dclick").alias("purchase_value_1dclick"),
        s("add_to_cart_cnt").alias("add_to_cart_cnt"),
        s("view_content_cnt").alias("view_content_cnt"),
        s("register_cnt").alias("register_cnt"),
        s("lead_cnt").alias("lead_cnt"),
        s("initiate_checkout_cnt").alias("initiate_checkout_cnt"),
        safe_ratio(s("purchase_value"), s("spend")).alias("roas"),
        safe_ratio(s("purchase_value_incl_ev"), s("spend")).alias("roas_incl_ev"),
        safe_ratio(s("purchase_value_1dclick"), s("spend")).alias("roas_1dclick"),
        safe_ratio(s("spend"), s("purchase_cnt")).alias("cost_per_purchase"),
    )


# ------------------------------------------------------------------- P8
def _sums(cost=None):
    return [F.sum("impressions").alias("impressions"), F.sum("clicks").alias("clicks"),
            (cost if cost is not None else F.sum("cost")).alias("cost")]


def ad_unified(meta: DataFrame, naver: DataFrame, g_stats: DataFrame, g_names: DataFrame,
               kakao: DataFrame, manual: DataFrame, as_of: dt.date, *,
               meta_accounts: dict, google_customers: dict, kakao_accounts: dict,
               years: int = 2) -> DataFrame:
    """Four API media at campaign grain, plus manual rows for the (media,
    brand, day) keys no API covers; sales channel derived at the end."""
    meta_p = (meta.filter(since("report_date", as_of, years=years))
              .withColumn("mall", brand_of(F.col("account_id"), meta_accounts))
              .groupBy("report_date", "mall", "campaign_id")
              .agg(F.max("campaign_name").alias("campaign_name"), *_sums(F.sum("spend")),
                   F.sum("web_purchase_count").alias("conversions"),
                   F.sum("web_purchase_value").alias("conversion_value"))
              .select("report_date", "mall", F.lit("meta").alias("media"), "campaign_id",
                      "campaign_name", F.lit(None).cast("string").alias("landing"),
                      "impressions", "clicks", "cost", "conversions", "conversion_value"))
    naver_p = (naver.filter(since("report_date", as_of, years=years) & (F.col("level") == "campaign"))
               .withColumn("mall", F.lower("account"))
               .groupBy("report_date", "mall", "campaign_id")
               .agg(F.max("campaign_name").alias("campaign_name"), F.max("lp_type").alias("landing"),
                    *_sums(), F.sum("conversions").alias("conversions"),
                    F.sum("conversion_value").alias("conversion_value"))
               .select("report_date", "mall", F.lit("naver").alias("media"), *UNIFIED_COLUMNS[3:]))
    names = g_names.groupBy("campaign_id").agg(F.max("campaign_name").alias("campaign_name"))
    google_p = (g_stats.filter(since("segments_date", as_of, years=years))
                .select(F.col("segments_date").alias("report_date"),
                        brand_of(F.col("customer_id"), google_customers).alias("mall"),
                        "campaign_id", "metrics_impressions", "metrics_clicks",
                        "metrics_cost_micros", "metrics_conversions", "metrics_conversions_value")
                .groupBy("report_date", "mall", "campaign_id")
                .agg(F.sum("metrics_impressions").alias("impressions"),
                     F.sum("metrics_clicks").alias("clicks"),
                     google_cost(F.sum("metrics_cost_micros")).alias("cost"),
                     F.sum("metrics_conversions").alias("conversions"),
                     F.sum("metrics_conversions_value").alias("conversion_value"))
                .join(names, "campaign_id", "left")
                .select("report_date", "mall", F.lit("google").alias("media"),
                        F.col("campaign_id").cast("string").alias("campaign_id"), "campaign_name",
                        F.lit(None).cast("string").alias("landing"),
                        "impressions", "clicks", "cost", "conversions", "conversion_value"))
    kakao_p = (kakao.filter(since("date", as_of, years=years))
               .select(F.col("date").alias("report_date"),
                       brand_of(F.col("ad_account_id"), kakao_accounts).alias("mall"),
                       "campaign_id", "campaign_name", "impressions", "clicks", "cost")
               .groupBy("report_date", "mall", "campaign_id")
               .agg(F.max("campaign_name").alias("campaign_name"), *_sums())
               .select("report_date", "mall", F.lit("kakao").alias("media"), "campaign_id",
                       "campaign_name", F.lit(None).cast("string").alias("landing"),
                       "impressions", "clicks", "cost",
                       F.lit(None).cast("double").alias("conversions"),
                       F.lit(None).cast("double").alias("conversion_value")))
    # Campaign x day rows of the four media: read twice below (covered keys
    # and output), so written once; its size is campaigns x days, not events.
    api = materialize(align_union(meta_p, naver_p, google_p, kakao_p))
    covered = api.select("media", "mall", "report_date").distinct()          # AG10
    # NULL media/brand never equal anything, so such manual rows stay (anti join).
    manual_p = (manual.filter(since("report_date", as_of, years=years))
                .select(*UNIFIED_COLUMNS)
                .join(covered, ["media", "mall", "report_date"], "left_anti"))
    allrows = align_union(api, manual_p.select(*UNIFIED_COLUMNS))
    # PRJ17: all columns plus the computed sales channel
    return allrows.withColumn("sales_channel", sales_channel("landing", "mall"))


# ------------------------------------------------------------------ P11
def media_daily(unified: DataFrame) -> DataFrame:
    s = F.sum
    return unified.groupBy("report_date", "mall", "media", "sales_channel").agg(
        s("cost").alias("spend"), s("impressions").alias("impressions"), s("clicks").alias("clicks"),
        safe_ratio(s("clicks"), F.nullif(s("impressions"), F.lit(0))).alias("ctr"),
        s("conversions").alias("conversions"),
        s("conversion_value").alias("media_revenue"),
        safe_ratio(s("conversion_value"), F.nullif(s("cost"), F.lit(0.0))).alias("roas_media"),
    )


# ------------------------------------------------------------------ P12
def brand_kpi(media: DataFrame, sales: DataFrame, ga: DataFrame, as_of: dt.date,
              ga_years: int = 2) -> DataFrame:
    """Ad spend <-> real sales <-> sessions per brand-day, full outer on both
    joins.  All three inputs are already aggregated to (day, brand)."""
    spend = media.groupBy("report_date", "mall").agg(
        F.sum("spend").alias("ad_spend"), F.sum("media_revenue").alias("media_reported_revenue"))
    s = sales.select("report_date", "mall", F.col("revenue").alias("store_revenue"), "orders")
    g = (ga.filter(since("date", as_of, years=ga_years))
         .groupBy(F.col("date").alias("report_date"), F.col("brand").alias("mall"))
         .agg(F.sum("sessions").alias("sessions"), F.sum("total_users").alias("users")))
    j = spend.join(s, ["report_date", "mall"], "full").join(g, ["report_date", "mall"], "full")
    return j.select(
        "report_date", "mall", "ad_spend", "media_reported_revenue", "store_revenue", "orders",
        "sessions", "users",
        safe_ratio(F.col("store_revenue"), F.col("ad_spend")).alias("roas_real"),
        safe_ratio(F.col("ad_spend"), F.nullif(F.col("orders"), F.lit(0))).alias("cac_per_order"),
    )


# ------------------------------------------------------------------- P7
def keyword_unified(naver: DataFrame, history: DataFrame, accounts: dict | None = None) -> DataFrame:
    """P7; ``accounts`` maps an account to its brand, others are lower-cased."""
    api = naver.filter(F.col("level") == "keyword").select(
        "report_date",
        F.coalesce(brand_of(F.col("account"), accounts, default=None) if accounts else F.lit(None),
                   F.lower("account")).alias("mall"),
        keyword_ad_type("campaign_name").alias("ad_type"),
        F.col("lp_type").alias("landing"),
        F.col("campaign_name").alias("campaign"),
        F.col("adgroup_name").alias("adgroup"),
        "keyword",
        F.lit(None).cast("string").alias("device"),
        "impressions", "clicks", "cost",
        F.col("conversions").cast("double").alias("conversions"),
        "conversion_value",
        F.lit("api").alias("source"))
    days = api.select("report_date", "mall").distinct()                      # AG10
    raw = (history.join(days, ["report_date", "mall"], "left_anti")
           .select("report_date", "mall", "ad_type", "landing", "campaign", "adgroup", "keyword",
                   "device", "impressions", "clicks", "cost",
                   F.col("conversions").cast("double").alias("conversions"),
                   "conversion_value", F.lit("raw").alias("source")))
    return api.unionByName(raw)


# ------------------------------------------------------------------ P15
def ads_audit(meta: DataFrame, snapshot_at: dt.datetime, days: int | None = None) -> DataFrame:
    """Account-day snapshot stamped with its time; purchase types are *added*
    (deliberate double count, unlike the priority pick).  ``days`` keeps the
    last so many days before the stamp (8 in the scheduled run)."""
    if days is not None:
        meta = meta.filter(F.col("report_date") > F.lit(snapshot_at.date() - dt.timedelta(days=days)))
    return meta.groupBy("report_date", "account_id").agg(
        F.sum("spend").alias("spend"),
        F.sum("impressions").alias("impressions"),
        F.sum("clicks").alias("clicks"),
        F.sum(A.sum_types(A.parse_actions("actions"))).alias("purchases"),
        F.sum(A.sum_types(A.parse_actions("action_values"))).alias("purchase_value"),
    ).withColumn("snapshot_date", F.lit(snapshot_at.date())).withColumn("snapshot_at", F.lit(snapshot_at))


# ------------------------------------------------------------------- D7
def hourly_ratios(hourly: DataFrame) -> DataFrame:
    s = F.sum
    return hourly.groupBy("report_date", "hour", "mall", "campaign_id").agg(
        s("impressions").alias("impressions"), s("clicks").alias("clicks"), s("spend").alias("spend"),
        safe_ratio(s("spend") * 1000, s("impressions")).alias("cpm"),
        safe_ratio(s("spend"), s("clicks")).alias("cpc"),
        safe_ratio(s("clicks"), s("impressions")).alias("ctr"),
    )
