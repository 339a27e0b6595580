"""Registered queries over the benchmark tables (``queries()`` entries).

Each entry takes (spark, sf_dir), lands the reference-shaped tables from the
benchmark tables with ``sources.driver`` and runs one view or mart over them
for the fixed business date ``driver.AS_OF``.  Shared intermediates (P8,
P13, P14) and the stream of MB1 are written while the query is built.
"""

from __future__ import annotations

import datetime as _dt
import uuid as _uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martcraft.operators.union import current_view
from martcraft.plans import ads, commerce, crm, design, quality
from martcraft.plans import cost as CO
from martcraft.plans import landing, live, shapers, writes
from martcraft.session import materialize, scratch_path
from martcraft.sources import analytics as GA
from martcraft.sources import commerce as SC
from martcraft.sources import driver as D
from martcraft.sources.ads import shape_meta_hourly, shape_search_ads, with_web_purchase
from martcraft.sources.statistics import SPECS, shape_stat
from martcraft.streaming import intraday

AS_OF = D.AS_OF


def _orders_current(spark, sf):
    o = D.orders(spark, sf)
    # The intraday twin is the same landing restricted to the business day.
    return current_view(o, o, AS_OF)


def q_sales_daily(spark: SparkSession, sf: str) -> DataFrame:
    return commerce.sales_daily(_orders_current(spark, sf), AS_OF)


def q_orders_status(spark, sf):
    return commerce.orders_status(D.orders(spark, sf)).drop("ordered_at")


def q_financial_daily(spark, sf):
    o = D.orders(spark, sf)
    return commerce.financial_daily(o, D.order_items(spark, sf, o))


def q_repurchase_daily(spark, sf):
    return commerce.repurchase_daily(D.orders(spark, sf))


def q_product_sales(spark, sf):
    o = D.orders(spark, sf)
    items = D.order_items(spark, sf, current_view(o, o, AS_OF))
    return commerce.product_sales(items, AS_OF, names=D.product_names(spark, sf))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p9_sales_daily": q_sales_daily,
    "p1_orders_status": q_orders_status,
    "p3_financial_daily": q_financial_daily,
    "p4_repurchase_daily": q_repurchase_daily,
    "p10_product_sales": q_product_sales,
}


# --------------------------------------------------------------------- ads

def _ad_unified(spark, sf, as_of=AS_OF):
    ev = D.events(spark, sf)
    return ads.ad_unified(
        with_web_purchase(D.meta_ads(spark, sf, ev)), D.naver_ads(spark, sf, ev),
        D.google_stats(spark, sf, ev), D.google_campaign_names(spark, sf, ev),
        D.kakao_campaign(spark, sf, ev), D.ad_manual(spark, sf, ev), as_of,
        meta_accounts=D.META_ACCOUNTS, google_customers=D.GOOGLE_CUSTOMERS,
        kakao_accounts=D.KAKAO_ACCOUNTS)


def q_meta_ads_flat(spark, sf):
    return ads.meta_ads_flat(D.meta_ads(spark, sf), D.META_ACCOUNTS)


def q_meta_campaign_daily(spark, sf):
    return ads.meta_campaign_daily(q_meta_ads_flat(spark, sf))


def q_ads_audit(spark, sf):
    return ads.ads_audit(D.meta_ads(spark, sf), _dt.datetime.combine(AS_OF, _dt.time(6))).drop("snapshot_at")


def q_ad_unified(spark, sf):
    return _ad_unified(spark, sf)


def q_media_daily(spark, sf):
    return ads.media_daily(_ad_unified(spark, sf))


def q_brand_kpi(spark, sf):
    media = ads.media_daily(_ad_unified(spark, sf))
    sales = commerce.sales_daily(_orders_current(spark, sf), AS_OF)
    return ads.brand_kpi(media, sales, D.ga4_sessions(spark, sf), AS_OF)


def q_keyword_unified(spark, sf):
    ev = D.events(spark, sf)
    return ads.keyword_unified(D.naver_ads(spark, sf, ev), D.naver_keyword_history(spark, sf, ev),
                               {"BRAND_A": D.BRAND_A, "BRAND_B": D.BRAND_B})


def q_hourly_ratios(spark, sf):
    hourly = shape_meta_hourly(D.meta_hourly_raw(spark, sf), D.META_HOURLY_ACCOUNTS)
    return ads.hourly_ratios(hourly)


QUERIES.update({
    "p5_meta_ads_flat": q_meta_ads_flat,
    "p6_meta_campaign_daily": q_meta_campaign_daily,
    "p15_ads_audit": q_ads_audit,
    "p8_ad_unified_daily": q_ad_unified,
    "p11_media_daily": q_media_daily,
    "p12_brand_kpi": q_brand_kpi,
    "p7_keyword_unified": q_keyword_unified,
    "d7_hourly_ratios": q_hourly_ratios,
})


# --------------------------------------------------------------------- CRM

CRM_SPEC = crm.AudienceSpec(product_kw="widget", option_exclude="24", exclude_kw="anvil",
                            days=365, include_guest=True, member_consent=True, channel="all")


def _crm_rows(spark, sf):
    o = D.orders(spark, sf)
    items = D.items_named(spark, sf, D.order_items(spark, sf, o))
    seg = crm.segment(o, items, CRM_SPEC, AS_OF)
    bl = crm.suppression_list(D.blocklist_sheet(spark, sf))
    return crm.with_contacts(seg, D.member_contacts(spark, sf), D.guest_contacts(spark, sf), bl, CRM_SPEC)


def q_crm_audience(spark, sf):
    return crm.audience(_crm_rows(spark, sf))


def q_audience_order(spark, sf):
    """ST1: the send list's order as a column."""
    return crm.numbered_audience(_crm_rows(spark, sf))


def q_crm_funnel(spark, sf):
    return crm.funnel(_crm_rows(spark, sf))


def q_suppression_list(spark, sf):
    return crm.suppression_list(D.blocklist_sheet(spark, sf))


QUERIES.update({
    "p13_crm_audience": q_crm_audience,
    "p13_crm_funnel": q_crm_funnel,
    "st1_audience_order": q_audience_order,
    "src18_suppression_list": q_suppression_list,
})


# ----------------------------------------------------------------- sources

# A run-time secret for the keyed phone hash; tests and the catalog use a
# throw-away value (real runs pass their own).
CATALOG_SECRET = "catalog-run-secret"


def q_src_orders(spark, sf):
    o = SC.shape_orders(D.raw_orders(spark, sf), CATALOG_SECRET)
    return o.select("report_date", "order_id", "shop_no", "mall", "member_id",
                    F.col("buyer_hash").isNotNull().alias("has_buyer_hash"),
                    "order_status", "payment_amount", "order_amount", "currency")


def q_src_order_items(spark, sf):
    return SC.explode_order_items(D.raw_orders(spark, sf)).drop("raw_json", "ingested_at")


def q_src_stat_sales_hourly(spark, sf):
    return shape_stat(D.raw_stat_sales_hourly(spark, sf), SPECS["sales_daily"]).drop("raw_json", "ingested_at")


def q_src_stat_paymethod(spark, sf):
    return shape_stat(D.raw_stat_paymethods(spark, sf), SPECS["sales_paymethod"]).drop("raw_json", "ingested_at")


def q_src_attribution(spark, sf):
    return SC.shape_order_attribution(D.raw_attribution(spark, sf)).drop("raw_json", "ingested_at")


def q_src_member_joins(spark, sf):
    return SC.member_joins_from_members(D.member_first_orders(spark, sf))


def q_src_ga4_sessions(spark, sf):
    return GA.shape_sessions(D.raw_ga4_sessions(spark, sf)).drop("loaded_at")


def q_src_ga4_transactions(spark, sf):
    return GA.shape_transactions(D.raw_ga4_transactions(spark, sf)).drop("loaded_at")


def q_src_search_ads(spark, sf):
    stats, kmap = D.raw_search_stats(spark, sf)
    return shape_search_ads(stats, kmap).drop("raw_json", "ingested_at")


QUERIES.update({
    "src1_shape_orders": q_src_orders,
    "src2_order_items": q_src_order_items,
    "src3_stat_sales_hourly": q_src_stat_sales_hourly,
    "src3_stat_paymethod": q_src_stat_paymethod,
    "src4_order_attribution": q_src_attribution,
    "src7_member_joins": q_src_member_joins,
    "src13_ga4_sessions": q_src_ga4_sessions,
    "src14_ga4_transactions": q_src_ga4_transactions,
    "src10_search_ads": q_src_search_ads,
})


# ------------------------------------------------- quality, views, design

def q_orders_current(spark, sf):
    """SO2 + SO3: closed days from the final table, the business day from an
    intraday twin that lacks one column (aligned as NULL)."""
    base = D.orders(spark, sf)
    d0 = D.orders(spark, sf).drop("currency")
    cur = current_view(base, d0, AS_OF)
    return cur.select("report_date", "order_id", "mall", "currency", "payment_amount")


def q_freshness(spark, sf):
    ev = D.events(spark, sf)
    checks = [
        quality.FreshnessCheck("commerce orders", "orders", D.orders(spark, sf), "report_date", 2),
        quality.FreshnessCheck("order attribution", "order_attribution",
                               SC.shape_order_attribution(D.raw_attribution(spark, sf)), "report_date", 2),
        quality.FreshnessCheck("meta ads", "meta_ads", D.meta_ads(spark, sf, ev), "report_date", 2),
        quality.FreshnessCheck("search ads", "search_ads", D.naver_ads(spark, sf, ev), "report_date", 3),
        quality.FreshnessCheck("google ads", "google_stats", D.google_stats(spark, sf, ev), "segments_date", 3),
        quality.FreshnessCheck("display ads", "kakao_campaign", D.kakao_campaign(spark, sf, ev), "date", 3),
        quality.FreshnessCheck("keyword history", "keyword_hist",
                               D.naver_keyword_history(spark, sf, ev), "report_date", 3),
    ]
    return quality.freshness(checks, AS_OF)


def q_role_views(spark, sf):
    """The merchandiser's view of the daily sales."""
    design.register_role_views(spark, {"sales_daily": q_sales_daily(spark, sf)})
    return spark.table("v_md_sales_daily")


def q_exec_weekly(spark, sf):
    return design.exec_weekly_kpi(q_brand_kpi(spark, sf))


def q_keyword_daily(spark, sf):
    return design.keyword_daily(q_keyword_unified(spark, sf))


def q_campaign_daily(spark, sf):
    return design.campaign_daily(_ad_unified(spark, sf))


def q_creative_daily(spark, sf):
    return design.creative_daily(q_meta_ads_flat(spark, sf))


def q_tx_reconciliation(spark, sf):
    tx = GA.shape_transactions(D.raw_ga4_transactions(spark, sf))
    return design.transaction_reconciliation(tx, D.orders(spark, sf))


def q_odd_order_ids(spark, sf):
    """D4 where ids come in other forms: letters only, a hyphen, the web tag's prefix, blanks around them."""
    o = D.table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), F.to_date("o_orderdate").alias("day"),
                                            F.floor("o_totalprice").cast("double").alias("amount"))
    k, kind = F.col("k").cast("string"), F.col("k") % 5
    brand = F.when(F.col("k") % 2 == 0, F.lit(D.BRAND_A)).otherwise(F.lit(D.BRAND_B))
    web = (F.when(kind == 0, F.lit(" qq ")).when(kind == 1, F.concat(F.lit("A1-"), k))
           .when(kind == 2, F.concat(F.lit(" T"), k, F.lit(" "))).when(kind == 3, F.concat(F.lit("t"), k)).otherwise(k))
    own = F.when(kind == 0, F.lit("AB-X")).when(kind == 1, F.concat(F.lit("1-"), k)).otherwise(k)
    tx = o.select(brand.alias("brand"), F.col("day").alias("date"), web.alias("transaction_id"),
                  (F.col("amount") + 1).alias("purchase_revenue"), F.lit(1).cast("long").alias("ecommerce_purchases"))
    orders = o.select(F.col("day").alias("report_date"), brand.alias("mall"), own.alias("order_id"),
                      F.col("amount").alias("payment_amount"))
    return design.transaction_reconciliation(tx, orders)


def q_restatement(spark, sf):
    ev = D.events(spark, sf)
    early = ev.filter(F.minute("ts") < 45)          # what the earlier snapshot of the day had seen
    at = [_dt.datetime.combine(AS_OF, _dt.time(h)) for h in (6, 18)]
    snaps = ads.ads_audit(D.meta_ads(spark, sf, early), at[0]).unionByName(
        ads.ads_audit(D.meta_ads(spark, sf, ev), at[1]))
    return design.restatement_convergence(snaps).drop("snapshot_at")


QUERIES.update({
    "so2_orders_current": q_orders_current,
    "dq1_freshness": q_freshness,
    "d1_role_views": q_role_views,
    "d2_exec_weekly_kpi": q_exec_weekly,
    "d3_keyword_daily": q_keyword_daily,
    "d3_campaign_daily": q_campaign_daily,
    "d3_creative_daily": q_creative_daily,
    "d4_tx_reconciliation": q_tx_reconciliation,
    "d4_odd_order_ids": q_odd_order_ids,
    "d6_restatement": q_restatement,
})


# -------------------------------------------------------------------- cost

COST_CONFIG = CO.CostConfig(
    malls=(D.BRAND_A, D.BRAND_B), collab_mall=D.BRAND_B,
    aliases={"crimson": "red"}, overrides=(CO.Override("gizmo", "cold", 4321.0),),
    collab_markers=("energy,", "edition"), collab_energy="energy",
    collab_lines=(("gear", "gear line"),),
    collab_order_500=("gear line", "widget edition", "energy"), collab_line_250="energy")
COST_DAYS = 90


def q_cost_daily(spark, sf, as_of=AS_OF):
    o = D.orders(spark, sf)
    items = D.cost_items(spark, sf, D.order_items(spark, sf, current_view(o, o, as_of)))
    return cost_of(items, D.price_sheet(spark, sf), as_of)


def cost_of(items, sheet, as_of=AS_OF):
    # the price list feeds several joins
    prices = materialize(CO.parse_price_list(sheet, COST_CONFIG))
    collab = CO.parse_collab_prices(sheet, COST_CONFIG)
    start = as_of - _dt.timedelta(days=COST_DAYS - 1)
    opts = CO.option_rows(items, start, as_of, COST_CONFIG)
    return CO.cost_daily(opts, prices, collab, COST_CONFIG)


# The collaboration brand's own rules, with a made-up vocabulary: gift box, flavour + count tokens, flavour list in
# parentheses, performance line by product and by marker, 250 ml.
COLLAB_CONFIG = CO.CostConfig(
    malls=(D.BRAND_B,), collab_mall=D.BRAND_B, collab_markers=("energy,", "gear", "perf"), collab_energy="energy",
    collab_lines=(("gear", "gear line"), ("perf", "perf line")), collab_order_500=("gear line", "energy"),
    collab_line_250="energy", collab_tokens=("사과", "배"), perf_line="perf line", perf_products=("트레이닝",),
    perf_marker="파워", perf_aliases={"파워배": "배", "파워사과": "사과"}, gift_marker="선물", gift_cost=9999.0)
COLLAB_SHEET = [("energy, 사과, 500ml", 100.0), ("energy, 배, 500ml", 110.0), ("energy, 사과, 250ml", 60.0),
                ("drink, gear A, 사과, 500ml", 200.0), ("drink, perf P, 배, 500ml", 300.0), ("drink, perf P, 사과, 250ml", 150.0)]
COLLAB_OPTIONS = [("energy 세트", "선물 상자"), ("energy 500ml", "사과 4 + 배 (2)"), ("drink", "(사과/배) 12개입"),
                  ("트레이닝 energy", "배 6"), ("energy", "파워 사과 24"), ("energy 250ml", "사과 12 + 배 12")]


def q_collab_rules(spark, sf):
    """Every order is one box of the collaboration brand, its option text by turns one of the rules'."""
    k = F.col("o_orderkey")
    pick = lambda i: F.element_at(F.array(*[F.lit(x[i]) for x in COLLAB_OPTIONS]), (k % 6 + 1).cast("int"))
    raw = F.to_json(F.struct(F.when(k % 10 == 9, F.lit("C40")).otherwise(F.lit("N10")).alias("status_code"),
                             pick(1).alias("option_value")))
    items = D.table(spark, sf, "orders").select(
        F.to_date("o_orderdate").alias("report_date"), F.lit(D.BRAND_B).alias("mall"), pick(0).alias("product_name"),
        (k % 3 + 1).alias("quantity"), raw.alias("raw_json"))
    sheet = spark.createDataFrame([(i, n, p) for i, (n, p) in enumerate(COLLAB_SHEET)], "row_no long, name string, price double")
    prices = materialize(CO.parse_price_list(sheet, COLLAB_CONFIG))
    opts = CO.option_rows(items, _dt.date(1990, 1, 1), AS_OF, COLLAB_CONFIG)
    return CO.cost_daily(opts, prices, CO.parse_collab_prices(sheet, COLLAB_CONFIG), COLLAB_CONFIG)


def q_price_list(spark, sf):
    return CO.parse_price_list(D.price_sheet(spark, sf), COST_CONFIG)


def q_collab_prices(spark, sf):
    return CO.parse_collab_prices(D.price_sheet(spark, sf), COST_CONFIG)


QUERIES.update({
    "p14_cost_daily": q_cost_daily,
    "p14_collab_rules": q_collab_rules,
    "src19_price_list": q_price_list,
    "src20_collab_prices": q_collab_prices,
})


def q_campaign_attribution(spark, sf):
    att = SC.shape_order_attribution(D.raw_attribution(spark, sf))
    ga = GA.shape_sessions(D.raw_ga4_sessions(spark, sf))
    return design.campaign_attribution(_ad_unified(spark, sf), ga, att, D.orders(spark, sf), AS_OF)


QUERIES["d5_campaign_attribution"] = q_campaign_attribution


# --------------------------------------------------------------- streaming

RELOAD_DAYS = 7


def q_intraday_reload(spark, sf):
    """MB1 + MB2: the order export is a streaming file source; each run
    processes what arrived (availableNow), keeps the last RELOAD_DAYS days
    and overwrites exactly those date partitions (idempotent re-runs)."""
    root = scratch_path(spark, f"intraday-{_uuid.uuid4().hex}")
    schema = D.table(spark, sf, "orders").schema

    def shape(batch):
        return intraday.lookback_filter(D.orders_from(batch), AS_OF, RELOAD_DAYS)

    intraday.intraday_refresh(spark, f"{sf.rstrip('/')}/orders*.parquet", schema, "parquet", shape,
                              f"{root}/orders", f"{root}/_checkpoint")
    return spark.read.parquet(f"{root}/orders").select(
        "report_date", "order_id", "mall", "member_id", "payment_amount")


QUERIES["mb1_intraday_reload"] = q_intraday_reload


# ------------------------------------------------------------------- sinks
QUERIES.update(writes.QUERIES)
QUERIES.update(landing.QUERIES)
QUERIES.update(live.QUERIES)
QUERIES.update(shapers.QUERIES)
