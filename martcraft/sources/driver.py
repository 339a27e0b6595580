"""Adapters: the benchmark's TPC-H-style tables -> this engine's landed model.

The benchmark data has no commerce JSON, ad accounts or consent flags, so
these functions derive them deterministically from plain columns (every row
is kept; key arithmetic only chooses attribute values, it never filters).
The result has exactly the shape a loader would land: ``orders`` and
``order_items`` with a ``raw_json`` payload, ad tables per medium, web
sessions, contacts and a suppression list.  All of it is lazy DataFrame
code, so Catalyst prunes unused columns and pushes filters into the scans.
"""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the adapter (the oracle SQL restates them).
AS_OF = dt.date(2001, 8, 1)             # business date of every run on this data
EVENT_DAY_SHIFT = -8218                 # events (2024-01) land in 2001-07
BRAND_A, BRAND_B = "brand_a", "brand_b"
FLAVOURS = ["red", "blue", "hot", "old", "new", "cold", "small", "large"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


# ---------------------------------------------------------------- commerce
def _shop_no(priority: Column) -> Column:
    p = F.substring(priority, 1, 1)
    return F.when(p.isin("1", "3"), 1).when(p == "4", 2).otherwise(4).cast("bigint")


def _mall_of_shop(shop_no: Column) -> Column:
    return F.when(shop_no == 4, F.lit(BRAND_B)).otherwise(F.lit(BRAND_A))


def _txt(c: Column) -> Column:
    return c.cast("string")


def _amounts(k, c, tp, pr, actual: bool, canceled) -> Column:
    """initial_order_amount / actual_order_amount objects (numeric text)."""
    ship = F.when(k % 17 == 0, F.lit(None)).when(tp >= 300000, 0).otherwise(3000)
    points = (c % 7) * 100
    credits = F.when(c % 3 == 0, 500).otherwise(0)
    coupon = F.when(pr == "1", F.floor(tp / 20)).otherwise(0)
    member = F.when(k % 23 == 0, F.lit("N/A")).otherwise(_txt((k % 4) * 250))
    app = (k % 3) * 100
    ship_disc = F.when(pr == "5", F.lit(3000))
    price = tp
    if actual:
        zero = canceled == "T"
        price = (F.when(zero, 0).when(canceled == "M", F.floor(tp / 2))
                 .when(k % 19 == 0, F.lit(None)).otherwise(tp))
        ship = F.when(zero, 0).otherwise(ship)
        points = F.when(zero, 0).otherwise(points)
        credits = F.when(zero, 0).otherwise(credits)
        coupon = F.when(zero, 0).otherwise(coupon)
        member = F.when(zero, F.lit("0")).otherwise(member)
        app = F.when(zero, 0).otherwise(app)
        ship_disc = F.when(zero & (pr == "5"), F.lit(0)).otherwise(ship_disc)
    return F.struct(
        _txt(price).alias("order_price_amount"),
        _txt(ship).alias("shipping_fee"),
        _txt(points).alias("points_spent_amount"),
        _txt(credits).alias("credits_spent_amount"),
        _txt(coupon).alias("coupon_discount_price"),
        member.alias("membership_discount_amount"),
        _txt(app).alias("app_discount_amount"),
        _txt(ship_disc).alias("shipping_fee_discount_amount"),
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed commerce orders (FIXTURES orders schema)."""
    return orders_from(table(spark, sf_dir, "orders"))


def orders_from(o: DataFrame) -> DataFrame:
    """Shape raw benchmark order rows (batch or micro-batch) as landed orders."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    tp = F.floor("o_totalprice")
    pr = F.substring("o_orderpriority", 1, 1)
    st = F.col("o_orderstatus")
    canceled = F.when(k % 6 == 0, "T").when(k % 6 == 1, "M").otherwise("F")
    paid = F.when(k % 13 == 0, F.lit(None)).when(st == "P", "F").otherwise("T")
    payload = F.struct(
        paid.alias("paid"),
        canceled.alias("canceled"),
        F.when(pr == "2", _txt(tp % 1000)).alias("naver_point"),
        _amounts(k, c, tp, pr, False, canceled).alias("initial_order_amount"),
        _amounts(k, c, tp, pr, True, canceled).alias("actual_order_amount"),
    )
    shop = _shop_no(F.col("o_orderpriority"))
    return o.select(
        F.to_date("o_orderdate").alias("report_date"),
        _txt(k).alias("order_id"),
        shop.alias("shop_no"),
        _mall_of_shop(shop).alias("mall"),
        F.when(c % 10 == 0, F.lit(None)).when(c % 10 == 5, F.lit(""))
         .otherwise(F.concat(F.lit("m"), _txt(c))).alias("member_id"),
        F.lit(None).cast("string").alias("buyer_hash"),
        F.lit(None).cast("string").alias("order_status"),
        tp.cast("double").alias("payment_amount"),
        tp.cast("double").alias("order_amount"),
        F.lit("KRW").alias("currency"),
        F.col("o_orderdate").alias("ordered_at"),
        F.to_json(payload).alias("raw_json"),
    )


def option_text(linenumber: Column, suppkey: Column, partkey: Column) -> Column:
    fl = F.array(*[F.lit(x) for x in FLAVOURS])
    a = F.element_at(fl, (suppkey % 8 + 1).cast("int"))
    b = F.element_at(fl, ((suppkey + 3) % 8 + 1).cast("int"))
    p = F.element_at(fl, (partkey % 8 + 1).cast("int"))
    n = linenumber % 4
    return (F.when(n == 0, F.lit(None))
             .when(n == 1, F.concat(a, F.lit(" "), _txt((suppkey % 4 + 1) * 6), F.lit("개입")))
             .when(n == 2, F.concat(a, F.lit(" 6 + "), b, F.lit(" 6")))
             .otherwise(F.concat(F.lit("[BEST] "), p, F.lit(" (12개입)"))))


def order_items(spark: SparkSession, sf_dir: str, orders_df: DataFrame | None = None) -> DataFrame:
    """Landed order lines: lineitem joined to its order for date and shop.

    The join is on the order key, a high-cardinality key that hash-partitions
    evenly; only the three order columns it needs are shuffled.
    """
    li = table(spark, sf_dir, "lineitem")
    od = (orders_df if orders_df is not None else orders(spark, sf_dir)) \
        .select(F.col("order_id").cast("bigint").alias("l_orderkey"),
                "report_date", "shop_no", "mall")
    ln, sk, pk = F.col("l_linenumber"), F.col("l_suppkey"), F.col("l_partkey")
    rf = F.col("l_returnflag")
    status = (F.when(rf == "R", F.lit("C40"))
               .when((rf == "A") & (ln % 3 == 0), F.lit(None))
               .when(rf == "A", F.lit("N30")).otherwise(F.lit("N40")))
    payload = F.struct(
        F.col("report_date").cast("string").alias("order_date"),   # from the order side
        status.alias("status_code"),
        F.when(ln != 1, _txt((ln - 1) * 500)).alias("option_price"),
        option_text(ln, sk, pk).alias("option_value"),
        _txt(F.when(F.col("l_discount") >= 0.05,
                    F.floor(F.col("l_extendedprice") * F.col("l_discount"))).otherwise(0))
        .alias("coupon_discount_price"),
    )
    return li.join(od, "l_orderkey").select(
        "report_date",
        _txt(F.col("l_orderkey")).alias("order_id"),
        "shop_no", "mall",
        _txt(pk).alias("product_no"),
        F.concat(F.lit("V"), _txt(sk)).alias("variant_code"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        F.floor(F.col("l_extendedprice") / F.col("l_quantity")).cast("double").alias("product_price"),
        F.to_json(payload).alias("raw_json"),
    )


def product_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """product_no -> product_name (the product master's name column)."""
    return table(spark, sf_dir, "part").select(
        _txt(F.col("p_partkey")).alias("product_no"), F.col("p_name").alias("product_name"))


# --------------------------------------------------------------------- ads
# Ad-account ids of the adapter and the brand they belong to.
META_ACCOUNTS = {"act0": BRAND_A, "act1": BRAND_A, "act2": BRAND_A, "act3": BRAND_B}
META_HOURLY_ACCOUNTS = {"act0": BRAND_A, "act3": BRAND_B}
GOOGLE_CUSTOMERS = {1001: BRAND_A, 1002: BRAND_B}
KAKAO_ACCOUNTS = {"501": BRAND_A, "502": BRAND_B}
NAVER_CAMPAIGNS = ["브랜드A_파워링크_MO", "브랜드A_브랜드검색", "브랜드A_SSA_스토어",
                   "브랜드B_쇼핑_기획", "B_SA_generic", "plain campaign"]
HIST_AD_TYPES = ["파워링크", "쇼핑검색", "브랜드검색", "신제품검색"]


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event stream with the ad attributes every medium derives from."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.date_add(F.to_date("ts"), EVENT_DAY_SHIFT).alias("report_date"),
        F.col("ts"), F.col("user_id"), F.col("event_type"), F.col("value"),
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
    )


def _n(t: str) -> Column:
    return F.count_if(F.col("event_type") == t)


def _v(t: str | None, scale: int) -> Column:
    v = F.floor(F.col("value") * scale).cast("double")
    if t is None:
        return F.sum(v)
    return F.coalesce(F.sum(F.when(F.col("event_type") == t, v)), F.lit(0.0))


def _entry(cond, atype, value, **extra) -> Column:
    fields = [F.lit(atype).alias("action_type"), value.cast("string").alias("value")]
    for name in ("1d_click", "7d_click", "1d_ev"):
        fields.append((extra[name].cast("string") if name in extra else F.lit(None).cast("string"))
                      .alias(name))
    return F.when(cond, F.struct(*fields))


def _nonnull_array(*entries) -> Column:
    return F.filter(F.array(*entries), lambda x: x.isNotNull())


def meta_ads(spark: SparkSession, sf_dir: str, ev: DataFrame | None = None) -> DataFrame:
    """Landed daily meta ads (ad x day) with ``actions``/``action_values`` JSON."""
    ev = ev if ev is not None else events(spark, sf_dir)
    g = ev.groupBy("report_date", (F.col("user_id") % 5).alias("acct"), "k").agg(
        _n("view").alias("n_view"), _n("click").alias("n_click"),
        _n("purchase").alias("n_p"), _n("signup").alias("n_signup"), _n("error").alias("n_error"),
        F.count_if((F.col("event_type") == "purchase") & (F.col("value") >= 100)).alias("n_big"),
        F.count_if((F.col("event_type") == "click") & (F.col("value") > 50)).alias("link_clicks"),
        F.count_distinct("user_id").alias("reach"),
        _v("purchase", 10).alias("pv"), _v("signup", 10).alias("sv"),
        _v("click", 10).alias("cv"), _v("view", 10).alias("vv"),
        F.coalesce(F.sum(F.when((F.col("event_type") == "purchase") & (F.col("value") >= 100),
                                F.floor(F.col("value") * 10))), F.lit(0)).cast("double").alias("bigv"),
    )
    k = F.col("k")
    has_p = F.col("n_p") > 0
    pixel = F.col("acct").isin(0, 3)
    ev_k = (k % 2 == 0)
    actions = _nonnull_array(
        _entry(F.col("n_view") > 0, "landing_page_view", F.col("n_view")),
        _entry(F.col("n_click") > 0, "add_to_cart", F.col("n_click")),
        _entry(F.col("n_view") > 0, "view_content", F.col("n_view")),
        _entry(F.col("n_signup") > 0, "complete_registration", F.col("n_signup")),
        _entry(F.col("n_error") > 0, "omni_initiated_checkout", F.col("n_error")),
        _entry(has_p & (k % 7 == 0), "purchase", F.col("n_p") + 100),
        _entry(has_p & pixel, "offsite_conversion.fb_pixel_purchase", F.col("n_p"),
               **{"1d_click": F.col("n_big"), "1d_ev": F.when(ev_k, F.col("n_signup"))}),
        _entry(has_p, "purchase", F.col("n_p") + F.col("n_big"),
               **{"1d_click": F.when(k % 5 == 0, F.lit("N/A")).otherwise(F.col("n_big").cast("string")),
                  "7d_click": F.col("n_p")}),
        _entry(has_p, "omni_purchase", F.col("n_p") + F.col("n_signup")),
    )
    values = _nonnull_array(
        _entry(F.col("n_click") > 0, "add_to_cart", F.col("cv")),
        _entry(F.col("n_view") > 0, "view_content", F.col("vv")),
        _entry(has_p & pixel, "offsite_conversion.fb_pixel_purchase", F.col("pv"),
               **{"1d_click": F.col("bigv"), "1d_ev": F.when(ev_k, F.col("sv"))}),
        _entry(has_p, "purchase", F.col("pv"), **{"7d_click": F.col("pv")}),
        _entry(has_p, "omni_purchase", F.col("pv") + F.col("sv")),
    )
    no_actions = F.col("acct") == 4       # this account reports no action arrays
    spend = F.col("cv") + F.col("vv")
    imp = F.col("n_view").cast("bigint")
    clicks = F.col("n_click").cast("bigint")
    return g.select(
        "report_date",
        F.concat(F.lit("act"), F.col("acct").cast("string")).alias("account_id"),
        F.concat(F.lit("account "), F.col("acct").cast("string")).alias("account_name"),
        F.concat(F.lit("cp"), (k % 10).cast("string")).alias("campaign_id"),
        F.concat(F.lit("meta campaign "), (k % 10).cast("string")).alias("campaign_name"),
        F.concat(F.lit("as"), (k % 20).cast("string")).alias("adset_id"),
        F.concat(F.lit("adset "), (k % 20).cast("string")).alias("adset_name"),
        F.concat(F.lit("ad"), k.cast("string")).alias("ad_id"),
        F.concat(F.lit("ad "), k.cast("string")).alias("ad_name"),
        F.lit("OUTCOME_SALES").alias("objective"),
        F.lit("OFFSITE_CONVERSIONS").alias("optimization_goal"),
        spend.alias("spend"), imp.alias("impressions"), clicks.alias("clicks"),
        F.col("reach").cast("bigint").alias("reach"),
        F.try_divide(imp, F.col("reach")).alias("frequency"),
        F.try_divide(clicks * 100, imp).alias("ctr"),
        F.try_divide(spend, clicks).alias("cpc"),
        F.try_divide(spend * 1000, imp).alias("cpm"),
        F.col("link_clicks").cast("bigint").alias("inline_link_clicks"),
        F.when(~no_actions, F.to_json(actions)).alias("actions"),
        F.when(~no_actions, F.to_json(values)).alias("action_values"),
    )


def meta_hourly_raw(spark: SparkSession, sf_dir: str, ev: DataFrame | None = None) -> DataFrame:
    """Hourly meta insights as the API reports them (hour range text)."""
    ev = ev if ev is not None else events(spark, sf_dir)
    h = F.hour("ts")
    g = ev.groupBy("report_date", h.alias("h"), (F.col("user_id") % 5).alias("acct"), "k").agg(
        _n("view").alias("impressions"), _n("click").alias("clicks"),
        F.sum(F.when(F.col("event_type").isin("view", "click"),
                     F.floor(F.col("value") * 10))).cast("double").alias("spend"))
    k = F.col("k")
    hh = F.lpad(F.col("h").cast("string"), 2, "0")
    return g.select(
        F.col("report_date").cast("string").alias("date_start"),
        F.concat(hh, F.lit(":00:00 - "), hh, F.lit(":59:59"))
         .alias("hourly_stats_aggregated_by_advertiser_time_zone"),
        F.concat(F.lit("act"), F.col("acct").cast("string")).alias("account_id"),
        F.concat(F.lit("account "), F.col("acct").cast("string")).alias("account_name"),
        F.concat(F.lit("cp"), (k % 10).cast("string")).alias("campaign_id"),
        F.concat(F.lit("meta campaign "), (k % 10).cast("string")).alias("campaign_name"),
        F.concat(F.lit("as"), (k % 20).cast("string")).alias("adset_id"),
        F.concat(F.lit("adset "), (k % 20).cast("string")).alias("adset_name"),
        F.concat(F.lit("ad"), k.cast("string")).alias("ad_id"),
        F.concat(F.lit("ad "), k.cast("string")).alias("ad_name"),
        F.col("impressions").cast("string").alias("impressions"),
        F.col("clicks").cast("string").alias("clicks"),
        F.coalesce(F.col("spend"), F.lit(0.0)).cast("string").alias("spend"),
    )


def _naver_names(k: Column) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in NAVER_CAMPAIGNS]), (k % 6 + 1).cast("int"))


def naver_ads(spark: SparkSession, sf_dir: str, ev: DataFrame | None = None) -> DataFrame:
    """Landed search-ad stats: campaign rows and keyword rows in one table."""
    from martcraft.functions.classify import landing_type
    ev = ev if ev is not None else events(spark, sf_dir)
    metrics = [_n("view").cast("bigint").alias("impressions"),
               _n("click").cast("bigint").alias("clicks"),
               _v("click", 5).alias("cost"),
               _n("purchase").cast("double").alias("conversions"),
               _v("purchase", 10).alias("conversion_value")]
    acct = F.when(F.col("user_id") % 2 == 0, F.lit("BRAND_A")).otherwise(F.lit("BRAND_B"))
    base = ev.select("report_date", acct.alias("account"), "k", "event_type", "value")
    camp = base.groupBy("report_date", "account", (F.col("k") % 6).alias("c")).agg(*metrics)
    kw = base.groupBy("report_date", "account", (F.col("k") % 6).alias("c"),
                      (F.col("k") % 12).alias("g"), "k").agg(*metrics)
    k = F.col("k")

    def shape(df, level):
        name = _naver_names(F.col("c"))
        is_kw = level == "keyword"
        return df.select(
            "report_date", F.lit("SA").alias("media"), "account",
            F.lit(level).alias("level"),
            F.concat(F.lit("nc"), F.col("c").cast("string")).alias("campaign_id"),
            name.alias("campaign_name"),
            (F.concat(F.lit("ng"), F.col("g").cast("string")) if is_kw else F.lit(None).cast("string"))
            .alias("adgroup_id"),
            (F.concat(F.lit("group "), F.col("g").cast("string")) if is_kw else F.lit(None).cast("string"))
            .alias("adgroup_name"),
            (F.concat(F.lit("kw"), k.cast("string")) if is_kw else F.lit(None).cast("string"))
            .alias("keyword_id"),
            (F.concat(F.lit("keyword "), k.cast("string")) if is_kw else F.lit(None).cast("string"))
            .alias("keyword"),
            landing_type(F.lit("SA"), name).alias("lp_type"),
            "impressions", "clicks", "cost", "conversions", "conversion_value")

    return shape(camp, "campaign").unionByName(shape(kw, "keyword"))


def naver_keyword_history(spark: SparkSession, sf_dir: str, ev: DataFrame | None = None) -> DataFrame:
    """Keyword history export (admin CSV), 20 days earlier than the API span,
    with a third brand the API does not cover."""
    ev = ev if ev is not None else events(spark, sf_dir)
    mall = F.element_at(F.array(F.lit(BRAND_A), F.lit(BRAND_B), F.lit("brand_c")),
                        (F.col("user_id") % 3 + 1).cast("int"))
    device = F.when(F.col("user_id") % 2 == 0, F.lit("모바일")).otherwise(F.lit("PC"))
    b = ev.select(F.date_sub("report_date", 20).alias("report_date"), mall.alias("mall"),
                  device.alias("device"), "k", "event_type", "value")
    g = b.groupBy("report_date", "mall", "device", "k").agg(
        _n("view").cast("bigint").alias("impressions"), _n("click").cast("bigint").alias("clicks"),
        _v("click", 5).alias("cost"), _n("purchase").cast("bigint").alias("conversions"),
        _v("purchase", 10).alias("conversion_value"))
    k = F.col("k")
    return g.select(
        "report_date", "mall",
        F.element_at(F.array(*[F.lit(x) for x in HIST_AD_TYPES]), (k % 4 + 1).cast("int")).alias("ad_type"),
        F.when(k % 3 == 0, F.lit("스마트스토어")).otherwise(F.lit("자사몰")).alias("landing"),
        F.concat(F.lit("https://shop.example/p/"), k.cast("string")).alias("url"),
        _naver_names(k % 6).alias("campaign"),
        F.concat(F.lit("group "), (k % 12).cast("string")).alias("adgroup"),
        F.concat(F.lit("keyword "), k.cast("string")).alias("keyword"),
        "device", "impressions", "clicks", "cost", "conversions", "conversion_value")


def google_stats(spark: SparkSession, sf_dir: str, ev: DataFrame | None = None) -> DataFrame:
    ev = ev if ev is not None else events(spark, sf_dir)
    g = ev.groupBy(F.col("report_date").alias("segments_date"),
                   (F.col("user_id") % 3 + 1000).cast("bigint").alias("customer_id"),
                   (F.col("k") % 8).cast("bigint").alias("campaign_id")).agg(
        _n("view").cast("bigint").alias("metrics_impressions"),
        _n("click").cast("bigint").alias("metrics_clicks"),
        (F.coalesce(F.sum(F.floor("value")), F.lit(0)) * 1000000).cast("bigint").alias("metrics_cost_micros"),
        _n("purchase").cast("double").alias("metrics_conversions"),
        _v("purchase", 10).alias("metrics_conversions_value"))
    return g


def google_campaign_names(spark: SparkSession, sf_dir: str, ev: DataFrame | None = None) -> DataFrame:
    """Campaign name history: several rows per id."""
    ev = ev if ev is not None else events(spark, sf_dir)
    return ev.select((F.col("k") % 8).cast("bigint").alias("campaign_id"),
                     F.concat(F.lit("g"), (F.col("k") % 8).cast("string"), F.lit("-"),
                              F.col("event_type")).alias("campaign_name")).distinct()


def kakao_campaign(spark: SparkSession, sf_dir: str, ev: DataFrame | None = None) -> DataFrame:
    ev = ev if ev is not None else events(spark, sf_dir)
    g = ev.groupBy(F.col("report_date").alias("date"),
                   (F.col("user_id") % 4 + 500).cast("string").alias("ad_account_id"),
                   (F.col("k") % 5).alias("c")).agg(
        _n("view").cast("bigint").alias("impressions"), _n("click").cast("bigint").alias("clicks"),
        _v("view", 2).alias("cost"))
    return g.select("date", "ad_account_id",
                    F.concat(F.lit("kc"), F.col("c").cast("string")).alias("campaign_id"),
                    F.concat(F.lit("kakao "), F.col("c").cast("string")).alias("campaign_name"),
                    "impressions", "clicks", "cost")


def ad_manual(spark: SparkSession, sf_dir: str, ev: DataFrame | None = None) -> DataFrame:
    """Manually downloaded ad rows, 15 days earlier than the API span: part of
    them overlap API-covered (media, brand, day) and must yield to the API."""
    ev = ev if ev is not None else events(spark, sf_dir)
    media = F.when(F.col("event_type").isin("signup", "error"), F.lit("meta")).otherwise(F.lit("gfa"))
    mall = F.when(F.col("user_id") % 3 == 0, F.lit(BRAND_A)).when(F.col("user_id") % 3 == 1, F.lit(BRAND_B))
    b = ev.select(F.date_sub("report_date", 15).alias("report_date"), mall.alias("mall"),
                  media.alias("media"), "k", "event_type", "value")
    g = b.groupBy("report_date", "mall", "media", (F.col("k") % 3).alias("c"),
                  (F.col("k") % 4 == 0).alias("ss")).agg(
        F.count(F.lit(1)).cast("bigint").alias("impressions"), _n("click").cast("bigint").alias("clicks"),
        _v(None, 1).alias("cost"), _n("purchase").cast("double").alias("conversions"),
        _v("purchase", 10).alias("conversion_value"))
    return g.select(
        "report_date", "mall", "media",
        F.concat(F.lit("mc"), F.col("c").cast("string")).alias("campaign_id"),
        F.when(F.col("c") != 0, F.concat(F.lit("manual "), F.col("c").cast("string"))).alias("campaign_name"),
        F.when(F.col("ss"), F.lit("스마트스토어")).alias("landing"),
        "impressions", "clicks", "cost", "conversions", "conversion_value",
        F.lit("manual.csv").alias("source"))


def ga4_sessions(spark: SparkSession, sf_dir: str, ev: DataFrame | None = None) -> DataFrame:
    ev = ev if ev is not None else events(spark, sf_dir)
    brand = F.when(F.col("user_id") % 2 == 0, F.lit(BRAND_A)).otherwise(F.lit(BRAND_B))
    return ev.groupBy(brand.alias("brand"), F.col("report_date").alias("date"),
                      F.col("event_type").alias("session_source")).agg(
        F.count(F.lit(1)).cast("bigint").alias("sessions"),
        F.count_distinct("user_id").cast("bigint").alias("total_users"))


# ----------------------------------------------------------------- CRM inputs
def items_named(spark: SparkSession, sf_dir: str, items: DataFrame) -> DataFrame:
    """Order lines with the product master's name attached."""
    return items.join(product_names(spark, sf_dir), "product_no", "left")


def _phone(a: Column, b: Column, sep: str, area: Column | None = None) -> Column:
    return F.concat(F.lit("010") if area is None else area, F.lit(sep), F.lpad((a % 10000).cast("string"), 4, "0"),
                    F.lit(sep), F.lpad((b % 10000).cast("string"), 4, "0"))


def member_contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Member privacy records (stand-in for the contact API): one per shop."""
    c = table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    seg = F.col("c_mktsegment")
    return c.select(
        F.explode(F.array(F.lit(1).cast("bigint"), F.lit(2).cast("bigint"),
                          F.lit(4).cast("bigint"))).alias("shop_no"),
        F.concat(F.lit("m"), key.cast("string")).alias("member_id"),
        F.col("c_name").alias("name"),
        F.when(key % 11 == 0, F.lit("")).otherwise(_phone(key, key * 7, "-")).alias("cellphone"),
        F.when(key % 4 == 0, F.concat(F.lit("user"), key.cast("string"), F.lit("@example.com")))
         .otherwise(F.lit("")).alias("email"),
        F.when(seg == "BUILDING", F.lit("T")).when(seg == "MACHINERY", F.lit("y"))
         .when(seg == "AUTOMOBILE", F.lit("F")).otherwise(F.lit("")).alias("sms"),
        F.when(F.col("c_acctbal") > 5000, F.lit("T")).otherwise(F.lit("F")).alias("news_mail"),
    )


def guest_contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First receiver of each order (guest lookup by order id)."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    return o.select(
        _shop_no(F.col("o_orderpriority")).alias("shop_no"),
        k.cast("string").alias("order_id"),
        F.concat(F.lit("guest "), k.cast("string")).alias("name"),
        _phone(k, F.col("o_custkey"), " ").alias("cellphone"),
        F.lit("").alias("email"), F.lit("").alias("sms"), F.lit("").alias("news_mail"),
    )


def blocklist_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppression sheet rows (reg, phone, row_no) in sheet order, one per
    customer: those of two nations gave their mobile number, all others a
    landline that no contact record has; nation 3 appears twice with other
    formatting."""
    c = table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    rows = c.select(
        F.when(F.col("c_nationkey").isin(3, 7), F.lit("010")).otherwise(F.lit("02")).alias("area"),
        F.explode(F.when(F.col("c_nationkey") == 3, F.array(F.lit(0), F.lit(1)))
                  .otherwise(F.array(F.lit(0)))).alias("copy"), key)
    member_rows = rows.select(
        (key * 2 + F.col("copy")).alias("row_no"),
        F.concat(F.lit("reg-"), key.cast("string")).alias("reg"),
        F.when(F.col("copy") == 0, _phone(key, key * 7, "-", F.col("area")))
         .otherwise(F.concat(F.lit(" "), _phone(key, key * 7, " ", F.col("area")), F.lit(" "))).alias("phone"))
    return member_rows


# ------------------------------------------------------ raw API-shaped records
SHOP_NAMES = {1: "Brand A Main Store", 2: "Brand A Video Shop", 4: "Brand B Official"}
SHOP_RULES = [(["brand b"], BRAND_B), (["brand a"], BRAND_A)]


def shop_mall(shop_no: Column) -> Column:
    """Brand of a shop through its name (SRC21 over the shop list)."""
    from martcraft.sources.commerce import resolve_shops
    names = F.create_map(*[x for k, v in SHOP_NAMES.items() for x in (F.lit(k), F.lit(v))])
    return resolve_shops(shop_no, names[shop_no], SHOP_RULES)


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order API records as landed JSON (one per row) with shop and window.

    Items are nested per order, as the order API returns them: one
    aggregation keyed by the order collects that order's lines (1 to 7 per
    order in these tables; a feed may repeat line numbers).  The group is one order document, so its size is
    bounded by the lines of a single order, not by any hot customer, shop or
    day.
    """
    o = table(spark, sf_dir, "orders")
    li = table(spark, sf_dir, "lineitem")
    ln = F.col("l_linenumber")
    item = F.struct(
        F.col("l_partkey").cast("string").alias("product_no"),
        F.concat(F.lit("V"), F.col("l_suppkey").cast("string")).alias("variant_code"),
        F.col("l_quantity").alias("quantity"),
        F.when(ln == 2, F.lit("")).otherwise(
            F.floor(F.col("l_extendedprice") / F.col("l_quantity")).cast("string")).alias("product_price"),
        F.floor("l_extendedprice").cast("string").alias("payment_amount"))
    items = li.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.collect_list(F.struct(ln.alias("n"), item.alias("it"))).alias("its"))
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    tp = F.floor("o_totalprice")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    odd = (k % 2 == 1)
    shop = _shop_no(F.col("o_orderpriority"))
    rec = F.struct(
        k.cast("string").alias("order_id"),
        F.when(k % 29 != 0, F.concat(day, F.lit("T10:00:00+09:00"))).alias("order_date"),
        F.when((k % 29 == 0) & ~odd, F.concat(day, F.lit(" 11:00:00"))).alias("payment_date"),
        F.when((k % 29 == 0) & odd, F.lit("")).alias("created_date"),
        F.when(c % 10 == 0, F.lit(None)).when(c % 10 == 5, F.lit(""))
         .otherwise(F.concat(F.lit("m"), c.cast("string"))).alias("member_id"),
        F.when(k % 7 == 0, F.lit("")).otherwise(tp.cast("string")).alias("payment_amount"),
        (tp - 100).cast("string").alias("actual_payment_amount"),
        F.when(k % 37 == 0, F.lit("n/a")).otherwise(tp.cast("string")).alias("order_price_amount"),
        tp.cast("string").alias("order_amount"),
        F.lit("KRW").alias("currency"),
        F.struct(F.when(c % 3 == 0, F.lit("")).otherwise(_phone(c, c * 7, "-")).alias("cellphone"),
                 F.lit("").alias("phone")).alias("buyer"),
        F.when(~((c % 3 == 0) & (k % 5 == 0)),
               F.array(F.struct(_phone(k, c, " ").alias("cellphone")))).alias("receivers"),
        F.transform(F.array_sort(F.col("its")), lambda x: x["it"]).alias("items"),
    )
    return (o.join(items, "o_orderkey", "left")
            .select(F.to_json(rec).alias("value"), shop.alias("shop_no"),
                    shop_mall(shop).alias("mall"), F.lit(AS_OF).alias("window_end")))


def raw_stat_sales_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """'sales_daily' statistic responses: one document per shop and day with
    at most 24 hourly records (order hour = order key mod 24)."""
    o = table(spark, sf_dir, "orders")
    shop = _shop_no(F.col("o_orderpriority"))
    g = o.groupBy(F.to_date("o_orderdate").alias("d"), shop.alias("shop_no"),
                  (F.col("o_orderkey") % 24).alias("hour")).agg(
        F.sum(F.floor("o_totalprice")).alias("amt"), F.count(F.lit(1)).alias("cnt"))
    rec = F.struct(F.col("d").cast("string").alias("date"), F.col("hour").cast("string").alias("hour"),
                   F.col("amt").cast("string").alias("order_amount"),
                   F.when(F.col("hour") % 5 == 0, F.lit("")).otherwise(F.col("cnt").cast("string"))
                    .alias("order_count"),
                   F.col("cnt").cast("string").alias("buyers_count"))
    docs = g.groupBy("d", "shop_no").agg(F.collect_list(rec).alias("times"))
    return docs.select(F.to_json(F.struct("times")).alias("value"), "shop_no",
                       shop_mall(F.col("shop_no")).alias("mall"),
                       F.col("d").alias("day"), F.lit(AS_OF).alias("window_end"))


PAY_METHODS = ["card", "bank", "naverpay", "point", "virtual"]


def raw_stat_paymethods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """'sales_paymethod' responses (records carry no date; the day is stamped):
    one document per shop and day, one record per payment method (5)."""
    o = table(spark, sf_dir, "orders")
    shop = _shop_no(F.col("o_orderpriority"))
    pm = F.element_at(F.array(*[F.lit(x) for x in PAY_METHODS]), (F.col("o_custkey") % 5 + 1).cast("int"))
    g = o.groupBy(F.to_date("o_orderdate").alias("d"), shop.alias("shop_no"), pm.alias("pm")).agg(
        F.sum(F.floor("o_totalprice")).alias("amt"), F.count(F.lit(1)).alias("cnt"))
    rec = F.struct(F.col("pm").alias("payment_method"), F.col("amt").cast("string").alias("order_amount"),
                   F.col("cnt").cast("string").alias("order_count"))
    docs = g.groupBy("d", "shop_no").agg(F.collect_list(rec).alias("records"))
    # the list sits under an unexpected key: the first-list fallback finds it
    return docs.select(F.to_json(F.struct(F.lit("ok").alias("result"), F.col("records").alias("paymethods")))
                       .alias("value"), "shop_no", shop_mall(F.col("shop_no")).alias("mall"),
                       F.col("d").alias("day"), F.lit(AS_OF).alias("window_end"))


def raw_stat_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses of all statistics: one document per report, shop and month, a record per customer class.

    The records' keys come from the specs.  The list stands under one of the report's keys, under an
    unexpected one, or is the whole document; dates, values and first keys are missing in turn."""
    from martcraft.sources.statistics import SPECS, spec_table
    o = table(spark, sf_dir, "orders")
    g = o.groupBy(F.trunc("o_orderdate", "MM").alias("d"), _shop_no(F.col("o_orderpriority")).alias("shop_no"),
                  (F.col("o_custkey") % 4).alias("c")).agg(
        F.sum(F.floor("o_totalprice")).alias("amt"), F.count(F.lit(1)).alias("cnt"))
    reports = F.explode(F.array(*[F.lit(name) for name in SPECS]))
    x = g.withColumn("report", reports).join(F.broadcast(spec_table(spark)), "report")          # the specs: 23 rows
    c, text = F.col("c"), lambda v: v.cast("string")

    def entries(keys: str, *values: Column) -> Column:
        return F.transform(F.col(keys), lambda k, i: F.struct(k.alias("key"), F.get(F.array(*values), i).alias("value")))

    date = F.when(c < 3, F.array(F.struct(F.element_at(F.array(F.lit("date"), F.lit("report_date"), F.lit("std_date")),
                                                       F.least(c, F.lit(2)).cast("int") + 1).alias("key"),
                                          F.col("d").cast("string").alias("value")))).otherwise(F.array())
    dated = F.when(F.col("_per_day"), F.array().cast("array<struct<key:string,value:string>>")).otherwise(date)
    rec = F.map_from_entries(F.concat(
        entries("_dim1", F.concat(F.lit("dim "), text(c))), entries("_dim2", F.concat(F.lit("sub "), text(c % 2))),
        entries("_val1", F.when(c == 3, F.lit("bad")).otherwise(text(F.col("amt")))),
        entries("_val2", F.when((F.size("_val2") > 1) & (c % 2 == 0), F.lit("")).otherwise(text(F.col("cnt"))),
                text(F.col("cnt") + 1)), dated))
    docs = x.groupBy("report", "_keys", "d", "shop_no").agg(F.collect_list(rec).alias("recs"))     # at most four
    recs, which = F.to_json("recs"), F.length("report") % 4
    value = F.when(which == 0, recs).when(which == 1, F.concat(F.lit('{"status":"ok","other":'), recs, F.lit("}"))).otherwise(
        F.concat(F.lit('{"none":null,"'), F.element_at("_keys", -1), F.lit('":'), recs, F.lit("}")))
    return docs.select("report", value.alias("value"), "shop_no", shop_mall(F.col("shop_no")).alias("mall"),
                       F.col("d").alias("day"), F.lit(AS_OF).alias("window_end"))


def raw_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order attribution records (first-touch ad per order)."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    shop = _shop_no(F.col("o_orderpriority"))
    rec = F.struct(
        k.cast("string").alias("order_id"),
        F.when(k % 9 != 0, F.date_format("o_orderdate", "yyyy-MM-dd")).alias("order_date"),
        F.element_at(F.array(F.lit("meta"), F.lit("naver"), F.lit("google"), F.lit("")),
                     (k % 4 + 1).cast("int")).alias("ad"),
        F.concat(F.lit("kw"), (k % 13).cast("string")).alias("keyword"),
        F.when(k % 2 == 0, F.lit("cpc")).otherwise(F.lit("organic")).alias("medium"),
        F.concat(F.lit("meta campaign "), (k % 10).cast("string")).alias("campaign"),
        F.lit(None).cast("string").alias("content"),
        F.element_at(F.array(*[F.lit(x) for x in PAY_METHODS]),
                     (F.col("o_custkey") % 5 + 1).cast("int")).alias("payment_method"),
        F.floor("o_totalprice").cast("string").alias("order_amount"))
    return o.select(F.to_json(rec).alias("value"), shop.alias("shop_no"),
                    shop_mall(shop).alias("mall"),
                    F.date_add(F.to_date("o_orderdate"), 1).alias("day"))


def member_first_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members with their join day (= day of the first order) and shop."""
    o = table(spark, sf_dir, "orders")
    first = o.groupBy("o_custkey").agg(
        F.min_by(F.struct(F.to_date("o_orderdate").alias("d"),
                          _shop_no(F.col("o_orderpriority")).alias("shop_no")),
                 F.struct("o_orderdate", "o_orderkey")).alias("f"))
    return first.select(F.col("f.d").alias("join_date"), F.col("f.shop_no").alias("shop_no"),
                        shop_mall(F.col("f.shop_no")).alias("mall"))


def raw_ga4_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Session report rows (text dims/metrics, yyyyMMdd date)."""
    ev = events(spark, sf_dir)
    g = ev.groupBy("report_date", (F.col("user_id") % 2).alias("b"), "event_type",
                   (F.col("k") % 4).alias("camp")).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("user_id").alias("u"),
        F.count_if(F.col("event_type") == "purchase").alias("p"),
        F.sum(F.floor(F.col("value") * 100)).alias("cents"),
        F.sum(F.floor("value")).alias("whole"))
    camp = F.col("camp").cast("string")
    return g.select(
        F.when(F.col("b") == 0, F.lit(BRAND_A)).otherwise(F.lit(BRAND_B)).alias("brand"),
        F.when(F.col("b") == 0, F.lit("P-A")).otherwise(F.lit("P-B")).alias("property_id"),
        F.date_format("report_date", "yyyyMMdd").alias("date"),
        F.col("event_type").alias("sessionSource"), F.lit("cpc").alias("sessionMedium"),
        F.concat(F.lit("meta campaign "), camp).alias("sessionCampaignName"),
        F.concat(F.lit("mc"), camp).alias("sessionManualCampaignName"),
        F.lit("(not set)").alias("sessionManualTerm"), F.lit("(not set)").alias("sessionManualAdContent"),
        F.lit("Paid Search").alias("sessionDefaultChannelGroup"),
        F.concat(F.col("event_type"), F.lit(" / cpc")).alias("firstUserSourceMedium"),
        F.col("n").cast("string").alias("sessions"), F.col("u").cast("string").alias("totalUsers"),
        F.when(F.col("camp") == 0, F.lit("")).otherwise(F.col("u").cast("string")).alias("newUsers"),
        F.lit("0").alias("addToCarts"), F.lit("").alias("checkouts"),
        F.col("p").cast("string").alias("ecommercePurchases"),
        F.concat((F.col("cents") / 100).cast("bigint").cast("string"), F.lit("."),
                 F.lpad((F.col("cents") % 100).cast("string"), 2, "0")).alias("purchaseRevenue"),
        F.col("p").cast("string").alias("firstTimePurchasers"),
        F.concat(F.col("u").cast("string"), F.lit(".9")).alias("activeUsers"),
        F.concat(F.col("whole").cast("string"), F.lit(".5")).alias("userEngagementDuration"))


def raw_ga4_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transaction report rows: one per purchase event; some ids are not
    real transactions ('', '(not set)', '(not_set)' with spaces)."""
    e = table(spark, sf_dir, "events").filter(F.col("event_type") == "purchase")
    eid = F.col("event_id")
    tid = (F.when(eid % 17 == 0, F.lit(" (not set) ")).when(eid % 19 == 0, F.lit("(not_set)"))
            .when(eid % 23 == 0, F.lit("")).otherwise(F.concat(F.lit("T"), eid.cast("string"))))
    return e.select(
        F.when(F.col("user_id") % 2 == 0, F.lit(BRAND_A)).otherwise(F.lit(BRAND_B)).alias("brand"),
        F.lit("P").alias("property_id"),
        F.date_format(F.date_add(F.to_date("ts"), EVENT_DAY_SHIFT), "yyyyMMdd").alias("date"),
        tid.alias("transactionId"), F.lit("google").alias("sessionSource"),
        F.lit("cpc").alias("sessionMedium"), F.lit("c1").alias("sessionCampaignName"),
        F.lit("1").alias("sessionCampaignId"), F.lit("Paid Search").alias("sessionDefaultChannelGroup"),
        F.format_string("%.2f", F.col("value")).alias("purchaseRevenue"),
        F.lit("").alias("taxAmount"), F.lit("2500").alias("shippingAmount"),
        F.when(eid % 11 == 0, F.lit("2")).otherwise(F.lit("1")).alias("ecommercePurchases"))


def raw_search_stats(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Search-ad keyword stat records (id + JSON metrics) and the keyword map
    (keyword -> ad group -> campaign).  Keyword ids 90..99 are missing from
    the map on purpose (deleted keywords)."""
    ev = events(spark, sf_dir)
    g = ev.groupBy("report_date", (F.col("user_id") % 2).alias("b"), "k").agg(
        F.count_if(F.col("event_type") == "view").alias("imp"),
        F.count_if(F.col("event_type") == "click").alias("clk"),
        F.coalesce(F.sum(F.when(F.col("event_type") == "click", F.floor(F.col("value") * 5))), F.lit(0))
         .alias("cost"),
        F.count_if(F.col("event_type") == "purchase").alias("conv"))
    k = F.col("k")
    metrics = F.struct(
        F.col("imp").cast("string").alias("impCnt"), F.col("clk").cast("string").alias("clkCnt"),
        F.col("cost").cast("string").alias("salesAmt"),
        F.when(k % 3 == 0, F.lit(None)).otherwise(F.col("conv").cast("string")).alias("ccnt"))
    stats = g.select(
        "report_date", F.lit("SA").alias("media"),
        F.when(F.col("b") == 0, F.lit("BRAND_A")).otherwise(F.lit("BRAND_B")).alias("account"),
        F.when(F.col("b") == 0, F.lit("111")).otherwise(F.lit("222")).alias("customer_id"),
        F.lit("keyword").alias("level"), F.lit(None).cast("string").alias("campaign_id"),
        F.lit(None).cast("string").alias("campaign_name"),
        F.concat(F.lit("kw"), k.cast("string")).alias("keyword_id"),
        F.to_json(metrics).alias("value"))
    kmap = (ev.select("k").distinct().filter(F.col("k") < 90)
            .select(F.concat(F.lit("kw"), k.cast("string")).alias("keyword_id"),
                    F.concat(F.lit("keyword "), k.cast("string")).alias("keyword"),
                    F.concat(F.lit("ng"), (k % 12).cast("string")).alias("adgroup_id"),
                    F.concat(F.lit("group "), (k % 12).cast("string")).alias("adgroup_name"),
                    F.concat(F.lit("nc"), (k % 6).cast("string")).alias("campaign_id"),
                    _naver_names(k).alias("campaign_name")))
    return stats, kmap


# ------------------------------------------------------------ cost inputs
def _noun_adj(name: Column):
    parts = F.split(name, " ")
    return F.element_at(parts, 2), F.element_at(parts, 1)


def price_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price list rows (row_no, name, price) in sheet order: one listing per
    part (PET listings for PROMO parts, shrink-wrap listings excluded, some
    prices missing) plus collaboration listings for three part brands."""
    p = table(spark, sf_dir, "part")
    noun, adj = _noun_adj(F.col("p_name"))
    ml = (F.col("p_size") * 10).cast("string")
    base = p.select(
        (F.col("p_partkey") * 2).alias("row_no"),
        F.concat(F.when(F.col("p_type") == "PROMO", F.lit("페트, "))
                  .otherwise(F.concat(F.lit("["), F.col("p_brand"), F.lit("]"))),
                 noun, F.lit(", "), adj, F.lit(" ("), ml, F.lit("ml)"),
                 F.when(F.col("p_size") == 50, F.lit(" 쉬링크")).otherwise(F.lit(""))).alias("name"),
        F.when(F.col("p_partkey") % 50 == 7, F.lit(None))
         .otherwise(F.round(F.col("p_retailprice") * 10)).alias("price"))
    collab = p.filter(F.col("p_brand").isin("Brand#1", "Brand#2", "Brand#3")).select(
        (F.col("p_partkey") * 2 + 1).alias("row_no"),
        F.when(F.col("p_brand") == "Brand#1",
               F.concat(F.lit("energy, "), adj, F.lit(", "),
                        F.when(F.col("p_size") % 2 == 0, F.lit("250")).otherwise(F.lit("500")), F.lit("ml")))
         .otherwise(F.concat(F.lit("collab, "), noun, F.lit(" edition, "), adj, F.lit(", 500ml"))).alias("name"),
        F.round(F.col("p_retailprice") * 7).alias("price"))
    return base.unionByName(collab)


def cost_items(spark: SparkSession, sf_dir: str, items: DataFrame) -> DataFrame:
    """Order lines named as the shop lists them: some names carry a bottle
    size, some a pack size."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    name = F.concat(F.col("p_name"),
                    F.when(k % 3 == 0, F.concat(F.lit(" "), (F.col("p_size") * 10).cast("string"), F.lit("ml")))
                     .otherwise(F.lit("")),
                    F.when(k % 5 == 0, F.lit(" 24개입")).otherwise(F.lit("")))
    names = p.select(k.cast("string").alias("product_no"), name.alias("product_name"))
    return items.join(names, "product_no", "left")
