"""Shapers whose inputs are files or API payloads (hand-made fixtures)."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from martcraft.plans import design
from martcraft.sources import ads as SA
from martcraft.sources import analytics as GA
from martcraft.sources import commerce as SC
from martcraft.sources import files as SF
from martcraft.sources.statistics import SPECS, shape_stat

D = dt.date


def _write(path, text, bom=False):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8-sig" if bom else "utf-8") as fh:
        fh.write(text)


def test_read_manual_ads_csv(spark, tmp_path):
    d = str(tmp_path / "manual")
    header = "report_date,mall,media,campaign_id,campaign_name,landing,impressions,clicks,cost,conversions,conversion_value\n"
    _write(d + "/gfa.csv", header + "2026-06-01 00:00, Brand_A ,GFA,c1,,,\"1,234\",12.9,\"₩5,000\",,\"12%\"\n"
                                     ",x,y,,,,,,,,\n", bom=True)
    _write(d + "/_TEMPLATE.csv", header + "2026-01-01,a,meta,c,n,,1,1,1,1,1\n")
    rows = SF.read_manual_ads(spark, d).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.report_date, r.mall, r.media, r.campaign_name) == (D(2026, 6, 1), "brand_a", "gfa", None)
    assert (r.impressions, r.clicks, r.cost, r.conversions, r.conversion_value) == (1234, 12, 5000.0, None, 12.0)
    assert r.source == "gfa.csv"


def test_read_keyword_history_csv(spark, tmp_path):
    d = str(tmp_path / "hist")
    header = "report_date,mall,ad_type,landing,url,campaign,adgroup,keyword,device,impressions,clicks,cost,conversions,conversion_value\n"
    _write(d + "/h.csv", header + "2026-02-01,A,파워링크,자사몰,,c,g,k,PC,\"1,000\",3.9,3.9,x,\"₩10\"\n", bom=True)
    r = SF.read_keyword_history(spark, d).collect()[0]
    assert (r.mall, r.impressions, r.clicks, r.cost, r.conversions, r.conversion_value) == \
        ("a", 1000, 3, 3.0, 0, 0.0)


def test_snapshots(spark):
    raw = spark.createDataFrame(
        [(1, "brand_a", json.dumps({"product_no": "7", "product_name": "x", "price": "1,000", "selling": "T"}))],
        "shop_no int, mall string, value string")
    p = SC.snapshot_products(raw, D(2024, 1, 2)).collect()[0]
    assert (p.snapshot_date, p.product_no, p.price, p.selling) == (D(2024, 1, 2), "7", None, "T")
    c = SC.snapshot_customers(raw.withColumn("value", F.lit('{"member_id":"m1","group_no":1}')), D(2024, 1, 2))
    assert c.first().member_id == "m1" and c.first().group_no == "1"
    counts = spark.createDataFrame([("2024-01-02", 1, "a", "3"), ("2024-01-03", 1, "a", None)],
                                   "report_date string, shop_no int, mall string, count string")
    assert [r.join_count for r in SC.member_joins_from_counts(counts).collect()] == [3, 0]


def test_stat_per_day_and_list_fallback(spark):
    resp = spark.createDataFrame([
        (1, "a", D(2024, 1, 5), D(2024, 1, 31), json.dumps({"x": 1, "weird": [{"ad": "g", "visit_count": "3"}]})),
        (1, "a", D(2024, 1, 6), D(2024, 1, 31), json.dumps([{"ad": "n", "visit_count": ""}])),
    ], "shop_no int, mall string, day date, window_end date, value string")
    rows = sorted(tuple(r) for r in shape_stat(resp, SPECS["referrer_ad"]).select(
        "report_date", "dim1", "val1").collect())
    assert rows == [(D(2024, 1, 5), "g", 3.0), (D(2024, 1, 6), "n", None)]


def test_kakao_routing_and_lookups(spark):
    fmt = spark.createDataFrame([("20240105", "501", "IMAGE_BANNER", "10", "2", "300"),
                                 ("2024.01.05", "501", "Message_Basic", "", "", "50"),
                                 ("2024-01-05", "501", None, "1", "0", "")],
                                "start string, ad_account_id string, creative_format string, imp string, click string, cost string")
    da, msg = SA.route_creative_formats(fmt)
    assert sorted((r.ad_type, r.impressions, r.cost) for r in da.collect()) == [("DISPLAY", 10, 300.0), ("OTHER", 1, 0.0)]
    assert [(r.date, r.cost) for r in msg.collect()] == [(D(2024, 1, 5), 50.0)]
    rows = spark.createDataFrame([("20240105", "501", "c1", "5", "1", "9"), ("20240105", "501", "c9", "1", "1", "1")],
                                 "start string, ad_account_id string, campaign_id string, imp string, click string, cost string")
    names = spark.createDataFrame([("501", "c1", "Spring")], "ad_account_id string, campaign_id string, campaign_name string")
    got = sorted((r.campaign_id, r.campaign_name) for r in SA.kakao_campaign_rows(rows, names).collect())
    assert got == [("c1", "Spring"), ("c9", "")]
    ag_rows = rows.withColumnRenamed("campaign_id", "adgroup_id")
    groups = spark.createDataFrame([("501", "c1", "c1x", "G")], "ad_account_id string, adgroup_id string, campaign_id string, adgroup_name string")
    got = sorted((r.adgroup_id, r.campaign_id, r.adgroup_name) for r in SA.kakao_adgroup_rows(ag_rows, groups).collect())
    assert got == [("c1", "c1x", "G"), ("c9", "", "")]


def test_ga_items_and_strict_date(spark):
    rows = spark.createDataFrame([("b", "p", "20240105", "Tee", "1", "3", "", "1.9", "2", "12.5")],
                                 "brand string, property_id string, date string, itemName string, itemId string, "
                                 "itemsViewed string, itemsAddedToCart string, itemsCheckedOut string, "
                                 "itemsPurchased string, itemRevenue string")
    r = GA.shape_items(rows).collect()[0]
    assert (r.date, r.item_name, r.items_viewed, r.items_added_to_cart, r.items_checked_out, r.item_revenue) == \
        (D(2024, 1, 5), "Tee", 3, 0, 1, 12.5)
    bad = spark.createDataFrame([("b", "p", "(not set)", "Tee", "1", "3", "", "1.9", "2", "12.5")], rows.schema)
    assert GA.shape_items(bad, quarantine=True).first().date is None
    with pytest.raises(Exception):
        GA.shape_items(bad).collect()


def test_role_views(spark):
    sales = spark.createDataFrame([(D(2024, 1, 1), "a", 1, 10.0, 9.0, 10.0, 1)],
                                  "report_date date, mall string, orders long, revenue double, net_sales double, aov double, member_buyers long")
    views = design.register_role_views(spark, {"sales_daily": sales})
    assert views == ["v_md_sales_daily", "v_fin_sales_daily"]
    assert spark.table("v_md_sales_daily").columns == ["report_date", "mall", "orders", "revenue", "aov"]
