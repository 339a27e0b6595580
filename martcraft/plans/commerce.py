"""Commerce views and marts: P1, P3, P4, P9, P10.

Each builder takes landed DataFrames and ``as_of``; nothing is read or
written here.  JSON payloads are parsed once per row (``from_json`` into a
narrow struct) and all conditional logic stays in Catalyst expressions.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martcraft.functions import json as J
from martcraft.functions.classify import order_status_label
from martcraft.functions.dates import since
from martcraft.functions.numeric import safe_double, safe_ratio, strict_double, vat_excluded

# Deductions subtracted from the charged price in net sales (PRJ7).
NET_DEDUCTIONS = [
    "points_spent_amount", "credits_spent_amount", "coupon_discount_price",
    "membership_discount_amount", "set_product_discount_amount",
    "app_discount_amount", "market_other_discount_amount",
    "shipping_fee_discount_amount", "coupon_shipping_fee_amount",
]


def _amt(j, block: str, field: str):
    return safe_double(j[block][field])


def _z(c):
    return F.coalesce(c, F.lit(0.0))


def net_charge(j) -> "F.Column":
    """PRJ7: price + shipping - 9 deductions, from actual_order_amount.
    Only the price is not defaulted, so a missing price drops the order out
    of the sum (NULL), exactly as in the source definition."""
    a = "actual_order_amount"
    total = _amt(j, a, "order_price_amount") + _z(_amt(j, a, "shipping_fee"))
    for f in NET_DEDUCTIONS:
        total = total - _z(_amt(j, a, f))
    return total


# ------------------------------------------------------------------- P1
def orders_status(orders: DataFrame) -> DataFrame:
    j = F.col("_j")
    return orders.select("*", J.parse("raw_json", J.ORDER_JSON).alias("_j")).select(
        "report_date", "mall", "shop_no", "order_id", "member_id",
        "payment_amount", "order_amount", "currency", "ordered_at",
        j["paid"].alias("paid_flag"), j["canceled"].alias("canceled_flag"),
    ).select(
        "*",
        (F.col("paid_flag") == "T").alias("is_paid"),
        (F.col("canceled_flag") == "T").alias("is_canceled"),
        (F.col("canceled_flag") == "M").alias("is_partial_cancel"),
        order_status_label("paid_flag", "canceled_flag").alias("status_label"),
    )


# ------------------------------------------------------------------- P9
def sales_daily(orders_current: DataFrame, as_of: dt.date, years: int = 3) -> DataFrame:
    j = F.col("_j")
    o = (orders_current
         .filter(since("report_date", as_of, years=years))
         .select("report_date", "mall", "order_id", "member_id", "payment_amount",
                 J.parse("raw_json", J.ORDER_JSON).alias("_j"))        # parsed once per row
         .select("report_date", "mall", "order_id", "member_id", "payment_amount",
                 ((j["paid"] == "T") & (j["canceled"] == "F")).alias("paid"),
                 net_charge(j).alias("net_charge")))
    paid = F.col("paid")
    revenue = F.sum(F.when(paid, F.col("payment_amount")).otherwise(0.0))
    n_orders = F.count_distinct(F.when(paid, F.col("order_id")))
    return o.groupBy("report_date", "mall").agg(
        n_orders.alias("orders"),
        revenue.alias("revenue"),
        vat_excluded(F.sum("net_charge")).alias("net_sales"),
        safe_ratio(revenue, n_orders).alias("aov"),
        F.count_distinct(F.when(paid, F.col("member_id"))).alias("member_buyers"),
    )


# ------------------------------------------------------------------- P3
FIN_SHOPS = [1, 4]


def financial_daily(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Per day x brand money breakdown of paid orders (shops 1 and 4 only).

    Items are counted per (order, day, shop) *before* the join, so the join
    cannot fan out and the shuffled side is one row per order.
    """
    j = J.parse("raw_json", J.ORDER_JSON)
    # parsed once into a column of its own; what the join carries is read from it
    o = (orders.filter(F.col("shop_no").isin(*FIN_SHOPS))
         .select("report_date", "mall", "shop_no", "order_id", j.alias("j"))
         .withColumn("paid", F.col("j.paid")).filter(F.col("paid") == "T").drop("paid"))
    it = (items.filter(F.col("shop_no").isin(*FIN_SHOPS))
          .groupBy("report_date", "shop_no", "order_id").agg(F.count(F.lit(1)).alias("n")))
    x = o.join(it, ["order_id", "report_date", "shop_no"], "left")

    def ini(f):
        return safe_double(F.col("j.initial_order_amount")[f])

    def act(f):
        return safe_double(F.col("j.actual_order_amount")[f])

    def pay(get):
        return (get("order_price_amount") - _z(get("shipping_fee_discount_amount"))
                + get("shipping_fee") - get("coupon_discount_price"))

    cancelled = F.col("j.canceled") == "T"
    return x.groupBy("report_date", "mall").agg(
        F.count(F.lit(1)).alias("order_count"),
        F.sum(F.coalesce(F.col("n"), F.lit(0))).alias("item_count"),
        F.round(F.sum(ini("order_price_amount"))).alias("product_order_amount"),
        F.round(F.sum(ini("shipping_fee_discount_amount"))).alias("order_sale_price"),
        F.round(F.sum(ini("shipping_fee"))).alias("shipping_fee"),
        F.round(F.sum(ini("coupon_discount_price"))).alias("coupon_discount_amount"),
        F.round(F.sum(pay(ini))).alias("actual_payment_amount"),
        F.round(F.sum(ini("points_spent_amount"))).alias("used_points"),
        F.round(F.sum(ini("credits_spent_amount"))).alias("used_credits"),
        F.round(F.sum(safe_double(F.col("j.naver_point")))).alias("used_naver_total"),
        F.round(F.sum(F.when(cancelled, pay(ini) - pay(act)).otherwise(0.0))).alias("refund_amount"),
        F.round(F.sum(F.when(cancelled, ini("points_spent_amount") - act("points_spent_amount"))
                      .otherwise(0.0))).alias("refund_points"),
    )


# ------------------------------------------------------------------- P4
def repurchase_daily(orders: DataFrame) -> DataFrame:
    """Member purchase sequence per day.

    Only sequence numbers 1 and 2 are needed (repurchase = all member orders
    minus first purchases), so the window is followed by ``rn <= 2``; Spark
    turns that into a map-side WindowGroupLimit, which keeps at most two rows
    per member per task before the shuffle.  A member holding a large share
    of all orders therefore never lands whole in one task.
    """
    m = (orders.filter(F.col("member_id").isNotNull() & (F.col("member_id") != ""))
         .select("report_date", "mall", "member_id", "order_id", "ordered_at"))
    counts = m.groupBy("report_date", "mall").agg(F.count(F.lit(1)).alias("member_orders"))
    w = Window.partitionBy("mall", "member_id").orderBy(
        F.col("ordered_at").asc_nulls_first(), F.col("order_id").asc_nulls_first())
    firsts = (m.withColumn("seq", F.row_number().over(w)).filter(F.col("seq") <= 2)
              .groupBy("report_date", "mall")
              .agg(F.count_if(F.col("seq") == 1).alias("first_purchase"),
                   F.count_if(F.col("seq") == 2).alias("first_repurchase")))
    r = counts.join(firsts, ["report_date", "mall"], "left")
    fp = F.coalesce(F.col("first_purchase"), F.lit(0)).cast("bigint")
    rep = F.col("member_orders") - fp
    return r.select(
        "report_date", "mall", "member_orders",
        fp.alias("first_purchase"),
        F.coalesce(F.col("first_repurchase"), F.lit(0)).cast("bigint").alias("first_repurchase"),
        rep.alias("repurchase_orders"),
        safe_ratio(rep, F.col("member_orders")).alias("repurchase_rate"),
    )


# ------------------------------------------------------------------ P10
def product_sales(items_current: DataFrame, as_of: dt.date, years: int = 2,
                  names: DataFrame | None = None) -> DataFrame:
    """Cancel-aware product sales per day x brand x product.

    ``names`` (product_no, product_name) is optional: when the landed items
    carry no name, names are attached *after* aggregation so only the small
    aggregate meets the product master.
    """
    j = F.col("_j")
    cols = ["report_date", "mall", "product_no", "order_id", "quantity", "product_price"]
    has_name = "product_name" in items_current.columns
    if has_name:
        cols.append("product_name")
    i = (items_current.filter(since("report_date", as_of, years=years))
         .select(*cols, J.parse("raw_json", J.ITEM_JSON).alias("_j"))
         .select(*cols,
                 j["status_code"].like("C%").alias("canceled"),
                 F.coalesce(strict_double(j["option_price"]), F.lit(0.0)).alias("option_price")))
    c = F.col("canceled")
    line = F.col("quantity") * (F.col("product_price") + F.col("option_price"))
    gross = F.sum(F.when(c, 0.0).otherwise(line))
    aggs = [F.sum(F.when(c, 0).otherwise(F.col("quantity"))).alias("qty"),
            gross.alias("gross_sales"),
            vat_excluded(gross).alias("net_sales"),
            F.count_distinct(F.when(c, F.lit(None)).otherwise(F.col("order_id"))).alias("order_count")]
    if has_name:
        aggs.insert(0, F.max("product_name").alias("product_name"))
    out = i.groupBy("report_date", "mall", "product_no").agg(*aggs)
    if not has_name and names is not None:
        out = out.join(names, "product_no", "left")
    elif not has_name:
        out = out.withColumn("product_name", F.lit(None).cast("string"))
    return out.select("report_date", "mall", "product_no", "product_name",
                      "qty", "gross_sales", "net_sales", "order_count")
