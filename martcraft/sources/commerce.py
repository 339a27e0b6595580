"""Commerce shapers (SRC1, SRC2, SRC4-SRC7, SRC21)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martcraft.functions.privacy import phone_hash, strip_personal
from martcraft.sources.records import f, parse_record, s


def resolve_shops(shop_no: Column, shop_name: Column, rules: list[tuple[list[str], str]]) -> Column:
    """SRC21: brand label from the shop name by (lower-cased) substring rules,
    checked in order; no rule -> 'shop<N>'."""
    name = F.lower(F.coalesce(shop_name, F.lit("")))
    out = None
    for needles, label in rules:
        hit = None
        for n in needles:
            c = name.contains(n.lower())
            hit = c if hit is None else (hit | c)
        out = F.when(hit, F.lit(label)) if out is None else out.when(hit, F.lit(label))
    default = F.concat(F.lit("shop"), shop_no.cast("string"))
    return default if out is None else out.otherwise(default)


def _day(text: Column) -> Column:
    return F.try_to_date(F.substring(text, 1, 10), "yyyy-MM-dd")


_ORDER_KEYS = ["order_id", "order_date", "payment_date", "created_date", "member_id", "order_status",
               "status", "payment_amount", "actual_payment_amount", "order_price_amount",
               "order_amount", "currency"]
_ORDER_SCHEMA = ", ".join(f"`{k}` string" for k in _ORDER_KEYS) + \
    ", `buyer` map<string,string>, `receivers` array<map<string,string>>"
_ITEMS_SCHEMA = "`order_id` string, `order_date` string, `payment_date` string, " \
                "`created_date` string, `items` array<string>"


def shape_orders(raw: DataFrame, secret: str, value_col: str = "value") -> DataFrame:
    """SRC1: one order JSON per row (+ shop_no, mall, window_end columns) ->
    the orders table.  report_date = first 10 characters of the first
    non-empty of order/payment/created date, else the window end (a split
    window end may be a datetime, so it is truncated to a date too).

    Each JSON text is parsed once, into a struct of only the keys read here
    (JSON scalars as text), in its own projection."""
    r = raw.select("shop_no", "mall", "window_end", F.col(value_col).alias("_v"),
                   F.from_json(F.col(value_col), _ORDER_SCHEMA).alias("_r"))
    m = F.col("_r")
    rc = F.try_element_at(m["receivers"], F.lit(1))
    d = F.coalesce(_day(s(m, "order_date", "payment_date", "created_date")),
                   _day(F.col("window_end").cast("string")))
    return r.select(
        d.alias("report_date"),
        s(m, "order_id").alias("order_id"),
        F.col("shop_no").cast("bigint").alias("shop_no"), "mall",
        s(m, "member_id").alias("member_id"),
        phone_hash(m["buyer"]["cellphone"], m["buyer"]["phone"], rc["cellphone"], rc["phone"],
                   secret).alias("buyer_hash"),
        s(m, "order_status", "status").alias("order_status"),
        f(m, "payment_amount", "actual_payment_amount").alias("payment_amount"),
        f(m, "order_price_amount", "order_amount").alias("order_amount"),
        s(m, "currency").alias("currency"),
        F.try_to_timestamp(s(m, "order_date", "payment_date")).alias("ordered_at"),
        strip_personal(F.col("_v")).alias("raw_json"),
        F.current_timestamp().alias("ingested_at"),
    )


def explode_order_items(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """SRC2: ``items[]`` -> one row per line (non-outer: an order without
    items yields none); quantity = int(float or 0), price = first non-empty
    of product_price, payment_amount."""
    r = raw.select("shop_no", "mall", "window_end",
                   F.from_json(F.col(value_col), _ITEMS_SCHEMA).alias("_r"))
    m = F.col("_r")
    d = F.coalesce(_day(s(m, "order_date", "payment_date", "created_date")),
                   _day(F.col("window_end").cast("string")))
    base = r.select(d.alias("report_date"), s(m, "order_id").alias("order_id"),
                    F.col("shop_no").cast("bigint").alias("shop_no"), "mall",
                    F.explode(m["items"]).alias("item"))
    b = base.select("*", parse_record("item").alias("_i"))
    it = F.col("_i")
    q = f(it, "quantity")
    return b.select(
        "report_date", "order_id", "shop_no", "mall",
        s(it, "product_no").alias("product_no"),
        s(it, "variant_code").alias("variant_code"),
        s(it, "product_name").alias("product_name"),
        F.coalesce(F.when(q.isNotNull(), F.floor(F.abs(q)) * F.signum(q)), F.lit(0))
         .cast("bigint").alias("quantity"),
        f(it, "product_price", "payment_amount").alias("product_price"),
        F.col("item").alias("raw_json"),
        F.current_timestamp().alias("ingested_at"),
    )


def shape_order_attribution(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """SRC4: order-level first-touch attribution records."""
    raw = raw.select("*", parse_record(value_col).alias("_r"))
    m = F.col("_r")
    day = F.coalesce(_day(s(m, "order_date")), F.col("day").cast("date"))
    return raw.select(
        day.alias("report_date"), F.col("shop_no").cast("bigint").alias("shop_no"), "mall",
        s(m, "order_id").alias("order_id"), s(m, "ad").alias("ad"), s(m, "keyword").alias("keyword"),
        s(m, "medium").alias("medium"), s(m, "campaign").alias("campaign"),
        s(m, "content").alias("content"), s(m, "payment_method").alias("payment_method"),
        f(m, "order_amount").alias("order_amount"),
        F.col(value_col).alias("raw_json"), F.current_timestamp().alias("ingested_at"))


def snapshot_products(raw: DataFrame, snapshot: dt.date, value_col: str = "value") -> DataFrame:
    """SRC5: product master stamped with the snapshot day."""
    raw = raw.select("*", parse_record(value_col).alias("_r"))
    m = F.col("_r")
    return raw.select(
        F.lit(snapshot).alias("snapshot_date"), F.col("shop_no").cast("bigint").alias("shop_no"),
        "mall", s(m, "product_no").alias("product_no"), s(m, "product_name").alias("product_name"),
        f(m, "price").alias("price"), f(m, "retail_price").alias("retail_price"),
        s(m, "display").alias("display"), s(m, "selling").alias("selling"),
        s(m, "created_date").alias("created_date"),
        F.col(value_col).alias("raw_json"), F.current_timestamp().alias("ingested_at"))


def snapshot_customers(raw: DataFrame, snapshot: dt.date, value_col: str = "value") -> DataFrame:
    """SRC6: member master stamped with the snapshot day (opt-in table)."""
    raw = raw.select("*", parse_record(value_col).alias("_r"))
    m = F.col("_r")
    return raw.select(
        F.lit(snapshot).alias("snapshot_date"), F.col("shop_no").cast("bigint").alias("shop_no"),
        "mall", s(m, "member_id").alias("member_id"), s(m, "group_no").alias("group_no"),
        s(m, "created_date").alias("created_date"),
        F.col(value_col).alias("raw_json"), F.current_timestamp().alias("ingested_at"))


def member_joins_from_counts(counts: DataFrame) -> DataFrame:
    """SRC7 (API shape): (report_date, shop_no, mall, count text) -> join_count."""
    return counts.select(
        F.col("report_date").cast("date").alias("report_date"),
        F.col("shop_no").cast("bigint").alias("shop_no"), "mall",
        F.coalesce(F.col("count").try_cast("double").cast("bigint"), F.lit(0)).alias("join_count"),
        F.current_timestamp().alias("ingested_at"))


def member_joins_from_members(members: DataFrame, date_col: str = "join_date") -> DataFrame:
    """SRC7 over member rows: daily join counts only, no personal data."""
    return (members.groupBy(F.col(date_col).cast("date").alias("report_date"), "shop_no", "mall")
            .agg(F.count(F.lit(1)).alias("join_count")))
