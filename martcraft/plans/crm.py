"""CRM audience (P13): product buyers -> contact -> suppression -> consent.

The segment is built from joins and aggregations only; nothing is fetched
per row and nothing is collected.  The product list per member keeps only
the three smallest distinct names: a per-member ``row_number() <= 3`` that
Spark evaluates map-side (WindowGroupLimit) before the shuffle, so even a
member with a huge order history contributes at most three rows per task.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martcraft.functions.classify import consented
from martcraft.functions.dates import lag_days, since
from martcraft.functions.json import ITEM_JSON, parse
from martcraft.functions.numeric import safe_double
from martcraft.functions.privacy import digits_only
from martcraft.operators.ordering import with_row_number
from martcraft.session import materialize

# Send channels and consent notes of the audience file.
CHANNEL_MEMBER = "알림톡"
CHANNEL_GUEST = "LMS"
NOTE_MEMBER = "회원-알림톡(정보성,동의무관)"
NOTE_GUEST = "비회원-LMS(광고성): 수신동의 별도확보 필수"
AUDIENCE_COLUMNS = ["customer_type", "send_channel", "mall", "ref", "name", "cellphone", "email",
                    "sms_agree", "email_agree", "consent_note", "products", "last_order_date",
                    "days_since_order", "order_count", "spend", "used_coupon"]


@dataclass(frozen=True)
class AudienceSpec:
    product_nos: tuple[str, ...] = ()
    product_kw: str = ""
    option_include: str = ""
    option_exclude: str = ""
    exclude_nos: tuple[str, ...] = ()
    exclude_kw: str = ""
    days: int = 30
    mall: str = "all"
    min_orders: int = 1
    min_spend: float = 0.0
    coupon: str = "any"            # any | used | notused
    include_guest: bool = False
    channel: str = "all"           # all | sms | email
    member_consent: bool = False

    def __post_init__(self):
        if not self.product_nos and not self.product_kw:
            raise ValueError("a product number list or a product keyword is required")
        if self.coupon not in ("any", "used", "notused"):
            raise ValueError("coupon must be any, used or notused")


def product_predicate(nos, kw) -> Column | None:
    """PRJ14: product_no IN list OR name LIKE %kw% (wildcards in kw stay live)."""
    parts = []
    if nos:
        parts.append(F.col("product_no").isin(*nos))
    if kw:
        parts.append(F.col("product_name").like(f"%{kw}%"))
    if not parts:
        return None
    out = parts[0]
    for p in parts[1:]:
        out = out | p
    return out


def _coupon_filter(df: DataFrame, coupon: str) -> DataFrame:
    if coupon == "used":
        return df.filter(F.col("used_coupon") == 1)
    if coupon == "notused":
        return df.filter(F.col("used_coupon") == 0)
    return df


def segment(orders: DataFrame, items: DataFrame, spec: AudienceSpec, as_of: dt.date) -> DataFrame:
    """Members (aggregated) and optionally guests (per order) who bought the
    products; columns customer_type, mall, shop_no, ref, last_order_date,
    days_since, order_count, spend, used_coupon, products."""
    j = F.col("_j")
    window = since("report_date", as_of, days=spec.days)
    it = items.filter(window).select(
        "order_id", "mall", "product_no", "product_name", parse("raw_json", ITEM_JSON).alias("_j")).select(
        "order_id", "mall", "product_no", "product_name", j["option_value"].alias("option_value"),
        F.coalesce(safe_double(j["coupon_discount_price"]), F.lit(0.0)).alias("coupon"))
    o = orders.filter(window).select(
        "mall", "shop_no", "member_id", "order_id", "report_date", "payment_amount")
    cond = product_predicate(spec.product_nos, spec.product_kw)
    if spec.option_include:
        cond = cond & F.col("option_value").like(f"%{spec.option_include}%")
    if spec.option_exclude:
        cond = cond & (F.col("option_value").isNull()
                       | ~F.col("option_value").like(f"%{spec.option_exclude}%"))
    b_cond = product_predicate(spec.exclude_nos, spec.exclude_kw)
    # One pass over the window's lines marks each order that has a wanted or an unwanted line
    # (the brand filter holds for wanted ones only); members, their top products and guests read it.
    lines = (it.withColumn("_wanted", F.coalesce(cond, F.lit(False)))
             .withColumn("_unwanted", F.lit(False) if b_cond is None else F.coalesce(b_cond, F.lit(False)))
             .filter("_wanted or _unwanted")
             .select("order_id", "mall", "_wanted", "_unwanted",
                     F.when(F.col("_wanted"), F.when(F.col("coupon") > 0, 1).otherwise(0)).alias("used_coupon"),
                     F.when(F.col("_wanted"), F.col("product_name")).alias("a_product")))
    marked = materialize(
        o.join(lines, ["order_id", "mall"])
         .groupBy("mall", "shop_no", "member_id", "order_id", "report_date", "payment_amount")
         .agg(F.max("_wanted").alias("_wanted"), F.max("_unwanted").alias("_unwanted"),
              F.max("used_coupon").alias("used_coupon"), F.max("a_product").alias("a_product")))
    a = marked.filter("_wanted")
    if spec.mall != "all":
        a = a.filter(F.col("mall") == spec.mall)
    is_member = F.col("member_id").isNotNull() & (F.col("member_id") != "")
    mem = a.filter(is_member)
    if b_cond is not None:
        # B buyers: members in the window, ignoring the brand filter on purpose.
        b = marked.filter("_unwanted").filter(is_member).select("mall", "member_id").distinct()
        mem = mem.join(b, ["mall", "member_id"], "left_anti")
    top = top_products(mem)
    members = (mem.groupBy("mall", "member_id").agg(
                   F.max("shop_no").alias("shop_no"),
                   F.max("report_date").alias("last_order_date"),
                   F.count(F.lit(1)).alias("order_count"),
                   F.sum("payment_amount").alias("spend"),
                   F.max("used_coupon").alias("used_coupon"))
               .filter((F.col("order_count") >= spec.min_orders) & (F.col("spend") >= spec.min_spend)))
    members = _coupon_filter(members, spec.coupon).join(top, ["mall", "member_id"], "left")
    out = members.select(
        F.lit("member").alias("customer_type"), "mall", "shop_no",
        F.col("member_id").alias("ref"), "last_order_date",
        lag_days(as_of, "last_order_date").alias("days_since"),
        "order_count", "spend", F.col("used_coupon").cast("int").alias("used_coupon"), "products")
    if spec.include_guest:
        g = _coupon_filter(a.filter(~is_member | F.col("member_id").isNull()), spec.coupon).select(
            F.lit("guest").alias("customer_type"), "mall", "shop_no",
            F.col("order_id").alias("ref"), F.col("report_date").alias("last_order_date"),
            lag_days(as_of, "report_date").alias("days_since"),
            F.lit(1).cast("bigint").alias("order_count"), F.col("payment_amount").alias("spend"),
            F.col("used_coupon").cast("int").alias("used_coupon"),
            F.col("a_product").alias("products"))
        out = out.unionByName(g)
    return out


def top_products(mem: DataFrame, k: int = 3) -> DataFrame:
    """AG8 / ST3: the k smallest distinct product names per member, joined by
    ','.  ``row_number() <= k`` lets Spark keep at most k rows per member in
    each task before the shuffle (map-side WindowGroupLimit), so the list is
    bounded whatever a member's history size."""
    return (mem.select("mall", "member_id", "a_product").filter(F.col("a_product").isNotNull())
            .distinct()
            .withColumn("rn", F.row_number().over(
                Window.partitionBy("mall", "member_id").orderBy("a_product")))
            .filter(F.col("rn") <= k)
            .groupBy("mall", "member_id")
            .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rn", "a_product"))),
                                          lambda s: s["a_product"]), ",").alias("products")))


def suppression_list(sheet: DataFrame) -> DataFrame:
    """SRC18: trim, drop empty, digits only, first occurrence (sheet order) wins.

    Deduplication is an aggregation (min row number per digits), so it is
    partial-aggregated before the shuffle."""
    s = sheet.select("row_no", F.trim("reg").alias("reg"), F.trim("phone").alias("phone"))
    s = s.filter(F.col("phone") != "").withColumn("phone_digits", digits_only("phone"))
    s = s.filter(F.col("phone_digits") != "")
    first = s.groupBy("phone_digits").agg(
        F.min_by(F.struct("reg", "phone"), F.col("row_no")).alias("f"))
    return first.select(F.col("f.reg").alias("reg"), F.col("f.phone").alias("phone"), "phone_digits")


def with_contacts(seg: DataFrame, member_contacts: DataFrame, guest_contacts: DataFrame,
                  blocklist: DataFrame, spec: AudienceSpec) -> DataFrame:
    """JN8 + JN9 + consent: every segment row with a ``status`` of
    no_contact / blocked / skip_consent / send, and the output columns."""
    def contact(df, ref, kind):
        mobile = F.nullif(F.col("cellphone"), F.lit(""))
        if "phone" in df.columns:                    # the landline stands in for a missing mobile number
            mobile = F.coalesce(mobile, F.col("phone"))
        return df.select("shop_no", F.col(ref).alias("ref"), F.lit(kind).alias("customer_type"), "name",
                         F.coalesce(mobile, F.col("cellphone")).alias("cellphone"), "email", "sms", "news_mail")

    mc = contact(member_contacts, "member_id", "member")
    gc = contact(guest_contacts, "order_id", "guest")
    contacts = mc.unionByName(gc)
    x = seg.join(contacts, ["customer_type", "shop_no", "ref"], "left")
    blocked_digits = blocklist.select(F.col("phone_digits").alias("_d")).distinct()
    x = x.withColumn("_d", digits_only(F.coalesce(F.col("cellphone"), F.lit(""))))
    # contacts without a number share one key and can match nothing: they skip the join
    numbered = x.filter(F.col("_d") != "").join(blocked_digits.withColumn("_blocked", F.lit(True)), "_d", "left")
    x = numbered.unionByName(x.filter(F.col("_d") == "").withColumn("_blocked", F.lit(None).cast("boolean")))
    member = F.col("customer_type") == "member"
    has_contact = (F.coalesce(F.col("cellphone"), F.lit("")) != "") | \
                  (F.coalesce(F.col("email"), F.lit("")) != "")
    sms_u = F.upper(F.coalesce(F.col("sms"), F.lit("")))
    news_u = F.upper(F.coalesce(F.col("news_mail"), F.lit("")))
    status = (F.when(~has_contact, F.lit("no_contact"))
               .when(F.col("_blocked").isNotNull(), F.lit("blocked")))
    if spec.member_consent:
        status = status.when(member & ~consented(sms_u, news_u, spec.channel), F.lit("skip_consent"))
    status = status.otherwise(F.lit("send"))
    return x.select(
        status.alias("status"),
        "customer_type",
        F.when(member, F.lit(CHANNEL_MEMBER)).otherwise(F.lit(CHANNEL_GUEST)).alias("send_channel"),
        "mall", "ref", "name", "cellphone", "email",
        sms_u.alias("sms_agree"), news_u.alias("email_agree"),
        F.when(member, F.lit(NOTE_MEMBER)).otherwise(F.lit(NOTE_GUEST)).alias("consent_note"),
        "products", "last_order_date", F.col("days_since").alias("days_since_order"),
        "order_count", "spend", "used_coupon")


def audience(rows_with_status: DataFrame) -> DataFrame:
    """The send list, ordered as the file is written (ST1)."""
    return (rows_with_status.filter(F.col("status") == "send").select(*AUDIENCE_COLUMNS)
            .orderBy(F.col("customer_type").asc(), F.col("last_order_date").desc()))


# The file's order (ST1), made total by brand and reference.
AUDIENCE_ORDER = ["customer_type", "-last_order_date", "mall", "ref"]


def numbered_audience(rows_with_status: DataFrame) -> DataFrame:
    """The send list with each row's place in the file, so that the order survives any storage."""
    order = [F.col(c[1:]).desc() if c.startswith("-") else F.col(c).asc() for c in AUDIENCE_ORDER]
    return with_row_number(rows_with_status.filter(F.col("status") == "send").select(*AUDIENCE_COLUMNS), order)


def funnel(rows_with_status: DataFrame) -> DataFrame:
    return rows_with_status.groupBy("customer_type", "status").agg(F.count(F.lit(1)).alias("n"))
