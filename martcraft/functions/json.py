"""JSON access.

The reference extracts many scalars from the same JSON text with repeated
path calls.  Here each row's JSON is parsed once with ``from_json`` into a
narrow struct of strings; fields that are absent come back as NULL, which
reproduces the warehouse's JSON_VALUE on missing keys.  Numbers are kept as
their text so the caller decides between safe and strict casts.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

AMOUNT_FIELDS = [
    "order_price_amount", "shipping_fee", "points_spent_amount",
    "credits_spent_amount", "coupon_discount_price", "membership_discount_amount",
    "set_product_discount_amount", "app_discount_amount",
    "market_other_discount_amount", "shipping_fee_discount_amount",
    "coupon_shipping_fee_amount",
]

_amounts = T.StructType([T.StructField(f, T.StringType()) for f in AMOUNT_FIELDS])

ORDER_JSON = T.StructType([
    T.StructField("paid", T.StringType()),
    T.StructField("canceled", T.StringType()),
    T.StructField("naver_point", T.StringType()),
    T.StructField("initial_order_amount", _amounts),
    T.StructField("actual_order_amount", _amounts),
])

ITEM_JSON = T.StructType([
    T.StructField("status_code", T.StringType()),
    T.StructField("option_price", T.StringType()),
    T.StructField("option_value", T.StringType()),
    T.StructField("coupon_discount_price", T.StringType()),
])

ACTION_ENTRY = T.StructType([
    T.StructField("action_type", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("1d_click", T.StringType()),
    T.StructField("7d_click", T.StringType()),
    T.StructField("1d_view", T.StringType()),
    T.StructField("1d_ev", T.StringType()),
])
ACTION_ARRAY = T.ArrayType(ACTION_ENTRY)


def parse(col: Column | str, schema: T.DataType) -> Column:
    """Parse JSON text once into ``schema`` (PERMISSIVE: bad text -> NULL)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.from_json(c, schema, {"mode": "PERMISSIVE"})
