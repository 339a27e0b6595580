"""Web-analytics report shapers (SRC13, SRC14, SRC15).

Report rows arrive with dimension values and metric values as text.  The
date is 'yyyyMMdd' and parsed strictly (a malformed date fails the load, as
in the reference) unless ``quarantine`` is set, in which case such rows are
kept with a NULL date for inspection.  Empty metrics count 0; integer
metrics truncate through double ('3.9' -> 3).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martcraft.functions.numeric import metric_or_zero

# Report dimensions / metrics -> column names.
SESSION_DIMS = {
    "sessionSource": "session_source", "sessionMedium": "session_medium",
    "sessionCampaignName": "session_campaign_name",
    "sessionManualCampaignName": "session_manual_campaign_name",
    "sessionManualTerm": "session_manual_term",
    "sessionManualAdContent": "session_manual_ad_content",
    "sessionDefaultChannelGroup": "session_default_channel_group",
    "firstUserSourceMedium": "first_user_source_medium",
}
SESSION_METRICS = {
    "sessions": "sessions", "totalUsers": "total_users", "newUsers": "new_users",
    "addToCarts": "add_to_carts", "checkouts": "checkouts",
    "ecommercePurchases": "ecommerce_purchases", "purchaseRevenue": "purchase_revenue",
    "firstTimePurchasers": "first_time_purchasers", "activeUsers": "active_users",
    "userEngagementDuration": "user_engagement_duration",
}
SESSION_FLOATS = {"purchase_revenue", "user_engagement_duration"}
TX_DIMS = {
    "transactionId": "transaction_id", "sessionSource": "session_source",
    "sessionMedium": "session_medium", "sessionCampaignName": "session_campaign_name",
    "sessionCampaignId": "session_campaign_id",
    "sessionDefaultChannelGroup": "session_default_channel_group",
}
TX_METRICS = {"purchaseRevenue": "purchase_revenue", "taxAmount": "tax_amount",
              "shippingAmount": "shipping_amount", "ecommercePurchases": "ecommerce_purchases"}
TX_FLOATS = {"purchase_revenue", "tax_amount", "shipping_amount"}
NOT_TRANSACTION = ["", "(not set)", "(not_set)"]
ITEM_DIMS = {"itemName": "item_name", "itemId": "item_id"}
ITEM_METRICS = {"itemsViewed": "items_viewed", "itemsAddedToCart": "items_added_to_cart",
                "itemsCheckedOut": "items_checked_out", "itemsPurchased": "items_purchased",
                "itemRevenue": "item_revenue"}
ITEM_FLOATS = {"item_revenue"}


def report_date(col: Column | str, quarantine: bool = False) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    if quarantine:
        return F.try_to_date(c, "yyyyMMdd")
    ok = c.rlike(r"^\d{8}$") & F.try_to_date(c, "yyyyMMdd").isNotNull()
    return F.when(c.isNotNull() & ~ok, F.raise_error(F.lit("report date is not yyyyMMdd"))) \
            .otherwise(F.try_to_date(c, "yyyyMMdd"))


def _shape(rows: DataFrame, dims: dict, metrics: dict, floats: set, quarantine: bool) -> DataFrame:
    cols = [F.col("brand"), F.col("property_id"), report_date("date", quarantine).alias("date")]
    cols += [F.col(k).alias(v) for k, v in dims.items()]
    cols += [metric_or_zero(k, as_long=v not in floats).alias(v) for k, v in metrics.items()]
    cols.append(F.current_timestamp().alias("loaded_at"))
    return rows.select(*cols)


def shape_sessions(rows: DataFrame, quarantine: bool = False) -> DataFrame:
    return _shape(rows, SESSION_DIMS, SESSION_METRICS, SESSION_FLOATS, quarantine)


def shape_transactions(rows: DataFrame, quarantine: bool = False) -> DataFrame:
    real = ~F.trim(F.coalesce(F.col("transactionId"), F.lit(""))).isin(*NOT_TRANSACTION)
    return _shape(rows.filter(real), TX_DIMS, TX_METRICS, TX_FLOATS, quarantine)


def shape_items(rows: DataFrame, quarantine: bool = False) -> DataFrame:
    return _shape(rows, ITEM_DIMS, ITEM_METRICS, ITEM_FLOATS, quarantine)
