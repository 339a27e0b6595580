"""Ad action arrays (F2, F12, JN10, ST2, AG12).

The source expresses the pick as a join of the unnested array with the
unnested priority list ordered by priority, LIMIT 1 (JN10 + ST2); here it is
the same result without a join or explode.

An ad row carries ``actions`` / ``action_values`` as JSON arrays of
``{action_type, value, 1d_click, 7d_click, 1d_view, 1d_ev}``.  The priority
pick returns the entry of the first type in a priority list that is present;
with a duplicated type the last entry wins.  Everything is a higher-order
function over the parsed array, so no join, explode or UDF is involved.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from martcraft.functions import json as J
from martcraft.functions.numeric import safe_double, strict_double

# Action-type priority lists (first = preferred).
PURCHASE_TYPES = ["offsite_conversion.fb_pixel_purchase", "purchase", "omni_purchase"]
LANDING_VIEW_TYPES = ["landing_page_view", "omni_landing_page_view"]
ADD_TO_CART_TYPES = ["offsite_conversion.fb_pixel_add_to_cart", "add_to_cart", "omni_add_to_cart"]
VIEW_CONTENT_TYPES = ["offsite_conversion.fb_pixel_view_content", "view_content", "omni_view_content"]
REGISTER_TYPES = ["offsite_conversion.fb_pixel_complete_registration", "complete_registration",
                  "omni_complete_registration"]
LEAD_TYPES = ["offsite_conversion.fb_pixel_lead", "lead", "onsite_web_lead"]
CHECKOUT_TYPES = ["offsite_conversion.fb_pixel_initiate_checkout", "initiate_checkout",
                  "omni_initiated_checkout"]
# The audit log adds these up instead of picking one.
PURCHASE_SET = ["purchase", "omni_purchase", "offsite_conversion.fb_pixel_purchase"]


def parse_actions(col: Column | str) -> Column:
    return J.parse(col, J.ACTION_ARRAY)


def action_pick(arr: Column, types: list[str]) -> Column:
    """F12 ``action_obj``: struct of the highest-priority type present, else NULL."""
    def is_type(t):
        return lambda a: a["action_type"] == F.lit(t)

    per_type = F.array(*[F.try_element_at(F.filter(arr, is_type(t)), F.lit(-1)) for t in types])
    return F.try_element_at(F.filter(per_type, lambda x: x.isNotNull()), F.lit(1))


def action_value(arr: Column, types: list[str], strict: bool = True) -> Column:
    """F12 ``action_val``: value of the picked entry as double.

    The SQL function casts strictly (bad text fails the query); the loader's
    twin returns NULL instead: pass ``strict=False`` for that behaviour.
    """
    v = action_pick(arr, types)["value"]
    return strict_double(v) if strict else safe_double(v)


def sum_types(arr: Column, types: list[str] = PURCHASE_SET) -> Column:
    """AG12: sum of the values of every entry whose type is in ``types``.

    NULL/empty array -> 0.0; a missing/empty value counts 0.
    """
    hits = F.filter(F.coalesce(arr, F.array().cast(J.ACTION_ARRAY)),
                    lambda a: a["action_type"].isin(*types))
    return F.aggregate(hits, F.lit(0.0),
                       lambda acc, a: acc + F.coalesce(safe_double(a["value"]), F.lit(0.0)))
