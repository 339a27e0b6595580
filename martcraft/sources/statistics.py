"""Commerce statistics (SRC3): 23 reports, one generic table shape.

A spec names the array key candidates of the response, the record keys of
dim1/dim2/val1/val2 (first non-empty wins) and whether the report has no
date of its own (``per_day``: the requested day is stamped).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martcraft.functions.numeric import safe_double
from martcraft.sources.records import explode_list, f, first_list, is_list, parse_record, s


@dataclass(frozen=True)
class StatSpec:
    keys: tuple[str, ...]
    dim1: tuple[str, ...] = ()
    dim2: tuple[str, ...] = ()
    val1: tuple[str, ...] = ()
    val2: tuple[str, ...] = ()
    per_day: bool = False


# Report specs (array keys, dims, values, per-day stamping).
SPECS: dict[str, StatSpec] = {
    "sales_daily": StatSpec(("times", "sales", "data"), ("hour",), (), ("order_amount",),
                            ("order_count", "buyers_count")),
    "product_sales": StatSpec(("sales", "products", "data"), ("product_no",), ("product_name",),
                              ("order_amount",), ("order_count", "order_product_count")),
    "traffic": StatSpec(("view", "visitors", "data"), (), (), ("visit_count",),
                        ("re_visit_count", "first_visit_count")),
    "traffic_keyword": StatSpec(("keywords", "data"), ("keyword",), (), ("visit_count",), ("order_count",)),
    "members": StatSpec(("sales", "members", "data"), (), (), ("member_order_amount",),
                        ("nonmember_order_amount",)),
    "cart_action": StatSpec(("action",), ("product_no",), ("product_name",), ("add_cart_count",),
                            ("count",), True),
    "product_view": StatSpec(("view",), ("product_no",), ("product_name",), ("count",), (), True),
    "visitors_unique": StatSpec(("unique",), (), (), ("unique_visit_count",)),
    "visitors_pageview": StatSpec(("pageview",), (), (), ("page_view",)),
    "visitors_dau": StatSpec(("dailyactive",), (), (), ("user_count",)),
    "sales_paymethod": StatSpec(("paymethods",), ("payment_method",), (), ("order_amount",),
                                ("order_count",), True),
    "keyword_detail": StatSpec(("keyworddetails",), ("keyword",), ("engine",), ("order_amount",),
                               ("purchase_count", "visit_count"), True),
    "referrer_domain": StatSpec(("domains",), ("domain",), (), ("visit_count",), (), True),
    "referrer_ad": StatSpec(("ads",), ("ad",), (), ("visit_count",), (), True),
    "ad_sales": StatSpec(("adsales",), ("ad",), (), ("order_amount",), ("order_count",), True),
    "adkeyword_sales": StatSpec(("adkeywordsales",), ("ad",), ("keyword",), ("order_amount",),
                                ("order_count",), True),
    "keyword_sales": StatSpec(("keywordsales",), ("keyword",), (), ("order_amount",), ("order_count",), True),
    "domain_sales": StatSpec(("domainsales",), ("domain",), (), ("order_amount",), ("order_count",), True),
    "ad_effect": StatSpec(("addetails",), ("ad",), ("keyword",), ("order_amount",), ("purchase_count",), True),
    "category_sales": StatSpec(("categorydetails",), ("category_name",), ("product_name",),
                               ("sales_price_per_category",), ("sales_count_per_category",), True),
    "sales_pervisitor": StatSpec(("pervisitors",), (), (), ("order_amount_per_buyer",),
                                 ("order_amount_per_visitor",), True),
    "pages_view": StatSpec(("view",), ("url",), (), ("count",), ("visit_count",), True),
    "referrer_url": StatSpec(("urls",), ("url",), (), ("visit_count",), (), True),
}


def shape_stat(responses: DataFrame, spec: StatSpec, value_col: str = "value") -> DataFrame:
    """Responses (shop_no, mall, day, window_end, JSON text) -> generic rows.

    ``day`` is the requested day (used when ``per_day``), ``window_end`` the
    fallback date of records without one."""
    resp = responses.select("shop_no", "mall", "day", "window_end", F.col(value_col).alias("_v"),
                            parse_record(value_col).alias("_doc"))
    lst = first_list(F.col("_v"), list(spec.keys), parsed=F.col("_doc"))
    recs = resp.select("shop_no", "mall", "day", "window_end", explode_list(lst).alias("rec_text"))
    # entries that are no objects are no records
    recs = recs.select("*", parse_record("rec_text").alias("_m")).filter(F.col("_m").isNotNull())
    m = F.col("_m")
    if spec.per_day:
        d = F.col("day").cast("string")
    else:
        d = F.coalesce(s(m, "date", "report_date", "std_date"), F.col("window_end").cast("string"))
    null_s = F.lit(None).cast("string")
    null_d = F.lit(None).cast("double")
    return recs.select(
        F.try_to_date(F.substring(d, 1, 10), "yyyy-MM-dd").alias("report_date"),
        F.col("shop_no").cast("bigint").alias("shop_no"), "mall",
        (s(m, *spec.dim1) if spec.dim1 else null_s).alias("dim1"),
        (s(m, *spec.dim2) if spec.dim2 else null_s).alias("dim2"),
        (f(m, *spec.val1) if spec.val1 else null_d).alias("val1"),
        (f(m, *spec.val2) if spec.val2 else null_d).alias("val2"),
        F.col("rec_text").alias("raw_json"),
        F.current_timestamp().alias("ingested_at"))


def spec_table(spark: SparkSession, specs: dict[str, StatSpec] = SPECS) -> DataFrame:
    """The specs as rows, one per report."""
    rows = [(name, list(x.keys), list(x.dim1), list(x.dim2), list(x.val1), list(x.val2), x.per_day)
            for name, x in specs.items()]
    texts = ", ".join(f"_{c} array<string>" for c in ("keys", "dim1", "dim2", "val1", "val2"))
    return spark.createDataFrame(rows, f"report string, {texts}, _per_day boolean")


def _first_of(rec: Column, keys: Column, good=lambda v: v != "") -> Column:
    """Value of the first key in ``keys`` (an array column) for which ``good`` holds."""
    return F.try_element_at(F.filter(F.transform(keys, lambda k: F.try_element_at(rec, k)), good), F.lit(1))


def shape_stats(responses: DataFrame, specs: dict[str, StatSpec] = SPECS, value_col: str = "value") -> DataFrame:
    """All reports in one pass: responses (report, shop_no, mall, day, window_end, JSON text) -> report + generic row.

    The specs meet the responses by the report's name, so a new report is a row and not a job; responses of unknown
    reports are left out."""
    table = F.broadcast(spec_table(responses.sparkSession, specs))        # as many rows as there are specs
    resp = (responses.select("report", "shop_no", "mall", "day", "window_end", F.col(value_col).alias("_v"))
            .join(table, "report").withColumn("_doc", parse_record("_v")))
    listed = F.when(is_list(F.col("_v")), F.col("_v")).otherwise(F.coalesce(
        _first_of(F.col("_doc"), F.col("_keys"), is_list),
        F.try_element_at(F.filter(F.map_values("_doc"), is_list), F.lit(1))))
    recs = (resp.withColumn("rec_text", explode_list(listed)).drop("_v", "_doc")
            .withColumn("_m", parse_record("rec_text")).filter(F.col("_m").isNotNull()))
    m = F.col("_m")
    d = F.when(F.col("_per_day"), F.col("day").cast("string")).otherwise(
        F.coalesce(s(m, "date", "report_date", "std_date"), F.col("window_end").cast("string")))
    text = lambda c: _first_of(m, F.col(c))
    return recs.select(
        "report", F.try_to_date(F.substring(d, 1, 10), "yyyy-MM-dd").alias("report_date"),
        F.col("shop_no").cast("bigint").alias("shop_no"), "mall",
        text("_dim1").alias("dim1"), text("_dim2").alias("dim2"),
        safe_double(text("_val1")).alias("val1"), safe_double(text("_val2")).alias("val2"),
        F.col("rec_text").alias("raw_json"), F.current_timestamp().alias("ingested_at"))
