"""Ad-platform shapers (SRC8, SRC9, SRC11, SRC12, SRC22)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martcraft.functions import actions as A
from martcraft.functions.numeric import safe_double
from martcraft.sources.records import parse_record


def brand_of(account: Column, mapping: dict, default: str | None = "unknown") -> Column:
    """PRJ2: account id -> brand through a literal map (stays in codegen, no
    join); unmapped accounts get ``default`` ('unknown' daily, NULL hourly)."""
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])
    hit = m[account]
    return hit if default is None else F.coalesce(hit, F.lit(default))


def with_web_purchase(meta: DataFrame) -> DataFrame:
    """SRC8: loader columns web_purchase_value / web_purchase_count.

    The loader picks the first priority type present (duplicate type: last
    entry wins) and parses its value leniently: bad text -> NULL, no
    fall-through to the next type.
    """
    parsed = meta.withColumns({"_acts": A.parse_actions("actions"), "_vals": A.parse_actions("action_values")})
    picked = parsed.withColumns({"_acts": A.action_pick(F.col("_acts"), A.PURCHASE_TYPES),
                                 "_vals": A.action_pick(F.col("_vals"), A.PURCHASE_TYPES)})
    return picked.withColumns({"web_purchase_count": safe_double(F.col("_acts.value")),
                               "web_purchase_value": safe_double(F.col("_vals.value"))}).drop("_acts", "_vals")


# ---- fixed values: fields of a daily ad record, in landing order
META_TEXT = ["account_id", "account_name", "account_currency", "campaign_id", "campaign_name", "adset_id", "adset_name",
             "ad_id", "ad_name", "objective", "optimization_goal", "buying_type", "date_start", "date_stop"]
META_NUMBERS = ["spend", "impressions", "clicks", "reach", "frequency", "cpc", "cpm", "cpp", "ctr", "unique_clicks",
                "unique_ctr", "cost_per_unique_click", "inline_link_clicks", "inline_link_click_ctr",
                "cost_per_inline_link_click", "inline_post_engagement"]
META_NESTED = ["actions", "action_values", "conversions", "conversion_values", "cost_per_action_type",
               "cost_per_conversion", "purchase_roas", "website_purchase_roas", "video_play_actions",
               "video_p25_watched_actions", "video_p50_watched_actions", "video_p75_watched_actions",
               "video_p100_watched_actions", "video_avg_time_watched_actions", "outbound_clicks",
               "unique_outbound_clicks"]


def shape_meta(raw: DataFrame, value_col: str = "value", account_col: str = "account") -> DataFrame:
    """SRC8: landed ad records (JSON text, requested account) -> typed rows.

    Text fields as text, numbers as double (bad text -> NULL), nested fields as
    JSON text, the two web purchase columns, report_date from the record's
    start day; a record without an account takes the requested one."""
    m = F.col("_m")
    rows = raw.select(F.col(value_col).alias("raw_json"), F.col(account_col).alias("_account"),
                      parse_record(value_col).alias("_m")).filter(m.isNotNull())
    cols = [m[c].alias(c) for c in META_TEXT if c != "account_id"]
    typed = rows.select(
        F.coalesce(F.nullif(m["account_id"], F.lit("")), F.col("_account")).alias("account_id"), *cols,
        *[safe_double(m[c]).alias(c) for c in META_NUMBERS], *[m[c].alias(c) for c in META_NESTED],
        F.try_to_date(m["date_start"], "yyyy-MM-dd").alias("report_date"), "raw_json",
        F.current_timestamp().alias("ingested_at"))
    return with_web_purchase(typed)


def shape_meta_hourly(raw: DataFrame, accounts: dict) -> DataFrame:
    """SRC9: hour = int of the first two characters of 'HH:00:00 - HH:59:59';
    brand by a two-account map with NULL for the rest; counts int, spend float."""
    h = raw["hourly_stats_aggregated_by_advertiser_time_zone"]
    return raw.select(
        F.to_date("date_start").alias("report_date"),
        F.substring(h, 1, 2).try_cast("int").cast("bigint").alias("hour"),
        brand_of(F.col("account_id"), accounts, default=None).alias("mall"),
        "account_id", "account_name", "campaign_id", "campaign_name",
        "adset_id", "adset_name", "ad_id", "ad_name",
        F.coalesce(safe_double("impressions"), F.lit(0.0)).cast("bigint").alias("impressions"),
        F.coalesce(safe_double("clicks"), F.lit(0.0)).cast("bigint").alias("clicks"),
        F.coalesce(safe_double("spend"), F.lit(0.0)).alias("spend"),
    )


def google_cost(micros: Column) -> Column:
    """SRC22: cost micros -> currency."""
    return micros / F.lit(1e6)


# ---- search ads (SRC10, SRC11) ---------------------------------------------
# Stat field -> column, integer fields.
SEARCH_COLMAP = {"impCnt": "impressions", "clkCnt": "clicks", "salesAmt": "cost", "ctr": "ctr",
                 "cpc": "cpc", "avgRnk": "avg_rank", "ccnt": "conversions", "crto": "conv_rate",
                 "cpConv": "cost_per_conv", "convAmt": "conversion_value", "ror": "roas"}
SEARCH_INTS = {"impCnt", "clkCnt"}


def _metric(rec: Column, key: str) -> Column:
    v = safe_double(F.nullif(rec[key], F.lit("")))
    if key in SEARCH_INTS:
        return F.when(v.isNotNull(), F.floor(F.abs(v)) * F.signum(v)).cast("bigint")
    return v


def shape_search_ads(stats: DataFrame, keyword_map: DataFrame | None = None,
                     value_col: str = "value") -> DataFrame:
    """SRC10 + SRC11: stat records (day, media, account, customer_id, level,
    campaign_id/name or keyword id, JSON metrics) -> the search-ads table.

    Missing conversion fields (the base-metric fallback, DQ3) come out NULL.
    Keyword rows take ids and names from ``keyword_map`` (keyword_id ->
    keyword, adgroup_id/name, campaign_id/name); unmatched ids get NULL ids
    and '' names.  The map is a left join, AQE picks broadcast or shuffle
    from its measured size.
    """
    from martcraft.functions.classify import landing_type
    from martcraft.sources.records import parse_record
    rec = parse_record(value_col)
    df = stats.select("*", rec.alias("_m"))
    if keyword_map is not None:
        km = keyword_map.select(
            F.col("keyword_id").alias("_kid"), F.col("keyword").alias("_kw"),
            F.col("adgroup_id").alias("_agid"), F.col("adgroup_name").alias("_agname"),
            F.col("campaign_id").alias("_cid"), F.col("campaign_name").alias("_cname"))
        df = df.join(km, df["keyword_id"] == km["_kid"], "left")
        kw = F.col("level") == "keyword"
        df = (df.withColumn("campaign_id", F.when(kw, F.col("_cid")).otherwise(F.col("campaign_id")))
                .withColumn("campaign_name", F.when(kw, F.coalesce(F.col("_cname"), F.lit("")))
                            .otherwise(F.col("campaign_name")))
                .withColumn("adgroup_id", F.when(kw, F.col("_agid")))
                .withColumn("adgroup_name", F.when(kw, F.col("_agname")))
                .withColumn("keyword", F.when(kw, F.coalesce(F.col("_kw"), F.lit("")))))
    else:
        for c in ("adgroup_id", "adgroup_name", "keyword"):
            if c not in df.columns:
                df = df.withColumn(c, F.lit(None).cast("string"))
    m = F.col("_m")
    return df.select(
        F.col("report_date").cast("date").alias("report_date"), "media", "account",
        F.col("customer_id").cast("string").alias("customer_id"), "level",
        "campaign_id", "campaign_name", "adgroup_id", "adgroup_name",
        F.col("keyword_id"), "keyword",
        landing_type(F.col("media"), F.col("campaign_name")).alias("lp_type"),
        *[_metric(m, k).alias(v) for k, v in SEARCH_COLMAP.items()],
        F.col(value_col).alias("raw_json"), F.current_timestamp().alias("ingested_at"))


# ---- display / message ads (SRC12) -------------------------------------------
def shape_kakao_report(rows: DataFrame) -> DataFrame:
    """Report rows (start, account, dimensions..., imp/click/cost text) ->
    typed rows: date normalised (F9), metrics default 0."""
    from martcraft.functions.dates import normalise_date
    z = lambda c: F.coalesce(safe_double(F.nullif(F.col(c), F.lit(""))), F.lit(0.0))
    keep = [c for c in rows.columns if c not in ("imp", "click", "cost", "date")]
    return rows.select(
        *keep,
        normalise_date("start").alias("date"),
        z("imp").cast("bigint").alias("impressions"),
        z("click").cast("bigint").alias("clicks"),
        z("cost").alias("cost"))


def route_creative_formats(fmt_rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Creative-format rows split into display (DA) and message tables by the
    PRJ6 class; message rows carry cost only."""
    from martcraft.functions.classify import creative_class
    r = shape_kakao_report(fmt_rows).withColumn(
        "creative_format", F.coalesce(F.col("creative_format"), F.lit(""))) \
        .withColumn("ad_type", creative_class(F.col("creative_format")))
    base = ["date", "ad_account_id", "creative_format", "ad_type"]
    msg = r.filter(F.col("ad_type") == "MESSAGE").select(*base, "cost")
    da = r.filter(F.col("ad_type") != "MESSAGE").select(*base, "impressions", "clicks", "cost")
    return da, msg


def kakao_campaign_rows(rows: DataFrame, names: DataFrame) -> DataFrame:
    """Campaign report rows + campaign names (missing -> '')."""
    r = shape_kakao_report(rows)
    return (r.join(names, ["ad_account_id", "campaign_id"], "left")
            .select("date", "ad_account_id", "campaign_id",
                    F.coalesce(F.col("campaign_name"), F.lit("")).alias("campaign_name"),
                    "impressions", "clicks", "cost"))


def kakao_adgroup_rows(rows: DataFrame, adgroups: DataFrame) -> DataFrame:
    """Ad-group report rows + (campaign id, group name) lookup (missing -> '')."""
    r = shape_kakao_report(rows)
    return (r.join(adgroups, ["ad_account_id", "adgroup_id"], "left")
            .select("date", "ad_account_id",
                    F.coalesce(F.col("campaign_id"), F.lit("")).alias("campaign_id"),
                    "adgroup_id", F.coalesce(F.col("adgroup_name"), F.lit("")).alias("adgroup_name"),
                    "impressions", "clicks", "cost"))
