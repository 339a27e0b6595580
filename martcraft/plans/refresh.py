"""End-to-end mart refresh over the benchmark tables (P16 + SNK10).

``python -m martcraft.plans.refresh <sf_dir> <out_dir> [as_of]`` lands the
derived tables, then rebuilds the marts in dependency order and writes each
one as a partitioned, clustered parquet table (CREATE OR REPLACE semantics).
A failing mart does not stop the others; marts that depend on it are skipped
and the run fails at the end.  Every job takes the same ``as_of``.  Only the landing job reads the
benchmark tables: every mart reads landed tables and marts.  A run log in ``out_dir`` lets a repeated
run go on after a failure: finished jobs whose files have not changed are not run again.
"""

from __future__ import annotations

import datetime as dt
import os
import sys

from pyspark.sql import SparkSession

from martcraft.operators.union import current_view
from martcraft.plans import ads, commerce
from martcraft.plans import catalog as C
from martcraft.plans.registry import Job, RunLog, run_all
from martcraft.sinks import lake
from martcraft.sources import driver as D
from martcraft.sources.ads import with_web_purchase


def build_jobs(spark: SparkSession, sf_dir: str, out: str) -> list[Job]:
    def path(name):
        return os.path.join(out, name)

    def read(name):
        return spark.read.parquet(path(name))

    inputs = {"orders": "report_date", "order_items": "report_date", "cost_items": "report_date", "meta_ads": "report_date",
              "search_ads": "report_date", "google_stats": "segments_date", "google_names": None, "kakao": "date",
              "ad_manual": "report_date", "sessions": "date", "product_names": None, "price_sheet": None}

    def land(as_of):
        """Every input once, partitioned by its date where it has one."""
        ev = D.events(spark, sf_dir)
        o = D.orders(spark, sf_dir)
        items = D.order_items(spark, sf_dir, o)
        frames = {
            "orders": o, "order_items": items, "cost_items": D.cost_items(spark, sf_dir, items),
            "meta_ads": with_web_purchase(D.meta_ads(spark, sf_dir, ev)), "search_ads": D.naver_ads(spark, sf_dir, ev),
            "google_stats": D.google_stats(spark, sf_dir, ev), "google_names": D.google_campaign_names(spark, sf_dir, ev),
            "kakao": D.kakao_campaign(spark, sf_dir, ev), "ad_manual": D.ad_manual(spark, sf_dir, ev),
            "sessions": D.ga4_sessions(spark, sf_dir, ev), "product_names": D.product_names(spark, sf_dir),
            "price_sheet": D.price_sheet(spark, sf_dir)}
        for name, date_col in inputs.items():
            if date_col:
                lake.partition_overwrite(frames[name], path(name), date_col)
            else:
                lake.replace_table(frames[name], path(name))

    def current(name, as_of):
        df = read(name)
        return current_view(df, df, as_of)

    def sales(as_of):
        lake.write_mart(commerce.sales_daily(current("orders", as_of), as_of), path("mart_sales_daily"),
                        cluster_by=("mall",))

    def products(as_of):
        out_df = commerce.product_sales(current("order_items", as_of), as_of, names=read("product_names"))
        lake.write_mart(out_df, path("mart_product_sales"), cluster_by=("mall", "product_no"))

    def unified(as_of):
        df = ads.ad_unified(read("meta_ads"), read("search_ads"), read("google_stats"), read("google_names"), read("kakao"),
                            read("ad_manual"), as_of, meta_accounts=D.META_ACCOUNTS, google_customers=D.GOOGLE_CUSTOMERS,
                            kakao_accounts=D.KAKAO_ACCOUNTS)
        lake.write_mart(df, path("ad_unified_daily"), cluster_by=("mall", "media"))

    def media(as_of):
        lake.write_mart(ads.media_daily(read("ad_unified_daily")), path("mart_media_daily"),
                        cluster_by=("mall", "media"))

    def kpi(as_of):
        df = ads.brand_kpi(read("mart_media_daily"), read("mart_sales_daily"), read("sessions"), as_of)
        lake.write_mart(df, path("mart_brand_kpi"), cluster_by=("mall",))

    def cost(as_of):
        df = C.cost_of(current("cost_items", as_of), read("price_sheet"), as_of)
        lake.write_mart(df, path("mart_cost_daily"), cluster_by=("mall",))

    def job(name, run, *deps, reads=()):
        """A mart that reads the named tables and writes the one it is named after."""
        return Job(name, run, deps, tuple(path(r) for r in reads), (path(name),))

    ad_inputs = ("meta_ads", "search_ads", "google_stats", "google_names", "kakao", "ad_manual")
    return [
        Job("land", land, (), (f"{sf_dir}/",), tuple(path(n) for n in inputs)),
        job("mart_sales_daily", sales, "land", reads=("orders",)),
        job("mart_product_sales", products, "land", reads=("order_items", "product_names")),
        job("ad_unified_daily", unified, "land", reads=ad_inputs),
        job("mart_media_daily", media, "ad_unified_daily", reads=("ad_unified_daily",)),
        job("mart_brand_kpi", kpi, "mart_media_daily", "mart_sales_daily",
            reads=("mart_media_daily", "mart_sales_daily", "sessions")),
        job("mart_cost_daily", cost, "land", reads=("cost_items", "price_sheet")),
    ]


def main(argv: list[str]) -> int:
    from martcraft.session import build_session
    sf_dir, out = argv[0], argv[1]
    as_of = dt.date.fromisoformat(argv[2]) if len(argv) > 2 else D.AS_OF
    spark = build_session("martcraft-refresh")
    log = RunLog(spark, os.path.join(out, "_runs"))
    report = run_all(build_jobs(spark, sf_dir, out), as_of, raise_on_failure=False, log=log)
    print(f"ok={report.ok} reused={report.reused} failed={sorted(report.failed)} skipped={sorted(report.skipped)}")
    return 1 if report.failed or report.skipped else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
