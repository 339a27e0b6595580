"""Plan-level behaviour: registry, quality, union alignment, invariants."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SMALL
from martcraft.operators.union import SchemaDriftError, align_union, schema_drift
from martcraft.plans import quality, registry


def test_registry_skips_dependants_and_fails_at_end():
    ran = []

    def ok(name):
        return lambda as_of: ran.append(name)

    def boom(as_of):
        raise RuntimeError("bad input")

    jobs = [registry.Job("kpi", ok("kpi"), ("sales", "media")), registry.Job("sales", boom),
            registry.Job("media", ok("media")), registry.Job("cost", ok("cost"))]
    with pytest.raises(registry.RefreshFailed) as e:
        registry.run_all(jobs, dt.date(2024, 1, 1))
    rep = e.value.report
    assert ran == ["media", "cost"]
    assert set(rep.failed) == {"sales"} and set(rep.skipped) == {"kpi"}


def test_registry_cycle_detected():
    with pytest.raises(ValueError):
        registry.order_jobs([registry.Job("a", lambda d: 0, ("b",)), registry.Job("b", lambda d: 0, ("a",))])


def test_freshness_raises_on_stale(spark):
    df = E.queries()["dq1_freshness"](spark, SMALL)
    with pytest.raises(quality.StaleDataError):
        quality.assert_fresh(df)


def test_align_union_widens_and_rejects(spark):
    a = spark.createDataFrame([(1, "x")], "n long, s string")
    b = spark.createDataFrame([(2.5,)], "n double")
    u = align_union(a, b)
    assert dict(u.dtypes)["n"] == "double" and u.count() == 2
    c = spark.createDataFrame([("t",)], "n string")
    with pytest.raises(SchemaDriftError):
        align_union(a, c)
    assert "only in left: s" in schema_drift(a, b)


def test_repurchase_invariant(spark):
    df = E.queries()["p4_repurchase_daily"](spark, SMALL)
    bad = df.filter(F.col("first_purchase") + F.col("repurchase_orders") != F.col("member_orders"))
    assert bad.count() == 0


def test_media_sum_equals_unified_sum(spark):
    u = E.queries()["p8_ad_unified_daily"](spark, SMALL).agg(F.sum("cost")).first()[0]
    m = E.queries()["p11_media_daily"](spark, SMALL).agg(F.sum("spend")).first()[0]
    assert abs(u - m) < 1e-6


def test_api_and_manual_days_disjoint(spark):
    df = E.queries()["p8_ad_unified_daily"](spark, SMALL)
    manual = F.col("campaign_id").startswith("mc")
    api = df.filter(~manual).select("media", "mall", "report_date").distinct()
    assert df.filter(manual).join(api, ["media", "mall", "report_date"], "left_semi").count() == 0
    assert df.filter(manual).count() > 0


def test_refresh_writes_marts_in_dependency_order(spark, tmp_path):
    from martcraft.plans import refresh
    out = str(tmp_path / "lake")
    rep = registry.run_all(refresh.build_jobs(spark, SMALL, out), dt.date(2001, 8, 1))
    assert rep.ok[0] == "land" and rep.ok.index("mart_brand_kpi") > rep.ok.index("mart_media_daily")
    kpi = spark.read.parquet(out + "/mart_brand_kpi")
    expected = E.queries()["p12_brand_kpi"](spark, SMALL)
    assert kpi.count() == expected.count()
    assert sorted(kpi.columns) == sorted(expected.columns)


def test_current_and_brand_views(spark):
    from martcraft.sinks import lake
    o = E.queries()["p1_orders_status"](spark, SMALL)
    assert lake.register_current_views(spark, {"orders": (o, o)}, dt.date(2001, 8, 1)) == ["orders_current"]
    assert spark.table("orders_current").count() == o.count()
    views = lake.register_brand_views(spark, {"orders": o}, ["brand_a", "brand_b"])
    assert views == ["orders_brand_a", "orders_brand_b"]
    assert spark.table("orders_brand_a").count() + spark.table("orders_brand_b").count() == o.count()


def test_a_run_resumes_after_a_failure(spark, tmp_path):
    day, ran = dt.date(2024, 1, 1), []
    log = registry.RunLog(spark, str(tmp_path / "_runs"))
    src, mid, top = (str(tmp_path / n) for n in ("src", "mid", "top"))
    spark.range(3).write.parquet(src)

    def jobs(broken=False):
        def copy(name, a, b):
            def run(_):
                ran.append(name)
                if broken and name == "top":
                    raise OSError("lost")
                spark.read.parquet(a).write.mode("overwrite").parquet(b)
            return run
        return [registry.Job("mid", copy("mid", src, mid), (), (src,), (mid,)),
                registry.Job("top", copy("top", mid, top), ("mid",), (mid,), (top,))]

    assert set(registry.run_all(jobs(True), day, raise_on_failure=False, log=log).failed) == {"top"}
    again = registry.run_all(jobs(), day, log=log)
    assert again.reused == ["mid"] and again.ok == ["top"]
    assert registry.run_all(jobs(), day, log=log).reused == ["mid", "top"]
    spark.range(5).write.mode("overwrite").parquet(src)          # a changed input runs again, and what rests on it
    assert registry.run_all(jobs(), day, log=log).ok == ["mid", "top"]
    assert spark.read.parquet(top).count() == 5
    assert registry.run_all(jobs(), dt.date(2024, 1, 2), log=log).ok == ["mid", "top"]
