"""Views over the business date (P2, SNK12) and freshness from metadata (DQ1)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from martcraft.plans import quality
from martcraft.sinks import lake, views

D = dt.date


def test_a_current_view_follows_the_business_date(spark):
    spark.createDataFrame([(D(2024, 1, d), d, "x") for d in range(1, 6)], "report_date date, v int, only string") \
        .createOrReplaceTempView("vt_final")
    spark.createDataFrame([(d, D(2024, 1, d)) for d in range(1, 6)], "v long, report_date date") \
        .withColumn("v", F.col("v") * 10).createOrReplaceTempView("vt_d0")
    registry = views.register_live_views(spark, {"vt": ("vt_final", "vt_d0")}, D(2024, 1, 3))
    read = lambda: sorted((r.report_date.day, r.v, r.only) for r in spark.table("vt_current").collect())
    assert read() == [(1, 1, "x"), (2, 2, "x"), (3, 30, None)]
    assert spark.table("vt_current").schema["v"].dataType.simpleString() == "bigint"
    views.set_business_date(spark, D(2024, 1, 5))            # the next day: the view is not made again
    assert [r[0:2] for r in read()] == [(1, 1), (2, 2), (3, 3), (4, 4), (5, 50)]
    views.set_business_date(spark)                           # today's date, asked at each read
    assert len(read()) == 5 and registry.refresh() == ["vt_current"]


def test_a_view_prunes_the_partitions_of_both_halves(spark, tmp_path):
    p = str(tmp_path / "t")
    lake.partition_overwrite(spark.createDataFrame([(D(2024, 1, d), d) for d in range(1, 9)], "report_date date, v int"), p)
    spark.read.parquet(p).createOrReplaceTempView("vp_t")
    views.register_live_views(spark, {"vp": ("vp_t", "vp_t")}, D(2024, 1, 2))
    df = spark.table("vp_current")
    assert df.count() == 2
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(report_date") == 2


def test_views_are_made_in_dependency_order(spark):
    spark.createDataFrame([(1,), (2,)], "x int").createOrReplaceTempView("vd_base")
    reg = views.ViewRegistry(spark)
    reg.register("vd_top", "SELECT sum(x) AS s FROM vd_mid", ["vd_mid"])
    reg.register("vd_mid", lambda s: s.table("vd_base").filter("x > 1"), ["vd_base"])
    reg.register("vd_other", "SELECT 1 AS one")
    assert reg.refresh("vd_top") == ["vd_mid", "vd_top"]
    assert spark.table("vd_top").first().s == 2
    assert set(reg.refresh()) == {"vd_mid", "vd_top", "vd_other"}
    reg.register("vd_mid", "SELECT * FROM vd_top", ["vd_top"])
    with pytest.raises(ValueError):
        reg.refresh()


def test_the_newest_date_is_read_from_metadata(spark, tmp_path):
    p = str(tmp_path / "files")
    rows = spark.createDataFrame([(D(2024, 1, d), d) for d in range(1, 29)], "day date, v int").repartition(4)
    rows.write.parquet(p)
    df = quality.newest_in_footers(spark, p, "day")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [MAX(day)]" in plan
    assert quality.newest_date(spark, p, "day") == D(2024, 1, 28)
    # the caller's session still reads as before
    assert "BatchScan" not in spark.read.parquet(p)._jdf.queryExecution().executedPlan().toString()


def test_freshness_of_missing_empty_and_hollow_tables(spark, tmp_path):
    p = str(tmp_path / "t")
    lake.partition_overwrite(spark.createDataFrame([(D(2024, 1, d), d) for d in (1, 5)], "report_date date, v int"), p)
    assert quality.newest_date(spark, p, "report_date") == D(2024, 1, 5)
    lake.drop_files(spark, f"{p}/report_date=2024-01-05")
    checks = [quality.TableCheck("a", "t", p, "report_date", 3), quality.TableCheck("b", "none", str(tmp_path / "none"), "d", 3)]
    got = {r.label: r for r in quality.table_freshness(spark, checks, D(2024, 1, 3)).collect()}
    assert got["a"].ok and got["a"].detail == "latest 2024-01-01 (lag 2 / allowed 3)"
    assert not got["b"].ok and got["b"].detail == "no data"
    with pytest.raises(quality.StaleDataError):
        quality.assert_fresh(quality.table_freshness(spark, checks, D(2024, 1, 3)))
