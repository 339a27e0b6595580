"""Cases that the benchmark tables do not reach."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import martcraft.session as S
from conftest import SMALL
from martcraft.functions.classify import ship_rate, size_ml
from martcraft.plans import ads, crm, design, quality
from martcraft.plans.catalog import QUERIES
from martcraft.sinks import lake
from martcraft.sources import ads as SA
from martcraft.sources import statistics as ST
from martcraft.streaming import intraday as I

D = dt.date


def test_sizes_before_hangul_and_after_other_white_space(spark):
    cases = {"1.5L들이": 1500, "500 ml": 500, "2 리터": 2000, "3lb": None, "0.5 l": 500, "x": None}
    got = spark.createDataFrame([(k,) for k in cases], "t string").select("t", size_ml("t").alias("n")).collect()
    assert {r.t: r.n for r in got} == cases


def test_parcel_rate_splits_into_boxes(spark):
    def want(n):
        if n <= 0:
            return 0
        total = n // 24 * 3562
        n %= 24
        total += n // 12 * 3237
        return total + -(-(n % 12) // 6) * 2563

    fixed = {6: 2563, 12: 3237, 15: 3233, 20: 2905, 24: 3562}
    got = spark.range(-2, 120).select("id", ship_rate("id", F.lit(False), F.lit("x")).alias("r")).collect()
    assert {r.id: r.r for r in got} == {n: fixed.get(n, want(n)) for n in range(-2, 120)}


def test_statistics_entries_that_are_no_objects_are_no_records(spark):
    spec = ST.SPECS["pages_view"]
    body = json.dumps({spec.keys[0]: [1, "x", {"a": 1}, None]})
    df = spark.createDataFrame([(1, "m", D(2024, 1, 1), D(2024, 1, 1), body)],
                               "shop_no long, mall string, day date, window_end date, value string")
    assert ST.shape_stat(df, spec).count() == 1


def test_reconciliation_matches_real_ids_within_a_brand(spark):
    tx = spark.createDataFrame([("a", D(2024, 1, 1), "20260601-0000123", 5.0, 1), ("b", D(2024, 1, 1), "20260601-0000123", 7.0, 2)],
                               "brand string, date date, transaction_id string, purchase_revenue double, ecommerce_purchases long")
    orders = spark.createDataFrame([(D(2024, 1, 1), "a", "20260601-0000123", 5.5)],
                                   "report_date date, mall string, order_id string, payment_amount double")
    got = {(r.ga_brand, r.status, r.revenue_diff, r.duplicate_firing)
           for r in design.transaction_reconciliation(tx, orders).collect()}
    assert got == {("a", "matched", -0.5, False), ("b", "ga_only", None, True)}


def test_snapshots_of_one_day_are_ordered_by_time(spark):
    rows = [("x", D(2024, 1, 1), D(2024, 1, 2), dt.datetime(2024, 1, 2, h), s, 0.0) for h, s in ((18, 30.0), (6, 10.0), (12, 15.0))]
    df = spark.createDataFrame(rows, "account_id string, report_date date, snapshot_date date, snapshot_at timestamp, "
                                     "spend double, purchases double")
    got = [r.spend_change for r in design.restatement_convergence(df).orderBy("snapshot_seq").collect()]
    assert got == [None, 5.0, 15.0]


def test_audit_window_keeps_eight_days(spark):
    days = [(D(2024, 1, d), "a", 1.0, 1, 1, "[]", "[]") for d in range(1, 21)]
    df = spark.createDataFrame(days, "report_date date, account_id string, spend double, impressions long, clicks long, "
                                     "actions string, action_values string")
    got = ads.ads_audit(df, dt.datetime(2024, 1, 20, 6), days=8)
    assert got.agg(F.min("report_date")).first()[0] == D(2024, 1, 13) and got.count() == 8


def test_a_missing_table_is_reported_and_the_others_are_checked(spark, tmp_path):
    ok = spark.createDataFrame([(D(2024, 1, 1),)], "d date")
    got = quality.freshness([
        quality.FreshnessCheck("gone", "gone", lambda: spark.read.parquet(str(tmp_path / "none")), "d", 2),
        quality.FreshnessCheck("here", "here", ok, "d", 2)], D(2024, 1, 2)).collect()
    assert [(r.label, r.ok, r.detail) for r in got][0] == ("gone", False, "no data") and got[1].ok


def test_landline_stands_in_for_a_missing_mobile(spark):
    schema = "shop_no long, {} string, name string, cellphone string, phone string, email string, sms string, news_mail string"
    members = spark.createDataFrame([(1, "m1", "n", "", "02-1", "", "T", "T"), (1, "m2", "n", "010-2", "02-9", "", "T", "T"),
                                     (1, "m3", "n", "", None, "", "T", "T")], schema.format("member_id"))
    guests = spark.createDataFrame([], schema.format("order_id"))
    seg = spark.createDataFrame([("member", "a", 1, m, D(2024, 1, 1), 1, 1, 1.0, 0, "p") for m in ("m1", "m2", "m3")],
                                "customer_type string, mall string, shop_no long, ref string, last_order_date date, "
                                "days_since int, order_count long, spend double, used_coupon int, products string")
    block = spark.createDataFrame([("021",)], "phone_digits string")
    got = {r.ref: (r.status, r.cellphone) for r in crm.with_contacts(seg, members, guests, block, crm.AudienceSpec(product_kw="p")).collect()}
    assert got["m1"] == ("blocked", "02-1") and got["m2"][1] == "010-2" and got["m3"][0] == "no_contact"


def _land(folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as fh:
        fh.writelines(json.dumps({"value": json.dumps(r)}) + "\n" for r in rows)


def test_exports_that_land_together_do_not_add_up(spark, tmp_path):
    schema = T.StructType([T.StructField("value", T.StringType())])
    shape = lambda df: df.select(F.from_json("value", "report_date date, v long").alias("r")).select("r.*")
    land, out = str(tmp_path / "land"), str(tmp_path / "out")
    _land(land, "a.json", [{"report_date": "2024-01-01", "v": 1}, {"report_date": "2024-01-02", "v": 5}])
    _land(land, "b.json", [{"report_date": "2024-01-01", "v": 1}, {"report_date": "2024-01-01", "v": 2}])
    for i, n in enumerate("ab"):
        os.utime(os.path.join(land, f"{n}.json"), (1_700_000_000 + i, 1_700_000_000 + i))
    I.intraday_refresh(spark, land, schema, "json", shape, out, str(tmp_path / "ck"))
    assert sorted(tuple(r) for r in spark.read.parquet(out).select("report_date", "v").collect()) == [
        (D(2024, 1, 1), 1), (D(2024, 1, 1), 2), (D(2024, 1, 2), 5)]


def test_part_files_of_a_folder_are_one_export(spark, tmp_path):
    schema = T.StructType([T.StructField("value", T.StringType())])
    shape = lambda df: df.select(F.from_json("value", "report_date date, v long").alias("r")).select("r.*")
    land, out = str(tmp_path / "land"), str(tmp_path / "out")
    for i in range(3):
        _land(f"{land}/export", f"part-{i}.json", [{"report_date": "2024-01-01", "v": i}])
    I.intraday_refresh(spark, f"{land}/*", schema, "json", shape, out, str(tmp_path / "ck"))
    assert sorted(r.v for r in spark.read.parquet(out).collect()) == [0, 1, 2]


def test_a_failed_swap_puts_the_old_days_back(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    rows = lambda v: spark.createDataFrame([(D(2024, 1, d), v) for d in (1, 2, 3)], "report_date date, v long")
    lake.partition_overwrite(rows(1), path)
    real, calls = lake._rename, []

    def flaky(s, src, dst):
        calls.append(src)
        if len(calls) == 4:
            raise OSError("no space")
        real(s, src, dst)

    monkeypatch.setattr(lake, "_rename", flaky)
    with pytest.raises(OSError):
        lake.atomic_range_replace(rows(2).filter("report_date < '2024-01-03'"), path, D(2024, 1, 1), D(2024, 1, 3))
    monkeypatch.setattr(lake, "_rename", real)
    assert sorted((r.report_date.day, r.v) for r in spark.read.parquet(path).collect()) == [(1, 1), (2, 1), (3, 1)]
    lake.atomic_range_replace(rows(2).filter("report_date < '2024-01-03'"), path, D(2024, 1, 1), D(2024, 1, 3))
    assert sorted((r.report_date.day, r.v) for r in spark.read.parquet(path).collect()) == [(1, 2), (2, 2)]


def test_dates_are_written_in_few_files(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(0, 4000, numPartitions=8).select(F.date_add(F.lit(D(2024, 1, 1)), (F.col("id") % 20).cast("int")).alias("report_date"), "id")
    lake.partition_overwrite(df, path)
    files = [f for d in os.listdir(path) if "=" in d for f in os.listdir(f"{path}/{d}") if f.endswith(".parquet")]
    assert len(files) <= 40


def test_no_block_stays_persisted_and_new_files_are_seen(spark, tmp_path):
    QUERIES["p8_ad_unified_daily"](spark, SMALL).count()
    assert spark.sparkContext._jsc.sc().getPersistentRDDs().isEmpty()
    path = str(tmp_path / "grow")
    spark.range(10).write.parquet(path)
    assert S.materialize(spark.read.parquet(path)).count() == 10
    spark.range(5).write.mode("append").parquet(path)
    assert S.materialize(spark.read.parquet(path)).count() == 15


def test_a_cluster_without_a_shared_folder_is_an_error(spark):
    class Context:
        master, applicationId = "spark://host:7077", "app"

    class Session:
        conf = type("C", (), {"get": staticmethod(lambda k, d=None: d)})
        sparkContext = Context

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        S.checkpoint_dir(Session)


def test_meta_records_are_typed(spark):
    recs = [{"account_id": "1", "spend": "2.5", "impressions": 7, "clicks": "x", "date_start": "2024-01-02",
             "actions": [{"action_type": "purchase", "value": "3"}], "objective": "SALES"},
            {"date_start": "bad", "action_values": [{"action_type": "omni_purchase", "value": "4.5"}]}]
    df = spark.createDataFrame([(json.dumps(r), "9") for r in recs] + [("[1]", "9")], "value string, account string")
    a, b = sorted(SA.shape_meta(df).collect(), key=lambda r: r.account_id)
    assert (a.account_id, a.spend, a.impressions, a.clicks, a.report_date, a.objective) == ("1", 2.5, 7.0, None, D(2024, 1, 2), "SALES")
    assert json.loads(a.actions) == recs[0]["actions"] and a.web_purchase_count == 3.0 and a.web_purchase_value is None
    assert (b.account_id, b.report_date, b.web_purchase_value) == ("9", None, 4.5)
