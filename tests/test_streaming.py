"""Intraday micro-batch path and load windows."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martcraft.plans import live
from martcraft.streaming import intraday as I

D = dt.date
SCHEMA = T.StructType([T.StructField("value", T.StringType())])


def _shape(df):
    j = F.from_json("value", "report_date string, mall string, v long")
    return df.select(j.alias("r")).select(F.to_date("r.report_date").alias("report_date"), "r.mall", "r.v")


def _land(folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as fh:
        for r in rows:
            fh.write(json.dumps({"value": json.dumps(r)}) + "\n")


def test_load_span():
    a = D(2024, 3, 10)
    assert I.load_span(a, days=7) == (D(2024, 3, 4), a)
    assert I.load_span(a, days=3, end_yesterday=True) == (D(2024, 3, 7), D(2024, 3, 9))
    assert I.load_span(a, since=D(2024, 1, 1)) == (D(2024, 1, 1), a)
    assert I.load_span(a, months=2) == (D(2024, 1, 15), a)
    assert I.load_span(D(2024, 3, 31), months=1) == (D(2024, 3, 5), D(2024, 3, 31))   # Feb 29 + 5


def test_intraday_stream_is_incremental_and_idempotent(spark, tmp_path):
    land, out, ck = str(tmp_path / "land"), str(tmp_path / "out"), str(tmp_path / "ck")
    _land(land, "a.json", [{"report_date": "2024-01-02", "mall": "a", "v": 1},
                           {"report_date": "2024-01-01", "mall": "a", "v": 5}])
    I.intraday_refresh(spark, land, SCHEMA, "json", _shape, out, ck, as_of=D(2024, 1, 2))
    _land(land, "b.json", [{"report_date": "2024-01-02", "mall": "a", "v": 2}])
    I.intraday_refresh(spark, land, SCHEMA, "json", _shape, out, ck, as_of=D(2024, 1, 2))
    I.intraday_refresh(spark, land, SCHEMA, "json", _shape, out, ck, as_of=D(2024, 1, 2))  # nothing new
    got = sorted(tuple(r) for r in spark.read.parquet(out).select("report_date", "v").collect())
    # the second batch replaces the business day's partition (hourly refresh)
    assert got == [(D(2024, 1, 2), 2)]


def test_restatement_log_appends_per_batch(spark, tmp_path):
    land, out, ck = str(tmp_path / "land"), str(tmp_path / "out"), str(tmp_path / "ck")
    snap = lambda df: _shape(df).groupBy("report_date").agg(F.sum("v").alias("spend"))
    _land(land, "a.json", [{"report_date": "2024-01-01", "mall": "a", "v": 1}])
    I.restatement_log(spark, land, SCHEMA, "json", snap, out, ck)
    _land(land, "b.json", [{"report_date": "2024-01-01", "mall": "a", "v": 3}])
    I.restatement_log(spark, land, SCHEMA, "json", snap, out, ck)
    got = sorted(r.spend for r in spark.read.parquet(out).collect())
    assert got == [1, 3]


def test_lookback_filter(spark):
    df = spark.createDataFrame([(D(2024, 1, d),) for d in range(1, 11)], "report_date date")
    assert I.lookback_filter(df, D(2024, 1, 10), 3).count() == 3


def test_a_catch_up_of_many_exports_is_one_write(spark, tmp_path, monkeypatch):
    from martcraft.sinks import lake
    land, out, ck = str(tmp_path / "land"), str(tmp_path / "out"), str(tmp_path / "ck")
    for e in range(200):
        _land(land, f"e{e:03d}.json", [{"report_date": f"2024-01-{d:02d}", "mall": f"m{e}", "v": e}
                                       for d in range(1, 21) if (d + e) % 7 == 0])
        os.utime(os.path.join(land, f"e{e:03d}.json"), (10_000 + e // 3, 10_000 + e // 3))    # some share a time
    writes, real = [], lake.partition_overwrite
    monkeypatch.setattr(lake, "partition_overwrite", lambda *a: writes.append(1) or real(*a))
    day = F.to_date(F.get_json_object("value", "$.report_date"))
    I.intraday_refresh(spark, land, SCHEMA, "json", _shape, out, ck, landed_date=day)
    assert len(writes) == 1
    got = {r.report_date.day: r.v for r in spark.read.parquet(out).collect()}
    assert got == {d: max(e for e in range(200) if (d + e) % 7 == 0) for d in range(1, 21)}
    # a later export replaces only its dates
    _land(land, "later.json", [{"report_date": "2024-01-05", "mall": "x", "v": -1}, {"report_date": None, "mall": "y", "v": 0}])
    I.intraday_refresh(spark, land, SCHEMA, "json", _shape, out, ck, landed_date=day)
    after = {r.report_date.day: r.v for r in spark.read.parquet(out).collect()}
    assert after == {**got, 5: -1}


@pytest.fixture()
def small_partitions(spark):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(key, "32k")
    yield
    spark.conf.unset(key)


def test_catch_up_tasks_follow_the_amount_of_rows(spark, tmp_path, monkeypatch, small_partitions):
    n, first = 12_000, D(2000, 1, 1)
    (spark.range(0, n, 1, 6).select(
        F.col("id").alias("o_orderkey"), (F.col("id") % 977 + 0.5).alias("o_totalprice"),
        F.expr("date_add(date '2000-01-01', cast(id % 60 as int))").cast("timestamp").alias("o_orderdate"))
     .write.parquet(str(tmp_path / "orders.parquet")))
    monkeypatch.setattr(live, "scratch_path", lambda _spark, name: str(tmp_path / "scratch" / name))
    got = {(r.report_date, r.order_id, r.n) for r in live.q_catch_up(spark, str(tmp_path)).collect()}
    want = set()
    for k in range(n):
        month = (first + dt.timedelta(days=k % 60)).replace(day=1)
        last = max(e for e in range(live.EXPORTS) if (month.year * 12 + month.month + e) % 5 == 0)
        want.add((month, k, k % 977 + last))
    assert got == want
    exports = list(tmp_path.glob("scratch/*/landing/export=*"))
    assert len(exports) == 2 * live.EXPORTS // 5            # two months, each in a fifth of the exports
    # 6,000 rows an export, some 50 kB in the shuffle: no task sorts and writes an export whole
    assert min(len(list(x.glob("*.parquet"))) for x in exports) > 1


def test_the_latest_export_is_found_without_sorting_all_rows(spark):
    at = lambda h: dt.datetime(2024, 1, 9, h)
    rows = [(D(2024, 1, 1), "a", at(1), 1), (D(2024, 1, 1), "b", at(1), 2), (D(2024, 1, 1), "b", at(0), 3),
            (D(2024, 1, 2), "b", at(1), 4), (D(2024, 1, 2), "a", at(2), 5), (D(2024, 1, 2), "c", None, 6),
            (D(2024, 1, 3), "a", None, 7), (D(2024, 1, 3), "b", None, 8), (None, "z", at(3), 9)]
    landed = spark.createDataFrame(rows, "d date, _export string, _time timestamp, v int")
    out = I.latest_exports(landed, F.col("d"))
    assert sorted(r.v for r in out.collect()) == [2, 3, 5, 8]
    plan = out._jdf.queryExecution().sparkPlan().toString()
    nearest = [line for line in plan.splitlines() if "Aggregate(" in line][-1]      # the one that reads the landed rows
    assert "HashAggregate(" in nearest
