"""Write modes: idempotency, stale-date behaviour, merge semantics."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from martcraft.sinks import lake

D = dt.date


def _df(spark, rows, cols="report_date date, mall string, v long"):
    return spark.createDataFrame(rows, cols)


def _read(spark, path):
    return sorted(tuple(r) for r in spark.read.parquet(path).select("report_date", "mall", "v").collect())


def test_partition_overwrite_keeps_absent_dates(spark, tmp_path):
    p = str(tmp_path / "t")
    lake.partition_overwrite(_df(spark, [(D(2024, 1, 1), "a", 1), (D(2024, 1, 2), "a", 2)]), p)
    batch = _df(spark, [(D(2024, 1, 2), "a", 20), (None, "a", 99)])
    lake.partition_overwrite(batch, p)
    lake.partition_overwrite(batch, p)               # idempotent re-run
    assert _read(spark, p) == [(D(2024, 1, 1), "a", 1), (D(2024, 1, 2), "a", 20)]


def test_range_replace_purges_emptied_dates(spark, tmp_path):
    p = str(tmp_path / "t")
    cols = "date date, mall string, v long"
    lake.range_replace(spark.createDataFrame(
        [(D(2024, 1, 1), "a", 1), (D(2024, 1, 2), "a", 2), (D(2024, 1, 5), "a", 5)], cols),
        p, D(2024, 1, 1), D(2024, 1, 5))
    purged = lake.range_replace(spark.createDataFrame([(D(2024, 1, 2), "a", 22)], cols),
                                p, D(2024, 1, 1), D(2024, 1, 3))
    assert purged == ["2024-01-01"]
    got = sorted(tuple(r) for r in spark.read.parquet(p).select("date", "v").collect())
    assert got == [(D(2024, 1, 2), 22), (D(2024, 1, 5), 5)]


def test_range_replace_with_retention(spark, tmp_path):
    p = str(tmp_path / "t")
    cols = "date date, v long"
    lake.range_replace(spark.createDataFrame([(D(2023, 1, 1), 1), (D(2024, 1, 1), 2)], cols),
                       p, D(2023, 1, 1), D(2024, 1, 1))
    lake.range_replace_with_retention(spark.createDataFrame([(D(2024, 1, 2), 3)], cols), p,
                                      D(2024, 1, 2), D(2024, 1, 2), as_of=D(2024, 1, 3), keep_days=365)
    got = sorted(r[0] for r in spark.read.parquet(p).select("date").collect())
    assert got == [D(2024, 1, 1), D(2024, 1, 2)]


def test_replace_keep_if_empty_and_allow_empty(spark, tmp_path):
    p = str(tmp_path / "t")
    lake.replace_table(_df(spark, [(D(2024, 1, 1), "a", 1)]), p)
    assert lake.replace_table_keep_if_empty(_df(spark, []), p) is False
    assert len(_read(spark, p)) == 1
    lake.replace_table(_df(spark, []), p)
    assert _read(spark, p) == []


def test_atomic_range_replace(spark, tmp_path):
    p = str(tmp_path / "t")
    lake.partition_overwrite(_df(spark, [(D(2024, 1, 1), "a", 1), (D(2024, 1, 2), "a", 2),
                                         (D(2024, 1, 9), "a", 9)]), p)
    lake.atomic_range_replace(_df(spark, [(D(2024, 1, 2), "b", 5)]), p, D(2024, 1, 1), D(2024, 1, 3))
    assert _read(spark, p) == [(D(2024, 1, 2), "b", 5), (D(2024, 1, 9), "a", 9)]


MCOLS = ("report_date date, mall string, media string, campaign_id string, campaign_name string, "
         "landing string, impressions long, clicks long, cost double, conversions double, "
         "conversion_value double, source string, loaded_at timestamp")


def _m(spark, rows):
    return spark.createDataFrame(rows, MCOLS)


def test_merge_upsert(spark, tmp_path):
    p = str(tmp_path / "m")
    t0 = dt.datetime(2024, 1, 1)
    lake.merge_upsert(_m(spark, [
        (D(2024, 1, 1), "a", "meta", "c1", None, None, 1, 1, 1.0, None, None, "f1", t0),
        (D(2024, 1, 1), None, "meta", "c2", "x", None, 2, 2, 2.0, None, None, "f1", t0),
        (D(2024, 1, 2), "a", "meta", "c3", "y", None, 3, 3, 3.0, None, None, "f1", t0),
    ]), p)
    lake.merge_upsert(_m(spark, [
        (D(2024, 1, 1), "a", "meta", "c9", "", None, 10, 10, 10.0, 1.0, 5.0, "f2", t0),   # matches NULL name
        (D(2024, 1, 1), None, "meta", "c2", "x", None, 20, 20, 20.0, None, None, "f2", t0),  # NULL never matches
        (D(2024, 1, 1), "a", "gfa", "c4", "z", None, 4, 4, 4.0, None, None, "f2", t0),
    ]), p)
    rows = sorted((r.report_date, r.mall or "", r.media, r.campaign_id, r.campaign_name, r.cost)
                  for r in spark.read.parquet(p).collect())
    assert rows == [
        (D(2024, 1, 1), "", "meta", "c2", "x", 2.0),
        (D(2024, 1, 1), "", "meta", "c2", "x", 20.0),
        (D(2024, 1, 1), "a", "gfa", "c4", "z", 4.0),
        (D(2024, 1, 1), "a", "meta", "c9", None, 10.0),
        (D(2024, 1, 2), "a", "meta", "c3", "y", 3.0),
    ]


def test_merge_duplicate_source_raises(spark, tmp_path):
    t0 = dt.datetime(2024, 1, 1)
    row = (D(2024, 1, 1), "a", "meta", "c1", "n", None, 1, 1, 1.0, None, None, "f", t0)
    with pytest.raises(lake.DuplicateKeyError):
        lake.merge_upsert(_m(spark, [row, row]), str(tmp_path / "m"))


def test_append_snapshot_and_snapshot_partition(spark, tmp_path):
    p = str(tmp_path / "a")
    df = spark.createDataFrame([(D(2024, 1, 1), 1.0)], "report_date date, spend double")
    lake.append_snapshot(df, p, at=dt.datetime(2024, 1, 1, 1))
    lake.append_snapshot(df, p, at=dt.datetime(2024, 1, 1, 2))
    assert spark.read.parquet(p).count() == 2
    s = str(tmp_path / "s")
    snap = spark.createDataFrame([(D(2024, 1, 1), "p1")], "snapshot_date date, product_no string")
    lake.snapshot_partition(snap, s)
    lake.snapshot_partition(snap, s)
    assert spark.read.parquet(s).count() == 1


def test_write_mart_and_conform(spark, tmp_path):
    p = str(tmp_path / "mart")
    df = _df(spark, [(D(2024, 1, 1), "b", 1), (D(2024, 1, 1), "a", 2), (D(2024, 1, 2), "a", 3)])
    lake.write_mart(df, p, cluster_by=("mall",), files=2)
    lake.write_mart(df, p, cluster_by=("mall",), files=2)
    assert len(_read(spark, p)) == 3
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("report_date", T.DateType()), T.StructField("mall", T.StringType()),
                           T.StructField("extra", T.LongType())])
    c = lake.conform(df, schema)
    assert c.columns == ["report_date", "mall", "extra", "v"]


def test_export_csv_has_bom_header(spark, tmp_path):
    p = str(tmp_path / "csv")
    df = spark.createDataFrame([("member", "a")], "customer_type string, mall string")
    lake.export_csv(df, p, ["customer_type", "mall"])
    import glob
    text = open(glob.glob(p + "/part-*.csv")[0], encoding="utf-8").read()
    assert text.startswith("﻿customer_type,mall")


def test_view_registry(spark):
    reg = lake.ViewRegistry(spark)
    reg.register("v_one", lambda s: s.range(3).withColumn("x", F.col("id") * 2))
    assert reg.refresh() == ["v_one"]
    assert spark.sql("select sum(x) from v_one").first()[0] == 6


def _files(path):
    import os
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f))
            for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def _ad(day, name, n, **more):
    row = {"report_date": day, "mall": "a", "media": "m", "campaign_id": "1", "campaign_name": name, "landing": None,
           "impressions": n, "clicks": 0, "cost": 0.0, "conversions": None, "conversion_value": None, "source": "s",
           "loaded_at": dt.datetime(2024, 1, 1)}
    return {**row, **more}


def test_merge_keeps_columns_the_source_lacks(spark, tmp_path):
    p = str(tmp_path / "with space")
    first = [{**_ad(D(2024, 1, 1), "x", 1), "note": "one"}, {**_ad(D(2024, 1, 1), "y", 2), "note": "two"}]
    lake.merge_upsert(spark.createDataFrame([tuple(r.values()) for r in first], MCOLS + ", note string"), p)
    new = [_ad(D(2024, 1, 1), "x", 10), _ad(D(2024, 1, 1), "z", 3)]
    replaced = lake.merge_upsert(spark.createDataFrame([tuple(r.values()) for r in new], MCOLS), p)
    assert replaced
    got = {r.campaign_name: (r.impressions, r.note) for r in lake.read_table(spark, p).collect()}
    assert got == {"x": (10, "one"), "y": (2, "two"), "z": (3, None)}
    # a column that only the source has joins the table
    extra = spark.createDataFrame([(*_ad(D(2024, 1, 1), "z", 4).values(), 7)], MCOLS + ", rank long")
    lake.merge_upsert(extra, p)
    got = {r.campaign_name: (r.impressions, r.note, r["rank"]) for r in lake.read_table(spark, p).collect()}
    assert got == {"x": (10, "one", None), "y": (2, "two", None), "z": (4, None, 7)}


def test_merge_rewrites_only_files_with_a_match(spark, tmp_path):
    p = str(tmp_path / "t")
    days = [D(2020, 1, 1) + dt.timedelta(days=i) for i in range(1000)]
    table = spark.createDataFrame([tuple(_ad(d, "x", i).values()) for i, d in enumerate(days)], MCOLS)
    lake.merge_upsert(table, p)
    # a second file on the touched date, without a match
    lake.merge_upsert(spark.createDataFrame([tuple(_ad(days[500], "other", 7).values())], MCOLS), p)
    before = _files(p)
    assert len(before) == 1001
    touched = spark.createDataFrame([tuple(_ad(days[500], "x", -1).values())], MCOLS)
    replaced = lake.merge_upsert(touched, p)
    after = _files(p)
    assert len(replaced) == 1 and len(after) == 1001
    assert sum(before.get(f) == t for f, t in after.items()) == 1000
    rows = lake.read_table(spark, p)
    assert rows.count() == 1001 and rows.filter("impressions = -1").count() == 1
    assert not [f for f in tmp_path.joinpath("t").iterdir() if f.name.startswith(("_stage", "_old"))]


def test_a_failed_merge_leaves_the_table(spark, tmp_path, monkeypatch):
    p = str(tmp_path / "t")
    lake.merge_upsert(spark.createDataFrame([tuple(_ad(D(2024, 1, k), "x", k).values()) for k in (1, 2, 3)], MCOLS), p)
    real, calls = lake._rename, []

    def failing(spark_, src, dst):
        calls.append(src)
        if len(calls) == 5:
            raise OSError("lost")
        real(spark_, src, dst)

    monkeypatch.setattr(lake, "_rename", failing)
    new = spark.createDataFrame([tuple(_ad(D(2024, 1, k), "x", 9).values()) for k in (1, 2, 3)], MCOLS)
    with pytest.raises(OSError):
        lake.merge_upsert(new, p)
    assert sorted(r.impressions for r in spark.read.parquet(p).collect()) == [1, 2, 3]


def test_stored_table_evolves(spark, tmp_path):
    from pyspark.sql import types as T
    p = str(tmp_path / "t")
    S = lambda *f: T.StructType([T.StructField(n, t) for n, t in f])
    first = S(("day", T.DateType()), ("n", T.IntegerType()), ("name", T.StringType()))
    assert lake.ensure_table(spark, p, first, "day") == ["day", "n", "name"]
    empty = lake.read_table(spark, p)
    assert empty.count() == 0 and empty.columns == ["day", "n", "name"]
    lake.load_declared(spark.createDataFrame([(D(2024, 1, 1), 5, "a")], "day date, n int, name string"), p, "day")
    # the same again changes nothing; a new column and a wider type do; a left-out column stays
    assert lake.ensure_table(spark, p, first, "day") == []
    assert lake.ensure_table(spark, p, S(("n", T.LongType()), ("note", T.StringType())), "day") == ["note"]
    lake.load_declared(spark.createDataFrame([(D(2024, 1, 2), 2**40, "x")], "day date, n long, note string"), p, "day")
    got = sorted(tuple(r) for r in lake.read_table(spark, p).collect())
    assert got == [(D(2024, 1, 1), 5, "a", None), (D(2024, 1, 2), 2**40, None, "x")]
    for bad, part in ((S(("n", T.IntegerType())), "day"), (S(("name", T.LongType())), "day"), (first, None)):
        with pytest.raises(lake.SchemaConflictError):
            lake.ensure_table(spark, p, bad, part)
    with pytest.raises(lake.SchemaConflictError):
        lake.load_declared(spark.createDataFrame([(1,)], "surprise int"), p)
    assert sorted(tuple(r) for r in lake.read_table(spark, p).collect()) == got


def test_a_table_from_before_its_declaration(spark, tmp_path):
    from pyspark.sql import types as T
    p = str(tmp_path / "t")
    spark.createDataFrame([(1, "a")], "n int, name string").write.parquet(p)
    assert lake.ensure_table(spark, p, T.StructType([T.StructField("more", T.DoubleType())])) == ["more"]
    lake.load_declared(spark.createDataFrame([(2, 0.5)], "n int, more double"), p)
    assert sorted(tuple(r) for r in lake.read_table(spark, p).collect()) == [(1, "a", None), (2, None, 0.5)]
