"""CSV files as people save them (SRC16, SRC17): columns by header name, line breaks, bad dates."""

import datetime as dt

from martcraft.sources import files

HEAD = ",".join(files.MANUAL_COLUMNS)


def _write(folder, name, text, encoding="utf-8"):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_bytes(text.encode(encoding))


def test_columns_are_found_by_name(spark, tmp_path):
    _write(tmp_path, "a.csv", HEAD + "\n2025-02-20,B,Meta,7,camp,shop,\"1,000\",5,₩30,2,9\n")
    # another order, columns left out, one nobody asked for, a byte order mark
    _write(tmp_path, "b.csv", "cost,memo,media,mall,report_date\r\n\"2,500\",x, GFA ,A,2025-02-21 10:00\r\n", "utf-8-sig")
    _write(tmp_path / "sub", "c.csv", HEAD + "\n2025-02-22,a,meta,,\"two\nlines, \"\"quoted\"\"\",,,,,,\n\n")
    _write(tmp_path, "_TEMPLATE.csv", HEAD + "\n2000-01-01,x,x,,,,,,,,\n")
    _write(tmp_path, "empty.csv", "")
    _write(tmp_path, "notes.txt", HEAD + "\n2000-01-01,x,x,,,,,,,,\n")
    got = {r.source: r for r in files.read_manual_ads(spark, str(tmp_path)).collect()}
    assert set(got) == {"a.csv", "b.csv", "c.csv"}
    a, b, c = got["a.csv"], got["b.csv"], got["c.csv"]
    assert (a.report_date, a.mall, a.media, a.impressions, a.cost) == (dt.date(2025, 2, 20), "b", "meta", 1000, 30.0)
    assert (b.report_date, b.mall, b.media, b.cost, b.clicks) == (dt.date(2025, 2, 21), "a", "gfa", 2500.0, 0)
    assert b.landing is None and b.campaign_name is None and b.conversions is None
    assert c.campaign_name == 'two\nlines, "quoted"' and c.campaign_id is None and c.conversion_value is None


def test_rows_with_a_bad_date_are_set_aside(spark, tmp_path):
    rows = ["2025-02-20,a", "20/02/2025,b", "2025-02-30,c", ",d", "  ,e", "2025-3-1,f", "2025,g"]
    _write(tmp_path, "a.csv", "report_date,mall\n" + "\n".join(rows) + "\n")
    landed = files.load_keyword_history(spark, str(tmp_path))
    assert {r.mall: str(r.report_date) for r in landed.rows.collect()} == {"a": "2025-02-20", "f": "2025-03-01"}
    bad = {r.raw.mall: (r.source, r.reason) for r in landed.rejected.collect()}
    assert bad == {m: ("a.csv", f"report_date is no date: {t}") for m, t in (("b", "20/02/2025"), ("c", "2025-02-30"), ("g", "2025"))}


def test_short_long_and_repeated_columns(spark, tmp_path):
    _write(tmp_path, "a.csv", "report_date,mall,mall,\"ad\ntype\",clicks\n2025-01-01,first,Last\n2025-01-02,x,y,z,3.9,more,and more\n")
    got = {str(r.report_date): r for r in files.read_keyword_history(spark, str(tmp_path)).collect()}
    assert got["2025-01-01"].mall == "last" and got["2025-01-01"].clicks == 0
    assert got["2025-01-02"].mall == "y" and got["2025-01-02"].clicks == 3


def test_one_scan_per_distinct_header(spark, tmp_path):
    for i in range(6):
        _write(tmp_path, f"{i}.csv", ("report_date,mall" if i % 2 else "mall,report_date") + "\n" +
               ("2025-01-01,a" if i % 2 else "b,2025-01-02") + "\n")
    df = files.read_by_header(spark, str(tmp_path), ["report_date", "mall"])
    assert df.count() == 6 and df._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 2


def test_no_files(spark, tmp_path):
    assert files.read_manual_ads(spark, str(tmp_path / "none")).count() == 0
    _write(tmp_path, "a.csv", HEAD + "\n")
    assert files.read_manual_ads(spark, str(tmp_path)).count() == 0
