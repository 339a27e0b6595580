"""Row numbers by range partitions (ST1, SNK13), and order keys."""

from pyspark.sql import functions as F

from martcraft.operators.ordering import with_row_number
from martcraft.plans import design


def test_numbers_equal_a_sort(spark):
    rows = [(i * 7919 % 1009, None if i % 11 == 0 else f"k{i % 5}") for i in range(1000)]
    df = spark.createDataFrame(rows, "v int, k string").repartition(6)
    got = with_row_number(df, [F.col("k").desc(), F.col("v").asc()])
    want = [r[:] for r in df.orderBy(F.col("k").desc(), F.col("v").asc()).collect()]
    have = sorted(got.collect(), key=lambda r: r.row_no)
    assert [r.row_no for r in have] == list(range(1, 1001))
    assert [(r.v, r.k) for r in have] == [tuple(r) for r in want]
    assert "SinglePartition" not in got.select("row_no")._jdf.queryExecution().toString().split("Window")[0]


def test_numbers_of_small_and_empty_tables(spark):
    assert with_row_number(spark.range(0), [F.col("id")]).count() == 0
    assert [r.row_no for r in with_row_number(spark.range(1), [F.col("id")]).collect()] == [1]


def test_order_keys(spark):
    ids = ["T123", " t123 ", "123", "T-123", "A1-2", "1-2", "QQ", "AB-X", "", None, "TX9"]
    df = spark.createDataFrame([(i,) for i in ids], "x string")
    got = [r[0] for r in df.select(design.order_key("x", ("T",))).collect()]
    assert got == ["123", "123", "123", "123", "A12", "12", None, None, None, None, "TX9"]
