"""Row numbers over a whole table without a single-partition window (ST1, SNK13)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from martcraft.session import materialize


def with_row_number(df: DataFrame, order: list[Column], name: str = "row_no") -> DataFrame:
    """``df`` with its place (1, 2, ...) in ``order``, which should be total.

    One range partitioning puts the rows in order; a row's number is its place in its partition plus the rows of
    the partitions before.  The window that adds those up sees one row per partition."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    line = materialize(df.repartitionByRange(n, *order).sortWithinPartitions(*order)
                       .withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)                   # the partition's number; the place in it is below
    sizes = line.groupBy(part.alias("_part")).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select("_part", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return line.join(starts, part == F.col("_part")).select(
        (F.col("_start") + F.col("_at") - F.col("_first") + 1).alias(name), *df.columns)
