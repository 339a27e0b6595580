"""Scheduled re-computation as Structured Streaming (MB1-MB4).

The reference refreshes the current day hourly and re-loads the last N days
to absorb late restatements; it has no watermark or stateful operator.
Here the landing zone is a file source read with ``trigger(availableNow)``:
each run processes the files that arrived since the last run (tracked in
the checkpoint) and hands every micro-batch to an idempotent sink, so a
replayed batch rewrites the same partitions with the same rows.
"""

from __future__ import annotations

import calendar
import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martcraft.sinks import lake


# ------------------------------------------------------------------- MB3
def load_span(as_of: dt.date, *, days: int | None = None, since: dt.date | None = None,
              until: dt.date | None = None, months: int | None = None,
              end_yesterday: bool = False) -> tuple[dt.date, dt.date]:
    """Load window: explicit since/until, the last N days, or the last N
    months shortened by a 5-day safety buffer (start = the same day N months
    earlier, clamped to that month's end, plus 5 days).  Search/meta loads
    end today, analytics/display/cost loads end yesterday
    (``end_yesterday``)."""
    end = until or (as_of - dt.timedelta(days=1) if end_yesterday else as_of)
    if since:
        return since, end
    if months:
        year, month0 = divmod(12 * end.year + end.month - 1 - months, 12)
        last = calendar.monthrange(year, month0 + 1)[1]
        return dt.date(year, month0 + 1, min(end.day, last)) + dt.timedelta(days=5), end
    n = days or 1
    return end - dt.timedelta(days=n - 1), end


def lookback_filter(df: DataFrame, as_of: dt.date, lookback: int, date_col: str = "report_date",
                    end_yesterday: bool = False) -> DataFrame:
    """MB2: restrict a landing read to the re-load window (literal bounds, so
    the scan prunes partitions)."""
    start, end = load_span(as_of, days=lookback, end_yesterday=end_yesterday)
    return df.filter(F.col(date_col).between(F.lit(start), F.lit(end)))


# ------------------------------------------------------------------- MB1
def export_of(path_col: Column | str = "_path") -> Column:
    """Export a landed file belongs to: its folder for part files, else itself."""
    p = F.col(path_col) if isinstance(path_col, str) else path_col
    return F.regexp_replace(p, "/part-[^/]*$", "")


def latest_exports(landed: DataFrame, landed_date: Column) -> DataFrame:
    """The rows of each date's latest export (by time, then name); rows without a date go.

    One aggregate of (date, time, export) and a semi join, however many exports arrived together.  Each export's
    time comes first: that aggregate is hashed, where a maximum of structs would sort all rows of a task."""
    dated = landed.withColumn("_day", landed_date)
    last = (dated.groupBy("_day", "_export").agg(F.max("_time").alias("_time"))
            .groupBy("_day").agg(F.max(F.struct("_time", "_export")).alias("_last"))
            .select("_day", F.col("_last._export").alias("_export")))
    return dated.join(last, ["_day", "_export"], "left_semi").drop("_day")


def intraday_refresh(spark: SparkSession, landing: str, schema: T.StructType, fmt: str,
                     shape: Callable[[DataFrame], DataFrame], target: str, checkpoint: str,
                     date_col: str = "report_date", as_of: dt.date | None = None,
                     landed_date: Column | None = None, export: Column | None = None,
                     arrived: Column | None = None):
    """Process newly landed files once (availableNow) and overwrite the dates
    they carry (SNK1).  ``as_of`` limits the batch to the business day, which
    makes the target the intraday ``_d0`` twin.

    Input contract: an export (a file, or a folder of part files) is complete
    for every date it carries, so of exports that arrive together the latest
    one's rows of a date stand.  ``landed_date`` is the date of a landed row; with it
    a batch of any number of exports is one pass and one write.  Without it the
    date is only known after ``shape``, and the exports are applied one after the
    other, oldest first.  ``export`` names a row's export (default: :func:`export_of` its file),
    ``arrived`` orders exports (default: the file's time), those of one time go by name."""

    def write(rows: DataFrame) -> None:
        out = shape(rows.drop("_export", "_path", "_time"))
        if as_of is not None:
            out = out.filter(F.col(date_col) == F.lit(as_of))
        lake.partition_overwrite(out, target, date_col)

    def sink(batch: DataFrame, batch_id: int) -> None:
        landed = batch.withColumn("_export", export_of() if export is None else export)
        if arrived is not None:
            landed = landed.withColumn("_time", arrived)
        if landed_date is not None:
            write(latest_exports(landed, landed_date))
            return
        exports = (landed.groupBy("_export").agg(F.max("_time").alias("_time"))
                   .orderBy("_time", "_export").collect())      # one row per landed export
        for e in exports:
            write(landed if len(exports) == 1 else landed.filter(F.col("_export") == e["_export"]))

    q = (spark.readStream.format(fmt).schema(schema).load(landing)
         .select("*", F.col("_metadata.file_path").alias("_path"),
                 F.col("_metadata.file_modification_time").alias("_time"))
         .writeStream.foreachBatch(sink)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def intraday_refresh_batch(df: DataFrame, shape: Callable[[DataFrame], DataFrame], target: str,
                           date_col: str = "report_date", as_of: dt.date | None = None) -> None:
    """Batch twin of :func:`intraday_refresh` (tests, backfills)."""
    out = shape(df)
    if as_of is not None:
        out = out.filter(F.col(date_col) == F.lit(as_of))
    lake.partition_overwrite(out, target, date_col)


# ------------------------------------------------------------------- MB4
def restatement_log(spark: SparkSession, landing: str, schema: T.StructType, fmt: str,
                    snapshot: Callable[[DataFrame], DataFrame], target: str, checkpoint: str):
    """Append-only snapshot of each arriving batch (SNK8), stamped per batch.

    The log is partitioned by batch: a replayed batch rewrites its own partition
    and no other part of the log is read."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        out = snapshot(batch).withColumn("batch_id", F.lit(batch_id).cast("long"))
        if "snapshot_at" not in out.columns:
            out = out.withColumn("snapshot_at", F.current_timestamp())
        lake.partition_overwrite(out, target, "batch_id")

    q = (spark.readStream.format(fmt).schema(schema).load(landing)
         .writeStream.foreachBatch(sink)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q
