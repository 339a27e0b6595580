"""Idempotent write modes on date-partitioned parquet (SNK1-SNK13).

Every mode is safe to re-run with the same input.  Partition directories
are listed and removed through the Hadoop FileSystem API of the session, so
the same code works on HDFS and object stores.  Plain parquet has no
transactions: the staged modes (SNK6, SNK7) write the new data completely
to a staging folder under the session's shared ``spark.checkpoint.dir``
before touching the table, which narrows the window of a partial state to
the per-partition directory swap.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martcraft.sinks.views import ViewRegistry, register_current_views  # noqa: F401 - kept under their old names



class DuplicateKeyError(ValueError):
    pass


# ------------------------------------------------------------ file system
def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def list_partitions(spark: SparkSession, path: str, col: str) -> dict[str, str]:
    """Partition value -> directory for ``col=value`` folders (metadata only)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return {}
    out = {}
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith(col + "="):
            out[name.split("=", 1)[1]] = st.getPath().toString()
    return out


def _delete(spark, path: str) -> None:
    fs, p = _fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def _rename(spark, src: str, dst: str) -> None:
    fs, s = _fs(spark, src)
    _, d = _fs(spark, dst)
    if not fs.rename(s, d):
        raise OSError(f"rename failed: {src} -> {dst}")


def drop_files(spark: SparkSession, folder: str) -> None:
    """Remove a folder's data files, not the folder."""
    fs, p = _fs(spark, folder)
    for st in fs.listStatus(p):
        if st.isFile() and not st.getPath().getName().startswith("_"):
            fs.delete(st.getPath(), False)


def drop_partitions(spark: SparkSession, path: str, col: str, keep) -> list[str]:
    """Remove ``col=value`` folders whose date fails ``keep(date)``."""
    dropped = []
    for v, d in list_partitions(spark, path, col).items():
        try:
            day = dt.date.fromisoformat(v[:10])
        except ValueError:
            continue
        if not keep(day):
            _delete(spark, d)
            dropped.append(v)
    return sorted(dropped)


def table_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def read_text(spark: SparkSession, path: str) -> str | None:
    """First line of a small metadata file; None where there is none."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    jvm = spark.sparkContext._jvm
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(fs.open(p), "UTF-8"))
    try:
        return reader.readLine()
    finally:
        reader.close()


def write_text(spark: SparkSession, path: str, line: str) -> None:
    """Replace a small metadata file: written aside, then renamed in."""
    fresh = f"{path}.{uuid.uuid4().hex}"
    fs, p = _fs(spark, fresh)
    out = fs.create(p)                              # creates the folder too
    try:
        out.write(bytearray(line + "\n", "utf-8"))
    finally:
        out.close()
    _delete(spark, path)
    _rename(spark, fresh, path)


def file_states(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(path, length, time) of every data file under a path: what a reader of it would see (metadata only)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    out, todo = [], [fs.getFileStatus(p)]
    while todo:
        st = todo.pop()
        if st.isFile():
            out.append((st.getPath().toString(), st.getLen(), st.getModificationTime()))
        else:
            todo += [x for x in fs.listStatus(st.getPath()) if not x.getPath().getName().startswith(("_", "."))]
    return sorted(out)


def has_data(spark: SparkSession, folder: str) -> bool:
    """Whether a folder holds a non-empty data file (metadata only)."""
    fs, p = _fs(spark, folder)
    return fs.exists(p) and any(st.isFile() and st.getLen() > 0 and not st.getPath().getName().startswith(("_", "."))
                                for st in fs.listStatus(p))


# ------------------------------------------------------------------ modes
def by_date(df: DataFrame, date_col: str) -> DataFrame:
    """A date's rows together before a partitioned write, so files are few; a
    dominant date is still split over several tasks."""
    return df.hint("rebalance", date_col)


def partition_overwrite(df: DataFrame, path: str, date_col: str = "report_date") -> None:
    """SNK1: overwrite only the dates present in the batch; rows without a
    date are dropped; a date absent from the batch keeps its old rows."""
    (by_date(df.filter(F.col(date_col).isNotNull()), date_col)
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(date_col).parquet(path))


def replace_table_keep_if_empty(df: DataFrame, path: str) -> bool:
    """SNK2: full overwrite, but an empty batch leaves the table as it is."""
    if df.isEmpty():
        return False
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
    return True


def replace_table(df: DataFrame, path: str) -> None:
    """SNK3: full overwrite, also with an empty batch (schema only)."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def range_replace(df: DataFrame, path: str, start: dt.date, end: dt.date,
                  date_col: str = "date") -> list[str]:
    """SNK4: the table's [start, end] equals the batch's rows in that range.

    New data is written first (dynamic overwrite of the dates it has), then
    dates of the range the batch no longer has are removed; so a re-run
    never leaves a populated date missing.  Returns the purged dates."""
    spark = df.sparkSession
    batch = df.filter(F.col(date_col).between(F.lit(start), F.lit(end)))
    stage = f"{path.rstrip('/')}/_stage-{uuid.uuid4().hex}"
    by_date(batch, date_col).write.mode("overwrite").partitionBy(date_col).parquet(stage)
    present = set(list_partitions(spark, stage, date_col))       # the batch is computed once
    _swap(spark, stage, path, date_col)
    _delete(spark, stage)
    return drop_partitions(spark, path, date_col,
                           lambda d: not (start <= d <= end) or d.isoformat() in present)


def _swap(spark: SparkSession, stage: str, path: str, date_col: str, gone: list[str] = ()) -> None:
    """Put staged date folders in place of the table's, and take the ``gone`` dates out.

    Old folders are renamed aside, new ones renamed in, the old ones deleted
    last; on an error the old ones are put back.  Stage and table share a
    folder, so every step is a rename within one file system."""
    root = path.rstrip("/")
    aside = f"{root}/_old-{uuid.uuid4().hex}"
    fs, p = _fs(spark, aside)
    fs.mkdirs(p)
    moved: list[tuple[str, str]] = []
    placed: list[str] = []
    try:
        for v in [*list_partitions(spark, stage, date_col), *gone]:
            target, kept = f"{root}/{date_col}={v}", f"{aside}/{date_col}={v}"
            if table_exists(spark, target):
                _rename(spark, target, kept)
                moved.append((kept, target))
            if v not in gone:
                _rename(spark, f"{stage}/{date_col}={v}", target)
                placed.append(target)
    except Exception:
        for target in placed:
            _delete(spark, target)
        for kept, target in moved:
            _rename(spark, kept, target)
        raise
    finally:
        if not moved or table_exists(spark, moved[0][0]):
            _delete(spark, aside)


def range_replace_with_retention(df: DataFrame, path: str, start: dt.date, end: dt.date,
                                 as_of: dt.date, keep_days: int, date_col: str = "date") -> list[str]:
    """SNK5: SNK4, then drop partitions older than ``as_of - keep_days``."""
    purged = range_replace(df, path, start, end, date_col)
    cutoff = as_of - dt.timedelta(days=keep_days)
    purged += drop_partitions(df.sparkSession, path, date_col, lambda d: d >= cutoff)
    return sorted(purged)


def atomic_range_replace(df: DataFrame, path: str, start: dt.date, end: dt.date,
                         date_col: str = "report_date") -> None:
    """SNK6: stage the whole range, then swap partition folders.

    The batch is fully written beside the table before any table folder
    changes; each date folder is then replaced by directory renames (atomic
    per folder on HDFS, a copy on object stores) and put back on an error.
    Not a multi-partition transaction.
    """
    spark = df.sparkSession
    stage = f"{path.rstrip('/')}/_stage-{uuid.uuid4().hex}"
    by_date(df.filter(F.col(date_col).between(F.lit(start), F.lit(end))), date_col) \
        .write.mode("overwrite").partitionBy(date_col).parquet(stage)
    staged = list_partitions(spark, stage, date_col)
    gone = [v for v in list_partitions(spark, path, date_col)
            if v not in staged and start <= dt.date.fromisoformat(v[:10]) <= end]
    _swap(spark, stage, path, date_col, gone)
    _delete(spark, stage)


MERGE_KEY = ["media", "mall", "report_date"]
MERGE_UPDATE = ["campaign_id", "landing", "impressions", "clicks", "cost", "conversions",
                "conversion_value", "source", "loaded_at"]


def merge_upsert(source: DataFrame, path: str, key: list[str] = MERGE_KEY,
                 name_col: str = "campaign_name", date_col: str = "report_date",
                 update: list[str] = MERGE_UPDATE) -> list[str]:
    """SNK7: MERGE on (key..., coalesce(name, '')), copy-on-write by file.

    Matched rows take the source's ``update`` columns and keep all others of the
    table, unmatched source rows are inserted.  NULL key parts never match (SQL
    equality).  Duplicate source keys raise.  Columns only the source has join the table.

    Only files that hold a matched row are rewritten: their names come from one
    semi join that reads the key columns of the source's dates.  New files are
    staged beside the table, then renamed into their date folders and the old
    files taken out; on an error the old files are put back.  Returns the
    files that were replaced."""
    spark = source.sparkSession
    name_key = F.coalesce(F.col(name_col), F.lit(""))
    keys = key + ["_name_key"]
    non_null = F.lit(True)
    for c in key:
        non_null = non_null & F.col(c).isNotNull()
    src = source.withColumn("_name_key", name_key)
    dup = src.filter(non_null).groupBy(*keys).count().filter(F.col("count") > 1).limit(1)
    if not dup.isEmpty():
        raise DuplicateKeyError("duplicate merge keys in source")
    if not table_exists(spark, path):
        partition_overwrite(source, path, date_col)
        return []
    table = read_table(spark, path)
    wanted = src.filter(non_null).select(*keys)
    first, last = wanted.agg(F.min(date_col), F.max(date_col)).first()       # literal bounds prune the folders
    near = table.filter(F.col(date_col).between(F.lit(first), F.lit(last)))
    held = (near.select("*", F.col("_metadata.file_path").alias("_file")).withColumn("_name_key", name_key)
            .join(wanted, keys, "left_semi"))
    # names of the files to rewrite: metadata, bounded by the files of the source's dates
    old = sorted(_plain_path(spark, r[0]) for r in held.select("_file").distinct().collect())
    rows = spark.read.schema(table.schema).option("basePath", path).parquet(*old) if old else table.limit(0)
    extra = [c for c in source.columns if c not in table.columns]
    s = src.filter(non_null).select(*keys, F.lit(True).alias("_hit"),
                                    *[F.col(c).alias(f"_s_{c}") for c in [*update, *extra] if c in source.columns])
    joined = rows.withColumn("_name_key", name_key).join(s, keys, "left")
    taken = {c: F.when(F.col("_hit"), F.col(f"_s_{c}")).otherwise(F.col(c)) for c in update if c in source.columns}
    rewritten = joined.select(*[taken.get(c, F.col(c)).alias(c) for c in table.columns],
                              *[F.col(f"_s_{c}").alias(c) for c in extra])
    inserted = src.join(rows.withColumn("_name_key", name_key).filter(non_null).select(*keys), keys, "left_anti")
    merged = rewritten.unionByName(inserted.drop("_name_key"), allowMissingColumns=True)
    stage = f"{path.rstrip('/')}/_stage-{uuid.uuid4().hex}"
    by_date(merged, date_col).write.mode("overwrite").partitionBy(date_col).parquet(stage)
    _swap_files(spark, stage, path, old)
    _delete(spark, stage)
    return old


def _plain_path(spark: SparkSession, uri: str) -> str:
    """A file's path as the file system names it (``_metadata`` gives an escaped URI)."""
    jvm = spark.sparkContext._jvm
    return jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI.create(uri)).toString()


def _swap_files(spark: SparkSession, stage: str, path: str, old: list[str]) -> None:
    """Move the staged files into the table's folders and the ``old`` files out."""
    root = path.rstrip("/")
    aside = f"{root}/_old-{uuid.uuid4().hex}"
    fs, p = _fs(spark, aside)
    fs.mkdirs(p)
    moved: list[tuple[str, str]] = []
    placed: list[str] = []
    _, s = _fs(spark, stage)
    try:
        for i, f in enumerate(old):
            _rename(spark, f, f"{aside}/{i}")
            moved.append((f"{aside}/{i}", f))
        for folder in fs.listStatus(s):
            if not folder.isDirectory():
                continue
            target = f"{root}/{folder.getPath().getName()}"
            fs.mkdirs(_fs(spark, target)[1])
            for f in fs.listStatus(folder.getPath()):
                # file names carry the write's own id, so they meet no other file
                _rename(spark, f.getPath().toString(), f"{target}/{f.getPath().getName()}")
                placed.append(f"{target}/{f.getPath().getName()}")
    except Exception:
        for f in placed:
            _delete(spark, f)
        for kept, f in moved:
            _rename(spark, kept, f)
        raise
    _delete(spark, aside)


def append_snapshot(df: DataFrame, path: str, at_col: str = "snapshot_at",
                    at: dt.datetime | None = None) -> None:
    """SNK8: append-only restatement log stamped with the snapshot time."""
    stamp = F.lit(at) if at is not None else F.current_timestamp()
    out = df if at_col in df.columns else df.withColumn(at_col, stamp)
    out.write.mode("append").parquet(path)


def snapshot_partition(df: DataFrame, path: str, snapshot_col: str = "snapshot_date") -> None:
    """SNK9: today's snapshot partition replaced, history kept (SNK1)."""
    partition_overwrite(df, path, snapshot_col)


def write_mart(df: DataFrame, path: str, date_col: str = "report_date",
               cluster_by: tuple[str, ...] = (), files: int | None = None) -> None:
    """SNK10: CREATE OR REPLACE a partitioned, clustered mart.

    Range partitioning on (date, cluster keys) balances the write tasks even
    when one date dominates, and leaves each file sorted by the cluster keys
    so parquet min/max statistics skip row groups on those columns."""
    keys = [date_col, *cluster_by]
    n = files or df.sparkSession.sparkContext.defaultParallelism
    (df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
       .write.mode("overwrite").option("partitionOverwriteMode", "static")
       .partitionBy(date_col).parquet(path))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """SNK11: add missing columns as NULL and cast to the declared types;
    extra columns are kept at the end (add-only evolution)."""
    have = set(df.columns)
    cols = [(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields]
    extra = [F.col(c) for c in df.columns if c not in {f.name for f in schema.fields}]
    return df.select(*cols, *extra)


class SchemaConflictError(ValueError):
    pass


SCHEMA_FILE = "_declared_schema.json"
# fixed values: a stored type -> the types it may be widened to without losing a value
WIDER = {
    "tinyint": {"smallint", "int", "bigint"}, "smallint": {"int", "bigint"}, "int": {"bigint", "double"},
    "float": {"double"},
}


def declared_schema(spark: SparkSession, path: str) -> tuple[T.StructType, str | None] | None:
    """(schema, partition column) kept beside a table's data; None where none was declared."""
    text = read_text(spark, f"{path.rstrip('/')}/{SCHEMA_FILE}")
    if text is None:
        return None
    held = json.loads(text)
    return T.StructType.fromJson(held["schema"]), held["partition"]


def ensure_table(spark: SparkSession, path: str, schema: T.StructType, partition_col: str | None = None) -> list[str]:
    """SNK11: create the empty table, or add the columns it lacks (nullable, at the end) and widen types.

    The declared schema is one small file beside the data, written aside and renamed in; data files are not
    touched: old rows read an added column as NULL.  A column that is left out stays.  A narrower or another
    type, or another partition column, raises and changes nothing.  Returns the columns added."""
    held = declared_schema(spark, path)
    if held is None and table_exists(spark, path) and not _is_empty(spark, path):
        held = (spark.read.parquet(path).schema, partition_col)        # a table from before its first declaration
    old, part = held if held else (T.StructType(), partition_col)
    if part != partition_col:
        raise SchemaConflictError(f"{path} is partitioned by {part}, not {partition_col}")
    fields = {f.name: f for f in old.fields}
    added = []
    for f in schema.fields:
        if f.name not in fields:
            added.append(f.name)
            fields[f.name] = T.StructField(f.name, f.dataType, True)
            continue
        have, want = fields[f.name].dataType.simpleString(), f.dataType.simpleString()
        if have != want and want not in WIDER.get(have, set()):
            raise SchemaConflictError(f"{path}: column {f.name} is {have}, {want} is declared")
        fields[f.name] = T.StructField(f.name, f.dataType, True)
    text = json.dumps({"schema": T.StructType(list(fields.values())).jsonValue(), "partition": partition_col})
    write_text(spark, f"{path.rstrip('/')}/{SCHEMA_FILE}", text)
    return added


def _is_empty(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return not any(not st.getPath().getName().startswith(("_", ".")) for st in fs.listStatus(p))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A landed table.  With a declared schema its columns and types are those, whatever each file has, and no
    footer is opened for them; without one, add-only changes are merged across the files."""
    held = declared_schema(spark, path)
    if held is None:
        return spark.read.option("mergeSchema", "true").parquet(path)
    schema, part = held
    df = spark.read.schema(schema).parquet(path)
    return df.select(*[f.name for f in schema.fields]) if part else df


def load_declared(df: DataFrame, path: str, date_col: str | None = None) -> None:
    """Write a batch into a table of ``ensure_table``: cast to the declared columns, unknown columns refused,
    dates present overwritten (SNK1) or, without a date column, rows appended."""
    held = declared_schema(df.sparkSession, path)
    if held is None:
        raise SchemaConflictError(f"{path} has no declared schema")
    unknown = [c for c in df.columns if c not in held[0].fieldNames()]
    if unknown:
        raise SchemaConflictError(f"{path} has no columns {unknown}: declare them first")
    rows = conform(df, held[0])
    if date_col:
        partition_overwrite(rows, path, date_col)
    else:
        rows.write.mode("append").parquet(path)


BOM = "﻿"


def export_csv(df: DataFrame, path: str, columns: list[str], parts: int | None = None) -> None:
    """SNK13: audience file(s) with a header in UTF-8 and a BOM before the
    header (spreadsheet friendly); one header per part file.  ``parts`` bounds
    the number of files; by default each task writes its own."""
    out = df.select(*columns)
    out = out.withColumnRenamed(columns[0], BOM + columns[0])
    out = out if parts is None else out.coalesce(parts)
    out.write.mode("overwrite").option("header", True) \
        .option("encoding", "UTF-8").csv(path)


def register_brand_views(spark: SparkSession, tables: dict, brands: list[str],
                         mall_col: str = "mall") -> list[str]:
    """PRJ16 (opt-in): one filtered view per table and brand, ``<table>_<brand>``."""
    done = []
    for name, df in tables.items():
        for b in brands:
            df.filter(F.col(mall_col) == b).createOrReplaceTempView(f"{name}_{b}")
            done.append(f"{name}_{b}")
    return done
