"""Operator 11: lines that many documents share, found with levelled sorted runs of line hashes.

A line's key is the line without ASCII white space at its ends, A-Z lower-cased, as a 128-bit
hash.  ``LineRuns`` keeps the number of documents per key in sorted runs: tables of (h1, h2, n),
bucketed and sorted by the hash, one per batch of documents.  When ``fanout`` runs of one level
have gathered they are merged into a run of the next level, so a batch meets a logarithmic
number of runs.  A new batch is merge-anti-joined with each run: keys that a run already holds
with enough documents are settled and not written again; the others become the batch's
own run.  Runs are bucketed alike, so these joins shuffle neither side.

A run's folder names the batches it covers and counts only when written completely; runs
inside a larger one are superseded.  ``LineRuns`` opened on the same folder goes on where it
stopped, and a batch added again after a lost driver replaces its run.

Spread: texts are hashed where they are read; keys are counted before they are shuffled, so a
line in a third of all documents sends a row per task.  The keys to drop come back by a hash of the
text, aggregated per distinct text, and texts meet them in one join that adaptive execution may
split; lines are cut by column functions, row by row.  No set of keys is collected or broadcast by this module.

Nulls and edge cases: a null or empty text is one empty line; every row is a document, also
when it repeats an id or a text; a line counts once a document; keys shorter than ``min_chars``
always stay; a text that loses all its lines is empty; an empty table gives no rows; other
columns are ignored by ``digest`` and pass through ``remove``.
"""

from __future__ import annotations

import re
import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martcraft.session import materialize, scratch_path

BLANK = b" \t\n\x0b\x0c\r"
MIN_DOCS = 10
BATCHES = 4
FANOUT = 2
KEY = ["h1", "h2"]
_KEYS = "t1 long, t2 long, h1 long, h2 long, places array<int>"


def _hash(key: bytes, min_chars: int) -> bytes | None:
    """128-bit hash of a key; None if it is too short to be judged."""
    if len(key) < min_chars or (min_chars > 1 and len(key.decode("utf-8", "surrogatepass")) < min_chars):
        return None
    return xxhash.xxh3_128_digest(key)


def _text_key(text) -> list:
    return [F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(11), text).alias("t2")]


def document_keys(docs: DataFrame, text_col: str = "text", batch=None, min_chars: int = 1) -> DataFrame:
    """(batch, t1, t2, h1, h2, places): a row per document and distinct line key, with the numbers of its lines
    (from 0); t1, t2 hash the text."""
    min_chars = max(min_chars, 1)
    rows = docs.select((F.lit(0) if batch is None else batch).cast("int").alias("batch"), *_text_key(F.col(text_col)),
                       F.col(text_col).alias("text"))

    def run(batches):
        for b in batches:
            held, places, count = [], [], np.zeros(b.num_rows, np.int64)
            for i, text in enumerate(b.column(3)):
                own: dict[bytes, list[int]] = {}
                for k, line in enumerate((text.as_py() or "").encode("utf-8", "surrogatepass").lower().split(b"\n")):
                    own.setdefault(line.strip(BLANK), []).append(k)
                for key, where in own.items():
                    h = _hash(key, min_chars)
                    if h is not None:
                        held.append(h)
                        places.append(where)
                        count[i] += 1
            keys = np.frombuffer(b"".join(held), np.int64).reshape(-1, 2)
            at = pa.array(np.repeat(np.arange(b.num_rows), count))
            yield pa.RecordBatch.from_arrays(
                [*(b.column(k).take(at) for k in range(3)), pa.array(keys[:, 0]), pa.array(keys[:, 1]),
                 pa.array(places, pa.list_(pa.int32()))], ["batch", "t1", "t2", "h1", "h2", "places"])

    return rows.mapInArrow(run, f"batch int, {_KEYS}")


class LineRuns:
    """Sorted runs of (h1, h2, n) in ``path``, a folder that driver and executors share."""

    def __init__(self, spark: SparkSession, path: str, min_docs: int = MIN_DOCS, buckets: int | None = None,
                 fanout: int = FANOUT) -> None:
        self.spark, self.path, self.min_docs, self.fanout = spark, path, min_docs, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.runs: dict[tuple[int, int], DataFrame] = {span: self._open(*span) for span in self._complete()}

    def _where(self, lo: int, hi: int) -> str:
        return f"{self.path}/run-{lo}-{hi}"

    def _complete(self) -> list[tuple[int, int]]:
        """Batches covered by the complete runs that no larger run covers."""
        jvm = self.spark._jvm
        folder = jvm.org.apache.hadoop.fs.Path(self.path)
        fs = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(folder):
            return []
        spans = []
        for status in fs.listStatus(folder):
            name = re.fullmatch(r"run-(\d+)-(\d+)", status.getPath().getName())
            if name and fs.exists(jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")):
                spans.append((int(name[1]), int(name[2])))
        return sorted(s for s in spans if not any(s != t and t[0] <= s[0] and s[1] <= t[1] for t in spans))

    def _open(self, lo: int, hi: int) -> DataFrame:
        # buckets are known to the catalog only: the name is dropped as soon as the table is resolved
        name = f"line_run_{uuid.uuid4().hex}"
        self.spark.sql(f"CREATE TABLE {name} (h1 BIGINT, h2 BIGINT, n BIGINT) USING parquet CLUSTERED BY (h1, h2) "
                       f"SORTED BY (h1, h2) INTO {self.buckets} BUCKETS LOCATION '{self._where(lo, hi)}'")
        run = self.spark.table(name)
        self.spark.sql(f"DROP TABLE {name}")
        return run

    def _write(self, rows: DataFrame, lo: int, hi: int) -> None:
        name = f"line_run_{uuid.uuid4().hex}"
        (rows.select(*KEY, "n").write.format("parquet").bucketBy(self.buckets, *KEY).sortBy(*KEY).mode("overwrite")
         .option("path", self._where(lo, hi)).saveAsTable(name))
        self.spark.sql(f"DROP TABLE {name}")
        self.runs[lo, hi] = self._open(lo, hi)

    def _files(self, spans: list[tuple[int, int]]) -> DataFrame:
        """The rows of several runs, read without their buckets: Spark 4.1 takes a union of bucketed scans to be
        dealt by the bucket columns although it is not, and would leave out the exchange before a sum."""
        return self.spark.read.schema("h1 long, h2 long, n long").parquet(*(self._where(*s) for s in spans))

    def _counted(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(*KEY).agg(F.sum("n").alias("n"))

    def add(self, batch: int, keys: DataFrame) -> None:
        """Add a batch: a row (h1, h2) per document and key.  Batches are numbered 0, 1, ..."""
        if any(lo < hi and lo <= batch <= hi for lo, hi in self.runs):
            return                               # merged into a larger run before a restart
        fresh = (keys.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n"))
                 .repartition(self.buckets, *KEY).sortWithinPartitions(*KEY))
        for span, run in sorted(self.runs.items()):
            if span != (batch, batch):
                settled = run.where(F.col("n") >= self.min_docs).select(*KEY)
                fresh = fresh.join(settled.hint("merge"), KEY, "left_anti")
        self._write(fresh, batch, batch)
        self._compact()

    def _compact(self) -> None:
        while True:
            spans = sorted(self.runs)[-self.fanout:]
            size = spans[-1][1] - spans[-1][0] + 1
            if len(spans) < self.fanout or any(hi - lo + 1 != size for lo, hi in spans):
                return
            # entries are unique in a run: they are dealt to their buckets first and summed there
            rows = self._counted(self._files(spans).repartition(self.buckets, *KEY))
            self._write(rows, spans[0][0], spans[-1][1])
            for s in spans:
                del self.runs[s]

    def frequent(self) -> DataFrame:
        """(h1, h2) of the keys found in at least ``min_docs`` documents of all batches."""
        spans = sorted(self.runs)
        if not spans:
            return self.spark.createDataFrame([], "h1 long, h2 long")
        whole = self._files(spans) if len(spans) == 1 else self._counted(self._files(spans))
        return whole.where(F.col("n") >= self.min_docs).select(*KEY)


def _dropped(texts: DataFrame) -> DataFrame:
    """(t1, t2, places) -> (__t1, __t2, __gone): for each line of a text, whether it goes; no more lines than needed."""
    def run(batches):
        for b in batches:
            flags = []
            for places in b.column(2):
                at = places.values.flatten().to_numpy()
                row = np.zeros(int(at.max()) + 1, bool)
                row[at] = True
                flags.append(row)
            ends = np.cumsum([0, *map(len, flags)])
            gone = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(flags)))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), gone], ["__t1", "__t2", "__gone"])

    return texts.mapInArrow(run, "__t1 long, __t2 long, __gone array<boolean>")


def _marked(docs: DataFrame, text_col: str, min_docs: int, min_chars: int, batches: int, path: str | None) -> DataFrame:
    """docs with ``__gone``: which lines of the text go (null: none, lines beyond its end stay)."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, f"line-runs-{uuid.uuid4().hex}")
    # any dealing to batches gives the same result
    batch = F.pmod(F.xxhash64(*docs.columns), F.lit(batches))
    document_keys(docs, text_col, batch, min_chars).write.mode("overwrite").partitionBy("batch").parquet(f"{path}/keys")
    keys = spark.read.schema(f"{_KEYS}, batch int").parquet(f"{path}/keys")
    runs = LineRuns(spark, f"{path}/runs", min_docs)
    for k in range(batches):
        runs.add(k, keys.where(F.col("batch") == k))
    # copies of a text have equal places, so a set keeps them once
    found = (keys.join(materialize(runs.frequent()), KEY, "left_semi").groupBy("t1", "t2")
             .agg(F.collect_set("places").alias("places")))
    gone = _dropped(found)
    t1, t2 = _text_key(docs[text_col])
    return docs.join(gone, (t1 == gone["__t1"]) & (t2 == gone["__t2"]), "left").drop("__t1", "__t2")


def _kept(lines):
    return F.array_join(F.filter(lines, lambda _, i: ~F.coalesce(F.get("__gone", i), F.lit(False))), "\n")


def digest(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = 1, id_col: str = "doc_id", text_col: str = "text",
           batches: int = BATCHES, path: str | None = None) -> DataFrame:
    """Per document: id, n_lines, n_dropped, kept_sha256.  ``path``: where keys and runs stay (default: scratch)."""
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    marked = _marked(docs, "text", min_docs, min_chars, batches, path)
    lines = F.split(F.coalesce("text", F.lit("")), "\n", -1)
    gone = F.coalesce(F.size(F.filter("__gone", lambda g: g)), F.lit(0))
    return marked.select(F.col("id").alias(id_col), F.size(lines).cast("long").alias("n_lines"),
                         F.when(F.col("__gone").isNull(), 0).otherwise(gone).cast("long").alias("n_dropped"),
                         F.sha2(F.when(F.col("__gone").isNull(), F.coalesce("text", F.lit(""))).otherwise(_kept(lines)), 256)
                         .alias("kept_sha256"))


def remove(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = 1, text_col: str = "text",
           batches: int = BATCHES, path: str | None = None) -> DataFrame:
    """The input without the shared lines; a null text stays null."""
    marked = _marked(docs, text_col, min_docs, min_chars, batches, path)
    text = F.col(text_col)
    cut = F.when(F.col("__gone").isNull(), text).otherwise(_kept(F.split(text, "\n", -1)))
    return marked.select(*(cut.alias(c) if c == text_col else F.col(c) for c in docs.columns))
