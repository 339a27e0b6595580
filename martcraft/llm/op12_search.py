"""Operator 12: ranked lexical search by presence masks.

The items' terms form the vocabulary (in blocks of ``block_items`` items or ``block_terms`` terms,
whichever is reached first, so what is sent to the tasks is bounded).  One pass over the texts writes,
per document, its length and the vocabulary terms in it with their frequencies; document frequencies
are summed per task and then over tasks.  Scoring reads these postings only.

A task takes its documents ``block_docs`` at a time and keeps a bitmap of documents per term.  For each
item the bitmaps of its terms are transposed into a presence mask per document, and documents are
grouped by mask.  The greatest score a mask can have is the sum, over its terms, of the greatest
contribution that the term makes anywhere in the block.  Distinct masks are evaluated by descending bound, all
documents of a mask exactly, until the next bound is below the k-th score so far (the task carries that
score from block to block).  An equal bound is still evaluated, as ids break ties.  Each task returns
at most k rows per item; a window per item merges them, limited to k rows a task before the shuffle.

Nulls and edge cases: a null or empty text, or one without a term, has no part in any statistic and is
never found; an item without terms, or whose terms no document holds, gives no rows; rows that repeat an
item id are one item with the terms of all; rows that repeat a document id are ranked as documents
of their own; a null document id comes last among equal scores; ids are integers; an empty table on
either side gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from martcraft.session import materialize

K = 10
BLOCK_ITEMS = 2000
BLOCK_TERMS = 200_000
BLOCK_DOCS = 8192
# bytes of terms stay (A-Z lower-cased), all others become blanks
_TABLE = bytes(b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20
               for b in range(256))


def terms(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_TABLE).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def item_terms(items: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """(item, terms): the distinct terms of each item id, as bytes."""
    rows = items.select(F.col(item_col).alias("item"), F.col(text_col).alias("text"))

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([sorted(set(terms(t.as_py()))) for t in b.column(1)], pa.list_(pa.binary()))],
                ["item", "terms"])

    kind = rows.schema["item"].dataType.simpleString()
    return (rows.mapInArrow(run, f"item {kind}, terms array<binary>").groupBy("item")
            .agg(F.array_distinct(F.flatten(F.collect_list("terms"))).alias("terms")))


def _blocks(items: Iterator[Row], block_items: int, block_terms: int) -> Iterator[list[tuple]]:
    held: list[tuple] = []
    n = 0
    for r in items:
        if held and (len(held) >= block_items or n + len(r.terms) > block_terms):
            yield held
            held, n = [], 0
        held.append((r.item, [bytes(t) for t in r.terms]))
        n += len(r.terms)
    if held:
        yield held


def postings(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """(doc, n, terms, tfs) of every document with a term: its vocabulary terms and their frequencies (int32)."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))

    def run(batches):
        known = vocabulary.get
        for b in batches:
            ids, ns, whats, tfs = [], [], [], []
            for i, text in enumerate(b.column(1)):
                words = terms(text.as_py())
                if not words:
                    continue
                found = np.fromiter(map(known, words, repeat(-1)), np.int32, len(words))
                what, tf = np.unique(found[found >= 0], return_counts=True)
                ids.append(i)
                ns.append(len(words))
                whats.append(what.tobytes())
                tfs.append(tf.astype(np.int32).tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(ids, pa.int64())), pa.array(ns, pa.int64()),
                                              pa.array(whats, pa.binary()), pa.array(tfs, pa.binary())],
                                             ["doc", "n", "terms", "tfs"])

    return rows.mapInArrow(run, "doc long, n long, terms binary, tfs binary")


def document_frequencies(posted: DataFrame, size: int) -> np.ndarray:
    """Documents per vocabulary term, summed in the tasks first; as long as the vocabulary."""
    def run(batches):
        df = np.zeros(size, np.int64)
        for b in batches:
            flat = np.frombuffer(b"".join(b.column(0).to_pylist()), np.int32)
            df += np.bincount(flat, minlength=size)
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(df[some])], ["t", "df"])

    out = np.zeros(size, np.int64)
    for r in posted.select("terms").mapInArrow(run, "t long, df long").groupBy("t").agg(F.sum("df").alias("df")).collect():
        out[r.t] = r.df
    return out


class _Best:
    """The k best (score, id) of an item so far: highest score first, then the least id, null ids last."""

    def __init__(self, k: int) -> None:
        self.k = k
        self.score, self.null, self.id = (np.zeros(0, t) for t in (np.int64, bool, np.int64))

    @property
    def floor(self) -> int:
        """What a document must reach to matter; every score above 0 does until there are k."""
        return int(self.score[-1]) if len(self.score) == self.k else 1

    def add(self, score: np.ndarray, null: np.ndarray, ids: np.ndarray) -> None:
        some = score >= self.floor
        score, null, ids = (np.concatenate([a, b[some]]) for a, b in ((self.score, score), (self.null, null), (self.id, ids)))
        first = np.lexsort((ids, null, -score))[:self.k]
        self.score, self.null, self.id = score[first], null[first], ids[first]


class _Block:
    """Documents of a task with a bitmap per term and what each term adds to each document's score."""

    def __init__(self, b: pa.RecordBatch, weights: np.ndarray, n_docs: int, n_terms: int) -> None:
        self.null = b.column(0).is_null().to_numpy(zero_copy_only=False)
        self.id = b.column(0).fill_null(0).to_numpy(zero_copy_only=False)
        self.size = size = b.num_rows
        m = 10 + 90 * b.column(1).to_numpy(zero_copy_only=False) * n_docs // n_terms
        whats = b.column(2).to_pylist()
        term = np.frombuffer(b"".join(whats), np.int32).astype(np.int64)
        tf = np.frombuffer(b"".join(b.column(3).to_pylist()), np.int32).astype(np.int64)
        doc = np.repeat(np.arange(size), np.fromiter((len(x) // 4 for x in whats), np.int64, size))
        order = np.argsort(term, kind="stable")
        term, doc, tf = term[order], doc[order], tf[order]
        self.key = term * size + doc                          # ascending
        self.adds = weights[term] * (1_000_000_000 * tf // (1000 * tf + 8 * m[doc]))
        self.cut = np.searchsorted(term, np.arange(len(weights) + 1))
        self.doc = doc
        self.most = np.zeros(len(weights), np.int64)
        np.maximum.at(self.most, term, self.adds)
        self._bits: dict[int, np.ndarray] = {}

    def bits(self, t: int) -> np.ndarray:
        """The term's documents as a bitmap."""
        if t not in self._bits:
            row = np.zeros(self.size, bool)
            row[self.doc[self.cut[t]:self.cut[t + 1]]] = True
            self._bits[t] = np.packbits(row)
        return self._bits[t]

    def masks(self, ts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(distinct presence masks as rows of booleans, documents ordered by mask, where each mask's documents start)."""
        wide = -(-len(ts) // 64) * 8
        present = np.unpackbits(np.stack([self.bits(t) for t in ts]), axis=1, count=self.size)
        packed = np.zeros((self.size, wide), np.uint8)
        packed[:, :-(-len(ts) // 8)] = np.packbits(present, axis=0).T
        keys = packed.view(np.uint64)[:, 0] if wide == 8 else packed.view(f"V{wide}")[:, 0]
        _, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
        docs = np.argsort(inverse, kind="stable")
        starts = np.searchsorted(inverse[docs], np.arange(len(first) + 1))
        return np.unpackbits(packed[first], axis=1, count=len(ts)).astype(bool), docs, starts

    def scores(self, docs: np.ndarray, ts: np.ndarray, present: np.ndarray) -> np.ndarray:
        """Exact scores; ``present``: which terms each document holds."""
        row, col = np.nonzero(present)
        at = np.searchsorted(self.key, ts[col] * self.size + docs[row])
        out = np.zeros(len(docs), np.int64)
        np.add.at(out, row, self.adds[at])
        return out

    def search(self, ts: np.ndarray, best: _Best, chunk: int = 64) -> None:
        ts = ts[self.cut[ts + 1] > self.cut[ts]]
        if not len(ts) or self.most[ts].sum() < best.floor:
            return
        rows, docs, starts = self.masks(ts)
        bound = rows @ self.most[ts]
        order = np.argsort(-bound, kind="stable")
        sizes = np.diff(starts)
        at = 0
        while at < len(order) and bound[order[at]] >= best.floor:
            # some masks at a time, all documents of each
            end = at + 1 + int(np.searchsorted(np.cumsum(sizes[order[at:at + chunk]]), chunk))
            group = order[at:min(end, len(order))]
            group = group[bound[group] >= best.floor]
            which = np.concatenate([docs[starts[g]:starts[g + 1]] for g in group])
            score = self.scores(which, ts, np.repeat(rows[group], sizes[group], axis=0))
            best.add(score, self.null[which], self.id[which])
            at = end


def best_of_tasks(posted: DataFrame, wanted: list[np.ndarray], weights: np.ndarray, n_docs: int, n_terms: int, k: int,
                  block_docs: int) -> DataFrame:
    """(item, doc, score): every task's k best documents of each item (numbers into ``wanted``)."""
    def run(batches):
        best = [_Best(k) for _ in wanted]
        for b in batches:
            for at in range(0, b.num_rows, block_docs):
                block = _Block(b.slice(at, block_docs), weights, n_docs, n_terms)
                for ts, own in zip(wanted, best):
                    block.search(ts, own)
        for i, own in enumerate(best):
            if len(own.score):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(own.score), i)), pa.array(own.id, mask=own.null), pa.array(own.score)],
                    ["item", "doc", "score"])

    return posted.mapInArrow(run, "item long, doc long, score long")


def search(docs: DataFrame, items: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text", block_items: int = BLOCK_ITEMS,
           block_terms: int = BLOCK_TERMS, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """item, rank (1 to k), document id, score: each item's ``k`` best documents."""
    spark = docs.sparkSession
    wanted = item_terms(items, item_col, item_text_col).where(F.size("terms") > 0)
    kind = wanted.schema["item"].dataType.simpleString()
    found = spark.createDataFrame([], f"item_id {kind}, doc long, score long")
    for block in _blocks(wanted.toLocalIterator(), block_items, block_terms):
        vocabulary: dict[bytes, int] = {}
        numbers = [np.array([vocabulary.setdefault(t, len(vocabulary)) for t in ts], np.int64) for _, ts in block]
        posted = materialize(postings(docs, vocabulary, id_col, text_col))
        n_docs, n_terms = posted.agg(F.count(F.lit(1)), F.sum("n")).first()
        if not n_docs:
            break
        df = document_frequencies(posted, len(vocabulary))
        weights = np.array([weight(n_docs, x) for x in df.tolist()], np.int64)
        rows = best_of_tasks(posted, numbers, weights, n_docs, n_terms, k, block_docs)
        ids = spark.createDataFrame([(i, item) for i, (item, _) in enumerate(block)], f"item long, item_id {kind}")
        # one row an item of this block
        found = found.union(rows.join(F.broadcast(ids), "item").select("item_id", "doc", "score"))
    order = W.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc"))
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select(F.col("item_id").alias(item_col), "rank", F.col("doc").alias(id_col), "score"))
