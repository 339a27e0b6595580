"""Operator 5: exact repeated substrings by threshold-bounded interval expansion.

A byte is removed if a ``min_len``-byte string covering it also starts anywhere else.

1. Every window of ``min_len`` bytes has one anchor, the k-gram in it with the least
   hash (leftmost).  Neighbouring windows with one anchor form a segment; equal
   windows have equal anchors, so only segments with a common anchor can share one.
   A segment row is an anchor hash, a content hash and a position: no text moves.
2. Anchors that occur once are dropped.  Segments equal in content are copies: they
   are kept once, counted, and all their windows repeat.
3. For anchors with several contents the segments' bytes are joined into bounded
   texts.  A suffix order gives the Burrows-Wheeler transform; starting with the
   single characters, intervals are extended to the left breadth first, and each new
   interval end fixes one common-prefix length, in increasing order.  Expansion stops
   at ``min_len``: what is not fixed by then has a common prefix at least that long.
4. An anchor with more than ``max_group`` bytes of distinct segments is split by where
   the anchor lies in the window, each half keyed by the longer string all its windows
   share; after eight halvings that string is the window itself.

Every row is a document of its own: rows are numbered and written once, and all steps go by
that number, so ids of any type may be null or repeat.

Nulls and edge cases: a null text is empty; texts shorter than ``min_len`` lose
nothing; equal rows are copies of each other; rows that share an id, or have none, are
judged by their own texts; an empty table gives no rows; other columns pass through ``remove``.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martcraft.llm.kernel import U64, mix
from martcraft.session import materialize

GRAM = 32
_BUFFER = 1 << 20
_RADIX = 0x2545F4914F6CDD1D
_INVERSE = pow(_RADIX, -1, 1 << 64)
_BYTE = np.random.Generator(np.random.PCG64(55)).integers(1, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
_TABLES: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = max(_BUFFER + 4096, n)
    if size not in _TABLES:
        _TABLES.clear()
        out = []
        for r in (_RADIX, _INVERSE):
            a = np.full(size, r, U64)
            a[0] = 1
            out.append(np.multiply.accumulate(a))
        _TABLES[size] = (out[0], out[1])
    return _TABLES[size]


def segments(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, min_len: int) -> tuple[np.ndarray, ...]:
    """Segments of the documents buf[starts[i]:ends[i]] laid end to end.

    (document, anchor hash, content hash, first window start, windows, anchor offset)."""
    n, wide = len(buf), min_len - GRAM + 1
    power, inverse = _power_tables(n + 1)
    sums = np.zeros(n + 1, U64)
    np.cumsum(_BYTE[buf] * power[:n], out=sums[1:])
    gram = mix((sums[GRAM:] - sums[:-GRAM]) * inverse[:n - GRAM + 1])
    bits = U64(int(n).bit_length())
    place = np.arange(len(gram), dtype=U64)
    low = ((gram >> bits) << bits) | place
    span = 1
    while span * 2 <= wide:
        low = np.minimum(low[:len(low) - span], low[span:])
        span *= 2
    if span < wide:
        low = np.minimum(low[:len(low) - (wide - span)], low[wide - span:])
    anchor = (low & ((U64(1) << bits) - U64(1))).astype(np.int64)

    keep = ends - starts >= min_len
    doc = np.repeat(np.flatnonzero(keep), (ends - starts - min_len + 1)[keep])
    if not len(doc):
        z = np.zeros(0, np.int64)
        return z, z, z, z, z, z
    first = np.concatenate([np.arange(a, b - min_len + 1) for a, b in zip(starts[keep], ends[keep])])
    a = anchor[first]
    cut = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (doc[1:] != doc[:-1])]))
    count = np.diff(np.append(cut, len(a)))
    s0, at, d = first[cut], a[cut], doc[cut]
    pre = at - s0
    end = s0 + count - 1 + min_len
    body = (sums[end] - sums[s0]) * inverse[s0]
    content = mix(body ^ mix((count.astype(U64) << U64(32)) + pre.astype(U64)))
    return d, gram[at].view(np.int64), content.view(np.int64), s0 - starts[d], count, pre


def _cover(spans: np.ndarray) -> np.ndarray:
    """Union of [start, end) rows as maximal runs, in order."""
    if not len(spans):
        return spans.reshape(0, 2)
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.concatenate([[True], spans[1:, 0] > reach[:-1]])
    cut = np.flatnonzero(new)
    return np.stack([spans[cut, 0], reach[np.append(cut[1:] - 1, len(spans) - 1)]], 1)


def _segment_rows(docs: DataFrame, min_len: int) -> DataFrame:
    """A row per document and distinct segment: h, g, doc, s0, windows, pre, cnt; a document's repeats
    within itself come as one row more with only ``spans``."""
    schema = "h long, g long, doc long, s0 int, windows int, pre int, cnt int, spans binary"

    def rows(ids, where, datas):
        sizes = np.array([len(x) for x in datas], np.int64)
        starts = np.cumsum(sizes) - sizes
        buf = np.frombuffer(b"".join(datas), np.uint8)
        if len(buf) < min_len:
            return
        d, h, g, s0, windows, pre = segments(buf, starts, starts + sizes, min_len)
        if not len(d):
            return
        s0 = s0 + np.array([o for _, o in where])[d]
        row = np.array([k for k, _ in where])[d]
        same = (h.view(U64) * U64(0x9E3779B97F4A7C15)) ^ g.view(U64)
        order = np.lexsort((s0, same, row))
        o_row, o_same = row[order], same[order]
        new = np.concatenate([[True], (o_row[1:] != o_row[:-1]) | (o_same[1:] != o_same[:-1])])
        cut = np.flatnonzero(new)
        count = np.diff(np.append(cut, len(order)))
        one = order[cut]
        more = order[np.repeat(count > 1, count)]
        known, at = [], []
        if len(more):
            for k in np.unique(row[more]):
                m = more[row[more] == k]
                known.append(_cover(np.stack([s0[m], s0[m] + windows[m] - 1 + min_len], 1)).astype(np.int64).tobytes())
                at.append(k)
        total = len(one) + len(known)
        pad = len(known)
        i32 = lambda x: pa.array(np.append(x, np.zeros(pad, np.int64)).astype(np.int32))
        blank = np.arange(total) >= len(one)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(h[one], np.zeros(pad, np.int64)), mask=blank),
             pa.array(np.append(g[one], np.zeros(pad, np.int64)), mask=blank),
             ids.take(pa.array(np.append(row[one], np.array(at, np.int64)).astype(np.int64))),
             i32(s0[one]), i32(windows[one]), i32(pre[one]), i32(count),
             pa.array([None] * len(one) + known, pa.binary())],
            ["h", "g", "doc", "s0", "windows", "pre", "cnt", "spans"])

    def run(batches):
        for b in batches:
            ids, held, where, n = b.column(0), [], [], 0
            for k, text in enumerate(b.column(1)):
                data = (text.as_py() or "").encode("utf-8", "surrogatepass")
                at = 0
                while len(data) - at >= min_len:       # a long text goes on in overlapping pieces
                    part = data[at:at + _BUFFER]
                    if n + len(part) > _BUFFER and held:
                        yield from rows(ids, where, held)
                        held, where, n = [], [], 0
                    held.append(part)
                    where.append((k, at))
                    n += len(part)
                    at += len(part) - min_len + 1
            if held:
                yield from rows(ids, where, held)

    return docs.select("doc", "text").mapInArrow(run, schema)


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffix positions sorted by their first ``depth`` symbols or more (0 beyond the end)."""
    n = len(text)
    key = np.zeros(n, U64)
    padded = np.append(text, np.zeros(8, np.uint16)).astype(U64)
    for j in range(7):
        key = (key << U64(9)) | padded[j:j + n]
    order = np.argsort(key, kind="stable")
    k = key[order]
    rank = np.empty(n, np.int64)
    rank[order] = np.cumsum(np.concatenate([[1], (k[1:] != k[:-1]).astype(np.int64)]))
    done = 7
    while done < depth and rank[order[-1]] < n:
        nxt = np.zeros(n, np.int64)
        nxt[:max(0, n - done)] = rank[done:]
        key = rank * (n + 1) + nxt
        order = np.argsort(key, kind="stable")
        k = key[order]
        rank[order] = np.cumsum(np.concatenate([[1], (k[1:] != k[:-1]).astype(np.int64)]))
        done *= 2
    return order


def repeated(parts: list[bytes], min_len: int) -> list[np.ndarray]:
    """For each part, the starts of ``min_len``-byte strings that also start elsewhere in the parts."""
    sizes = np.array([len(p) for p in parts], np.int64)
    text = (np.frombuffer(b"\0".join(parts) + b"\0", np.uint8).astype(np.uint16) + 1)
    starts = np.cumsum(sizes + 1) - sizes - 1
    text[starts + sizes] = 0                      # separators sort first
    n = len(text)
    order = suffix_order(text, min_len)
    before = text[order - 1]                      # the transform
    by_char = np.argsort(before, kind="stable")
    step = np.empty(n, np.int64)                  # interval ends move along this map
    step[by_char] = np.arange(n)
    fixed = np.zeros(n + 1, bool)                 # common-prefix lengths below min_len, found so far
    fixed[0] = fixed[n] = True
    heads = np.append(0, np.cumsum(np.bincount(text, minlength=257)))
    lo, hi = heads[:-1], heads[1:] - 1
    full = hi >= lo
    lo, hi = lo[full], hi[full]
    fixed[hi + 1] = True
    for _ in range(1, min_len):
        size = hi - lo + 1
        at = np.arange(size.sum()) + np.repeat(lo - (np.cumsum(size) - size), size)
        char = before[at].astype(np.int64)
        some = char > 0
        if some.all():
            key = np.repeat(np.arange(len(lo)), size) * 257 + char
        else:
            at, key = at[some], (np.repeat(np.arange(len(lo)), size) * 257 + char)[some]
        if not len(at):
            break
        if (size > 1).any():
            turn = np.argsort(key, kind="stable")
            key, at = key[turn], at[turn]
        cut = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        lo, hi = step[at[cut]], step[at[np.append(cut[1:], len(at)) - 1]]
        new = ~fixed[hi + 1]
        lo, hi = lo[new], hi[new]
        if not len(lo):
            break
        fixed[hi + 1] = True
    hit = order[~fixed[:-1] | ~fixed[1:]]
    hit.sort()
    part = np.searchsorted(starts, hit, "right") - 1
    good = hit - starts[part] <= sizes[part] - min_len
    hit, part = hit[good], part[good]
    cuts = np.searchsorted(part, np.arange(len(parts) + 1))
    return [hit[a:b] - starts[i] for i, (a, b) in enumerate(zip(cuts, cuts[1:]))]


def _take_bytes(reps: DataFrame, docs: DataFrame, min_len: int) -> DataFrame:
    """(key, doc, at, cnt, lo, hi, body): the bytes of each kept segment."""
    per_doc = reps.groupBy("doc").agg(F.collect_list(F.struct("h", "s0", "windows", "pre", "c")).alias("segs"))
    joined = per_doc.join(docs, "doc").select("doc", "segs", "text")

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 500):
                part = b.slice(at, 500)
                cols: list[list] = [[] for _ in range(7)]
                for doc, segs, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2)):
                    data = (text.as_py() or "").encode("utf-8", "surrogatepass")
                    for s in segs:
                        row = (s["h"], doc, s["s0"], s["c"], s["pre"] - s["windows"] + 1, s["pre"],
                               data[s["s0"]:s["s0"] + s["windows"] - 1 + min_len])
                        for c, v in zip(cols, row):
                            c.append(v)
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                                 ["key", "doc", "at", "c", "lo", "hi", "body"])

    return joined.mapInArrow(run, "key long, doc long, at int, c long, lo int, hi int, body binary")


def _split(rows: DataFrame, min_len: int) -> DataFrame:
    """Halve the range of anchor offsets of each row's key; a row goes where its windows lie.

    (A window's anchor offset is its anchor's place minus its start; lo..hi are those of the row,
    from..to those of the key.)"""
    mid = F.expr("(`from` + `to`) div 2")

    def half(a, b, side: int) -> DataFrame:
        part = rows.withColumns({"f2": a, "t2": b}).withColumns(
            {"l2": F.greatest("lo", "f2"), "h2": F.least("hi", "t2")}).where("l2 <= h2")
        # windows with offsets l2..h2 start at hi - h2 .. hi - l2 within the body
        skip = F.col("hi") - F.col("h2")
        body = F.expr(f"substring(body, hi - h2 + 1, h2 - l2 + {min_len})")
        core = F.expr(f"substring(body, hi - f2 + 1, greatest({min_len} - t2 + f2, 0))")
        return part.select(F.xxhash64("key", F.lit(side), core).alias("key"), "doc", (F.col("at") + skip).alias("at"),
                           F.lit(1).cast("long").alias("c"), F.col("l2").alias("lo"), F.col("h2").alias("hi"),
                           F.col("f2").alias("from"), F.col("t2").alias("to"), body.alias("body"))

    return half(F.col("from"), mid, 0).union(half(mid + 1, F.col("to"), 1))


def _expand(rows: DataFrame, min_len: int, max_text: int) -> DataFrame:
    """(doc, s, e) spans found by interval expansion over whole keys, several keys to a text."""
    def solve(parts: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
        doc, s, e = [], [], []
        for (d, at, _), starts in zip(parts, repeated([p[2] for p in parts], min_len)):
            if len(starts):
                run = _cover(np.stack([starts, starts + min_len], 1)) + at
                doc += [d] * len(run)
                s += run[:, 0].tolist()
                e += run[:, 1].tolist()
        return pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(s, pa.int32()),
                                           pa.array(e, pa.int32())], ["doc", "s", "e"])

    def run(batches):
        held: list[tuple[int, int, bytes]] = []
        n, key = 0, None
        for b in batches:
            for k, d, at, body in zip(*(b.column(i).to_pylist() for i in range(4))):
                if k != key and n > max_text:
                    yield solve(held)
                    held, n = [], 0
                key = k
                held.append((d, at, body))
                n += len(body) + 1
        if held:
            yield solve(held)

    return (rows.select("key", "doc", "at", "body").repartition("key").sortWithinPartitions("key")
            .mapInArrow(run, "doc long, s int, e int"))


ROW = "__row"


def numbered(docs: DataFrame) -> DataFrame:
    """docs with ``__row``, a number per row; written once, as every reading must see the same numbers."""
    return materialize(docs.withColumn(ROW, F.monotonically_increasing_id()))


def repeated_spans(docs: DataFrame, min_len: int = 200, max_group: int = 4_000_000, max_text: int = 1_000_000,
                   text_col: str = "text") -> DataFrame:
    """(doc, spans: array<struct<s, e>>, own) of every row of ``numbered`` documents with repeated bytes; doc is the
    row's number, and the spans may overlap."""
    if min_len < 2 * GRAM:
        raise ValueError(f"min_len must be at least {2 * GRAM}")
    docs = docs.select(F.col(ROW).alias("doc"), F.col(text_col).alias("text"))
    rows = materialize(_segment_rows(docs, min_len))
    segs = rows.where("h is not null")
    often = segs.groupBy("h").agg(F.sum("cnt").alias("tot")).where("tot > 1").select("h")
    shared = materialize(segs.join(often, "h").drop("spans"))
    kinds = materialize(shared.groupBy("h", "g").agg(F.sum("cnt").alias("c"), F.min(F.struct("doc", "s0")).alias("one"),
                                                     F.min("windows").alias("windows"), F.min("pre").alias("pre")))
    span = lambda s, n: F.struct(F.col(s).alias("s"), (F.col(s) + F.col(n) - 1 + min_len).cast("int").alias("e"))
    copies = (shared.join(kinds.where("c > 1").select("h", "g"), ["h", "g"])
              .select("doc", span("s0", "windows").alias("span")))
    several = kinds.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h")
    reps = kinds.join(several, "h").select("h", "one.doc", "one.s0", "windows", "pre", "c")
    work = materialize(_take_bytes(reps, docs, min_len)
                       .withColumns({"from": F.lit(0), "to": F.lit(min_len - GRAM)}))
    found = []
    while True:
        heavy = (work.groupBy("key").agg(F.sum(F.length("body")).alias("n")).where(F.col("n") > max_group)
                 .select("key"))
        found.append(_expand(work.join(heavy, "key", "left_anti"), min_len, max_text))
        big = materialize(_split(work.join(heavy, "key", "left_semi").where("`from` < `to`"), min_len))
        if big.isEmpty():
            break
        body = F.xxhash64("body", "lo", "hi")
        twice = big.groupBy("key", body.alias("x")).agg(F.count(F.lit(1)).alias("m"), F.min(F.struct("doc", "at")).alias("one"))
        twice = materialize(twice.where("m > 1"))
        tagged = big.withColumn("x", body).join(twice, ["key", "x"], "left")
        found.append(tagged.where("m > 1").select(
            "doc", F.col("at").alias("s"), (F.col("at") + F.length("body")).cast("int").alias("e")))
        work = materialize(tagged.where("m is null or one = struct(doc, at)")
                           .select("key", "doc", "at", "c", "lo", "hi", "from", "to", "body"))
    spans = copies
    for f in found:
        spans = spans.union(f.select("doc", F.struct("s", "e").alias("span")))
    own = rows.where("spans is not null").select("doc", F.col("spans").alias("own"))
    return (spans.groupBy("doc").agg(F.collect_list("span").alias("spans"))
            .join(own.groupBy("doc").agg(F.collect_list("own").alias("own")), "doc", "full"))


def _runs(spans, own) -> np.ndarray:
    got = [np.array([(x["s"], x["e"]) for x in spans], np.int64).reshape(-1, 2)] if spans else []
    got += [np.frombuffer(x, np.int64).reshape(-1, 2) for x in own or []]
    return _cover(np.concatenate(got)) if got else np.zeros((0, 2), np.int64)


def digest(docs: DataFrame, min_len: int = 200, id_col: str = "doc_id", text_col: str = "text", **more) -> DataFrame:
    """Per document: id, n_bytes, n_removed, n_spans, kept_sha256."""
    id_type = dict(docs.select(id_col).dtypes)[id_col]
    docs = numbered(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")))
    spans = repeated_spans(docs, min_len, **more)
    joined = docs.join(spans, F.col(ROW) == F.col("doc"), "left").select("id", "text", "spans", "own")

    def run(batches):
        for b in batches:
            out: list[list] = [[], [], [], []]
            for text, spans, own in zip(b.column(1), b.column(2), b.column(3)):
                data = (text.as_py() or "").encode("utf-8", "surrogatepass")
                runs = _runs(spans.as_py(), own.as_py())
                sha, at = hashlib.sha256(), 0
                for s, e in runs.tolist():
                    sha.update(data[at:s])
                    at = e
                sha.update(data[at:])
                for c, v in zip(out, (len(data), int((runs[:, 1] - runs[:, 0]).sum()), len(runs), sha.hexdigest())):
                    c.append(v)
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, pa.int64()) for c in out[:3]),
                                              pa.array(out[3], pa.string())],
                                             [id_col, "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return joined.mapInArrow(run, f"{id_col} {id_type}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def remove(docs: DataFrame, min_len: int = 200, text_col: str = "text", **more) -> DataFrame:
    """The input with repeated bytes cut out of ``text_col``; cuts shrink to whole characters."""
    schema, names = docs.schema, docs.columns
    col, width = names.index(text_col), len(names)
    keyed = numbered(docs)
    spans = repeated_spans(keyed, min_len, text_col=text_col, **more).select(
        F.col("doc").alias("__doc"), F.col("spans").alias("__spans"), F.col("own").alias("__own"))
    joined = keyed.join(spans, F.col(ROW) == F.col("__doc"), "left").select(*names, "__spans", "__own")

    def cut(text: str | None, runs: np.ndarray) -> str | None:
        if text is None or not len(runs):
            return text
        data = text.encode("utf-8", "surrogatepass")
        out, at = [], 0
        for s, e in runs.tolist():
            while s < e and data[s] & 0xC0 == 0x80:
                s += 1
            while e > s and e < len(data) and data[e] & 0xC0 == 0x80:
                e -= 1
            out.append(data[at:s])
            at = e
        return b"".join([*out, data[at:]]).decode("utf-8", "surrogatepass")

    def run(batches):
        for b in batches:
            texts = [cut(t.as_py(), _runs(s.as_py(), o.as_py()))
                     for t, s, o in zip(b.column(col), b.column(width), b.column(width + 1))]
            cols = list(b.columns[:width])
            cols[col] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(cols, names)

    return joined.mapInArrow(run, schema)
