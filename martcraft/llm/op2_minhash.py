"""Operator 2: near-duplicate classes by a chosen-path set-similarity join.

1. Every text becomes a set of word shingles (64-bit hashes); equal sets are one
   class, represented by its smallest id, so copies never meet each other again.
2. Each representative keeps ``COORDS`` minhash values.  ``trees`` independent trees
   branch on them: a node draws one coordinate, or two with probability 1/4 (1.25
   branches on average, 1/similarity), and sends a document on by its value there.
   A pair of similarity 0.8 then expects one shared branch per level; ten trees of
   depth three miss it with probability 0.00004.
3. In every node all documents are compared with the node's smallest id; links are
   confirmed on the full sets of the whole texts and contracted to components.
   This collapses large groups with work linear in their size.
4. Nodes that still hold several components are compared exhaustively across
   components when they have at most ``leaf`` documents; larger ones branch on, now
   into 1.5 nodes on average: a pair of similarity 0.8 then expects 1.2 shared
   branches a level, so what reaches this point is not lost with depth.
   Candidates are confirmed on full sets; the components of all links are the classes.

Minhash agreement only rules out pairs ``SLACK`` below the threshold (3.7 standard
deviations); every link rests on full sets.  Nodes that are still too large after
``max_depth`` levels are compared exhaustively too, in pairs of blocks spread over
tasks: work is quadratic in the documents that are left there.

Nulls and edge cases: a null, empty or blank text has an empty set and is linked
with nothing; a text with fewer words than a shingle is one shingle; rows that repeat
an id are one document (its links are those of all its texts); a null id is never
linked; an empty table gives no rows; other columns of the input are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martcraft.llm.components import connected_components
from martcraft.llm.groups import map_groups
from martcraft.llm.kernel import U64, mix, shingles, word_hashes
from martcraft.session import materialize

COORDS = 128
SLACK = 0.13
_R = np.random.Generator(np.random.PCG64(99))
_XOR = _R.integers(0, 1 << 32, COORDS, dtype=np.uint32)
_MUL = _R.integers(0, 1 << 31, COORDS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def text_set(words: np.ndarray, size: int) -> np.ndarray:
    return np.unique(shingles(words, size))


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One row of COORDS 16-bit minhash values for each non-empty set."""
    flat = np.concatenate(sets)
    x = (flat >> U64(32)).astype(np.uint32)
    at = np.cumsum([0] + [len(s) for s in sets[:-1]])
    out = np.empty((len(sets), COORDS), np.uint16)
    for i in range(COORDS):
        m = np.minimum.reduceat((x ^ _XOR[i]) * _MUL[i], at)
        out[:, i] = (m ^ (m >> np.uint32(16))).astype(np.uint16)
    return out


def _sets(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, n (set size), k1, k2 (order-free hash of the set), sig."""
    def run(batches):
        for b in batches:
            ids, texts = b.column(0), b.column(1).to_pylist()
            n = np.zeros(len(texts), np.int64)
            key = np.zeros((2, len(texts)), np.int64)
            sig: list[bytes | None] = [None] * len(texts)
            held: list[tuple[int, np.ndarray]] = []

            def flush():
                if held:
                    rows = signatures([s for _, s in held])
                    for (k, _), r in zip(held, rows):
                        sig[k] = r.tobytes()
                    held.clear()

            load = 0
            for k, words in word_hashes(texts, lower=True):
                s = text_set(words, size)
                n[k] = len(s)
                if len(s):
                    key[0, k] = np.add.reduce(mix(s ^ U64(0x5851F42D4C957F2D))).astype(np.int64)
                    key[1, k] = np.add.reduce(mix(s + U64(0x14057B7EF767814F))).astype(np.int64)
                    held.append((k, s))
                    load += len(s)
                    if load > 200_000:
                        flush()
                        load = 0
            flush()
            yield pa.RecordBatch.from_arrays([ids, pa.array(n), pa.array(key[0]), pa.array(key[1]),
                                              pa.array(sig, pa.binary())], ["doc_id", "n", "k1", "k2", "sig"])

    return docs.mapInArrow(run, "doc_id long, n long, k1 long, k2 long, sig binary")


def _draws(node: np.ndarray, second: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A node's first coordinate, its second one, and whether it has a second (``second`` quarters of all nodes do)."""
    h = mix(node + U64(0xA0761D6478BD642F))
    return ((h & U64(0xFFFF)) % U64(COORDS)).astype(np.int64), (
        ((h >> U64(16)) & U64(0xFFFF)) % U64(COORDS)).astype(np.int64), (h >> U64(62)) < U64(second)


def grow(node: np.ndarray, row: np.ndarray, sig: np.ndarray, second: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """One level: children (node, row) of every (node, row)."""
    one, two, both = _draws(node, second)
    a = mix(node * U64(0x9FB21C651E98DF25) + (one.astype(U64) << U64(16)) + sig[row, one].astype(U64))
    n2, r2, c2 = node[both], row[both], two[both]
    b = mix(n2 * U64(0x9FB21C651E98DF25) + (c2.astype(U64) << U64(16)) + sig[r2, c2].astype(U64))
    return np.concatenate([a, b]), np.concatenate([row, r2])


def _matrix(col: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), np.uint16).reshape(-1, COORDS)


def _branch_roots(reps: DataFrame, trees: int, depth: int) -> DataFrame:
    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 2000):
                part = b.slice(at, 2000)
                sig, ids = _matrix(part.column(1)), part.column(0).to_numpy()
                row = np.tile(np.arange(len(ids)), trees)
                node = np.repeat(mix(np.arange(1, trees + 1).astype(U64)), len(ids))
                for _ in range(depth):
                    node, row = grow(node, row, sig)
                yield pa.RecordBatch.from_arrays([pa.array(node.view(np.int64)), pa.array(ids[row])], ["node", "doc"])

    return reps.select("doc_id", "sig").mapInArrow(run, "node long, doc long")


def _branch_on(rows: DataFrame, reps: DataFrame) -> DataFrame:
    """One level more of (node, doc)."""
    def run(batches):
        for b in batches:
            sig, ids = _matrix(b.column(2)), b.column(1).to_numpy()
            node, row = grow(b.column(0).to_numpy().view(U64), np.arange(len(ids)), sig, second=2)
            yield pa.RecordBatch.from_arrays([pa.array(node.view(np.int64)), pa.array(ids[row])], ["node", "doc"])

    sigs = reps.select(F.col("doc_id").alias("doc"), "sig")
    return rows.select("node", "doc").join(sigs, "doc").select("node", "doc", "sig").mapInArrow(
        run, "node long, doc long").distinct()


def _near(pairs: DataFrame, reps: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) whose minhash values agree often enough."""
    sa = reps.select(F.col("doc_id").alias("a"), F.col("sig").alias("sa"))
    sb = reps.select(F.col("doc_id").alias("b"), F.col("sig").alias("sb"))
    least = int(np.ceil((threshold - SLACK) * COORDS))

    def run(batches):
        for b in batches:
            same = (_matrix(b.column(2)) == _matrix(b.column(3))).sum(1) >= least
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], ["a", "b"]).filter(pa.array(same))

    return pairs.join(sa, "a").join(sb, "b").select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


def _confirm(pairs: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Pairs (a, b) whose full shingle sets meet 100 * intersection >= percent * union."""
    ta = docs.select(F.col("doc_id").alias("a"), F.col("text").alias("ta"))
    tb = docs.select(F.col("doc_id").alias("b"), F.col("text").alias("tb"))

    def run(batches):
        for b in batches:
            ok = np.zeros(b.num_rows, bool)
            for at in range(0, b.num_rows, 64):
                part = b.slice(at, 64)
                n = part.num_rows
                texts = part.column(2).to_pylist() + part.column(3).to_pylist()
                sets = [text_set(w, size) for _, w in word_hashes(texts, lower=True)]
                for i in range(n):
                    x, y = sets[i], sets[n + i]
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    ok[at + i] = both > 0 and 100 * both >= percent * (len(x) + len(y) - both)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], ["a", "b"]).filter(pa.array(ok))

    return pairs.join(ta, "a").join(tb, "b").select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long")


def _candidates(sig: np.ndarray, comp: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, agreement) of pairs of different components that may be links."""
    i_, j_, n_ = [], [], []
    for i in range(len(sig) - 1):
        same = (sig[i + 1:] == sig[i]).sum(1)
        hit = np.flatnonzero((same >= least) & (comp[i + 1:] != comp[i]))
        i_.append(np.full(len(hit), i))
        j_.append(hit + i + 1)
        n_.append(same[hit])
    return tuple(np.concatenate([np.zeros(0, np.int64), *x]) for x in (i_, j_, n_))


def _across(nodes: DataFrame, reps: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Links (a, b) between components, by exhaustive comparison of each small node (node, doc, comp, block, home).

    Pairs of one block are left to the nodes where it is at home (see _in_blocks).  Minhash values select the documents with any candidate; only their texts are
    fetched, once per document.  A pair is tested in the first node it shares, best
    agreement first, and not if the links found so far already join it."""
    least = int(np.ceil((percent / 100 - SLACK) * COORDS))
    sigs = reps.select(F.col("doc_id").alias("doc"), "sig")
    keep = ["node", "doc", "comp", "block", "home"]

    def pairs(t: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        i, j, n = _candidates(_matrix(t.column("sig")), t.column("comp").to_numpy(), least)
        i, j = i.astype(np.int64), j.astype(np.int64)
        block, home = t.column("block").to_numpy(), t.column("home").to_numpy()
        ok = (block[i] != block[j]) | (home[i] == 1)
        return i[ok], j[ok], n[ok]

    def select(t: pa.Table) -> pa.RecordBatch | None:
        i, j, _ = pairs(t)
        if not len(i):
            return None
        rows = np.unique(np.append(i, j))
        return pa.RecordBatch.from_arrays([pa.array(t.column(c).to_numpy()[rows]) for c in keep], keep)

    some = map_groups(nodes.join(sigs, "doc").select(*keep, "sig"), "node", select,
                      "node long, doc long, comp long, block long, home long")
    # a pair of two blocks meets in one node only: the list needs the nodes of whole leaves and homes
    per_doc = (some.groupBy("doc").agg(F.collect_list(F.struct("node", "block", "home")).alias("at"),
                                       F.collect_set(F.when(F.col("home") == 1, F.col("node"))).alias("nodes"),
                                       F.min("comp").alias("comp"))
               .join(sigs, "doc").join(docs.select(F.col("doc_id").alias("doc"), "text"), "doc"))
    rows = per_doc.select(F.explode("at").alias("at"), "nodes", "doc", "comp", "sig", "text").select(
        "at.node", "at.block", "at.home", "nodes", "doc", "comp", "sig", "text")

    def solve(t: pa.Table) -> pa.RecordBatch | None:
        node, ids, comp = t.column("node")[0].as_py(), t.column("doc").to_numpy(), t.column("comp").to_numpy()
        own = [set(x) for x in t.column("nodes").to_pylist()]
        texts = t.column("text")
        i, j, n = pairs(t)
        block = t.column("block").to_numpy()
        sets: dict[int, np.ndarray] = {}
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while (y := root.get(x, x)) != x:
                root[x] = root.get(y, y)
                x = y
            return x

        def of(k: int) -> np.ndarray:
            if k not in sets:
                sets[k] = text_set(next(w for _, w in word_hashes([texts[k].as_py()], lower=True)), size)
            return sets[k]

        a, b = [], []
        for k in np.argsort(-n, kind="stable").tolist():
            x, y = int(i[k]), int(j[k])
            cx, cy = find(int(comp[x])), find(int(comp[y]))
            if cx == cy or (block[x] == block[y] and min(own[x] & own[y]) != node):
                continue
            both = len(np.intersect1d(of(x), of(y), assume_unique=True))
            if both and 100 * both >= percent * (len(of(x)) + len(of(y)) - both):
                root[cx] = cy
                a.append(ids[x])
                b.append(ids[y])
        if not a:
            return None
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return map_groups(rows, "node", solve, "a long, b long")


def _in_blocks(big: DataFrame, links: DataFrame, reps: DataFrame, docs: DataFrame, size: int, percent: int,
               leaf: int) -> DataFrame:
    """Links (a, b) between components of the nodes that stay large, by exhaustive comparison.

    Nodes that share documents are one family, so that a pair is compared once.  A family is dealt into
    blocks of about half a leaf, and every two blocks are a node; a block is at home in that with its next."""
    near = connected_components(big.select(F.col("pivot").alias("a"), F.col("doc").alias("b")))
    rows = big.select("doc").distinct().join(near.withColumnRenamed("node", "doc"), "doc", "left").select(
        F.coalesce("root", "doc").alias("node"), "doc")
    parts = F.greatest(F.lit(2), F.ceil(2 * F.col("size") / leaf)).cast("long")
    dealt = (_shared(_label(rows, _hooked(links)), "comp").withColumn("parts", parts)
             .withColumn("block", F.expr("pmod(xxhash64(doc), parts)"))
             .withColumn("other", F.explode(F.expr("sequence(0L, parts - 1)"))).where("other <> block"))
    return _across(dealt.select(
        F.xxhash64("node", F.least("block", "other"), F.greatest("block", "other")).alias("node"), "doc", "comp", "block",
        F.expr("cast(other = (block + 1) % parts as long)").alias("home")), reps, docs, size, percent)


def _hooked(links: DataFrame) -> DataFrame:
    """(node, root): each document's least linked id, followed once more.

    Documents with one root are connected; a component may keep several roots, which
    only means that more pairs are compared."""
    low = links.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("root"))
    return low.join(low.select(F.col("node").alias("root"), F.col("root").alias("over")), "root", "left").select(
        "node", F.coalesce("over", "root").alias("root"))


def _label(rows: DataFrame, roots: DataFrame) -> DataFrame:
    return rows.join(roots.withColumnRenamed("node", "doc"), "doc", "left").select(
        "node", "doc", F.coalesce("root", "doc").alias("comp"))


def _shared(rows: DataFrame, by: str) -> DataFrame:
    """Rows of nodes that hold more than one value of ``by``, with the node's size and smallest id."""
    span = rows.groupBy("node").agg(F.min(by).alias("lo"), F.max(by).alias("hi"), F.min("doc").alias("pivot"),
                                    F.count(F.lit(1)).alias("size")).where("lo < hi")
    return rows.join(span.select("node", "pivot", "size"), "node")


def near_duplicates(docs: DataFrame, shingle: int = 2, percent: int = 80, trees: int = 10, depth: int = 3,
                    leaf: int = 4096, max_depth: int = 24, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per id: doc_id, n_shingles, component_id (smallest id reachable), kept, n_rows
    (rows of that id)."""
    threshold = percent / 100
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sets = materialize(_sets(docs, shingle))
    one = sets.groupBy("doc_id").agg(F.max_by(F.struct("n", "k1", "k2"), F.struct("n", "k1", "k2")).alias("s"),
                                      F.count(F.lit(1)).alias("n_rows"))
    classes = one.where("s.n > 0").groupBy("s.k1", "s.k2").agg(F.min("doc_id").alias("rep"))
    reps = materialize(sets.join(classes, [sets.k1 == classes.k1, sets.k2 == classes.k2, sets.doc_id == classes.rep])
                       .select("doc_id", "sig").dropDuplicates(["doc_id"]))

    live = materialize(_shared(_branch_roots(reps, trees, depth), "doc").select("node", "doc", "pivot"))
    links = None
    level = depth
    while True:
        stars = live.where("doc <> pivot").select(F.col("pivot").alias("a"), F.col("doc").alias("b")).distinct()
        found = materialize(_confirm(_near(stars, reps, threshold), docs, shingle, percent))
        links = found if links is None else links.union(found)
        mixed = materialize(_shared(_label(live, _hooked(links)), "comp"))
        small = mixed.where(F.col("size") <= leaf).select("node", "doc", "comp", F.lit(0).cast("long").alias("block"),
                                                          F.lit(1).cast("long").alias("home"))
        links = links.union(materialize(_across(small, reps, docs, shingle, percent)))
        big = mixed.where(F.col("size") > leaf)
        if big.isEmpty():
            break
        if level >= max_depth:
            links = links.union(materialize(_in_blocks(big, links, reps, docs, shingle, percent, leaf)))
            break
        live = materialize(_shared(_branch_on(big, reps), "doc").select("node", "doc", "pivot"))
        level += 1
    roots = connected_components(links)
    class_of = one.join(classes, [one.s.k1 == classes.k1, one.s.k2 == classes.k2], "left").select(
        "doc_id", "n_rows", F.col("s.n").alias("n_shingles"), F.when(F.col("s.n") > 0, F.col("rep")).alias("rep"))
    return (class_of.join(roots.withColumnRenamed("node", "rep"), "rep", "left")
            .select("doc_id", "n_rows", "n_shingles", F.coalesce("root", "rep", "doc_id").alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
            .select("doc_id", "n_shingles", "component_id", "kept", "n_rows"))
