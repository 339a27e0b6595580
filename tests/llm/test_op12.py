import math
import re

import numpy as np
import pytest

from martcraft.llm import op12_search as o

AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    return TERM.findall((text or "").translate(AZ))


def brute(docs, items, k=10):
    texts = [(i, words(t)) for i, t in docs]
    texts = [(i, w) for i, w in texts if w]
    n_docs, n_terms = len(texts), sum(len(w) for _, w in texts)
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(words(t))
    out = []
    for item, ts in wanted.items():
        df = {t: sum(t in w for _, w in texts) for t in ts}
        scored = []
        for i, w in texts:
            m, s = 10 + 90 * len(w) * n_docs // n_terms, 0
            for t in ts & set(w):
                tf = w.count(t)
                s += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * tf // (1000 * tf + 8 * m))
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(scored, key=lambda x: x[:3])[:k])]
    return out


def same(got, want):
    order = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(map(tuple, got), key=order) == sorted(want, key=order)


def frames(spark, docs, items):
    return (spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
            spark.createDataFrame(items, "item_id long, text string"))


@pytest.mark.parametrize("more", [{}, {"block_items": 3, "block_docs": 16}])
def test_equals_scoring_everything(spark, more):
    rng = np.random.default_rng(5)
    # frequent and rare words, and an item with more than 64 terms
    texts = [" ".join(f"w{int(x)}" for x in np.minimum(rng.zipf(1.3, rng.integers(1, 60)), 300)) for _ in range(300)]
    docs = [(i, t) for i, t in enumerate(texts)] + [(900 + i, texts[i]) for i in range(40)]
    items = [(j, texts[int(rng.integers(300))]) for j in range(8)] + [(50, " ".join(f"w{i}" for i in range(1, 200)))]
    same(o.search(*frames(spark, docs, items), **more).collect(), brute(docs, items))


def test_ties_repeated_ids_and_nulls(spark):
    docs = [(i % 20, "alpha Beta") for i in range(60)] + [(None, "alpha beta"), (3, None), (4, ""), (5, " .,-! "), (6, "ALPHA")]
    items = [(1, "alpha"), (1, "beta gamma"), (2, None), (3, "..."), (4, "nowhere"), (None, "Alpha!"), (7, "")]
    same(o.search(*frames(spark, docs, items)).collect(), brute(docs, items))
    same(o.search(*frames(spark, docs[60:], items), k=3).collect(), brute(docs[60:], items, 3))


def test_edges(spark, edge, clash, empty):
    items = [(1, "Shared3 passage4 word7"), (2, "日本語 ▁ x́ 🙂🙂 àé"), (3, "echo text"), (4, "yy y")]
    rows = [(r.doc_id, r.text) for r in edge.collect()]
    wanted = frames(spark, rows, items)[1]
    for df in (edge, clash):
        same(o.search(df, wanted).collect(), brute(rows, items))
    assert o.search(empty, wanted).count() == 0
    got = o.search(edge, wanted.where("item_id < 0"))
    assert got.count() == 0 and got.columns == ["item_id", "rank", "doc_id", "score"]


def test_most_masks_are_not_evaluated(spark):
    """Documents with fewer of the item's terms are grouped away, the best ones are found."""
    import pyarrow as pa
    rng = np.random.default_rng(1)
    n, size = 4000, 12
    held = [np.flatnonzero(rng.random(size) < 0.3).astype(np.int32) for _ in range(n)]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(np.arange(n)), pa.array(np.full(n, 10)), pa.array([h.tobytes() for h in held]),
         pa.array([np.ones(len(h), np.int32).tobytes() for h in held])], ["doc", "n", "terms", "tfs"])
    block = o._Block(batch, np.full(size, 100), n, 10 * n)
    seen, exact = [], block.scores
    block.scores = lambda docs, *a: seen.append(len(docs)) or exact(docs, *a)
    best = o._Best(10)
    block.search(np.arange(size), best)
    top = sorted(((-len(h), i) for i, h in enumerate(held)))[:10]
    assert best.id.tolist() == [i for _, i in top] and sum(seen) < n / 10
