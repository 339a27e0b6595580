import collections
import random
import re

from martcraft.llm import op2_minhash as o
from martcraft.llm.components import connected_components

W = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def brute(rows, size):
    """component of every id by testing every pair that shares a shingle."""
    sets = collections.defaultdict(frozenset)
    for i, t in rows:
        w = W.findall((t or "").translate(LOWER))
        s = frozenset(tuple(w[k:k + size]) for k in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else [])
        sets[i] = s if len(s) >= len(sets[i]) else sets[i]
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    where = collections.defaultdict(list)
    for i in sorted(sets, key=lambda x: (x is None, x)):
        both = collections.Counter()
        for s in sets[i]:
            both.update(where[s])
            where[s].append(i)
        for j, n in both.items():
            if 100 * n >= 80 * (len(sets[i]) + len(sets[j]) - n):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in sets}


def check(spark, rows, size, **more):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in o.near_duplicates(df, shingle=size, **more).collect()}
    want = brute([r for r in rows if r[0] is not None], size)
    assert {k: v for k, v in got.items() if k is not None} == want
    return got


def test_sample_table_matches_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    for size in (2, 5):
        check(spark, rows, size)


def test_families_and_branching_of_large_nodes(spark):
    rng = random.Random(5)
    rows, n = [], 0
    for _ in range(2):
        base = [f"w{rng.randint(0, 10**6)}" for _ in range(120)]
        for _ in range(25):
            w = list(base)
            for _ in range(rng.choice([0, 1, 3, 5, 8])):
                w[rng.randrange(len(w))] = f"e{rng.randint(0, 10**6)}"
            rows.append((n, " ".join(w)))
            n += 1
    check(spark, rows, 2, leaf=12, max_depth=12)


def test_nodes_still_large_after_the_last_level_are_compared(spark):
    """A template of 85 %: pairs of strangers are below the threshold, a few twins among them above."""
    rng = random.Random(8)
    base = [f"t{k}" for k in range(340)]
    rows = []
    for i in range(60):
        own = [f"o{i}x{k}" for k in range(60)]
        rows.append((i, " ".join(base + own)))
        if i % 3 == 0:
            rows.append((100 + i, " ".join(base + own[:40] + [f"n{i}x{k}" for k in range(20)])))
    rng.shuffle(rows)
    got = check(spark, rows, 2, trees=10, depth=1, leaf=8, max_depth=1)
    assert all(got[100 + i][1] == i for i in range(0, 60, 3))


def test_edges(spark, edge, clash, empty):
    for df in (edge, clash):
        got = {r.doc_id: r for r in o.near_duplicates(df).collect()}
        assert [got[i].n_shingles for i in (1, 2, 3, 4, 5)] == [0, 0, 0, 1, 1]
        assert got[7].component_id == 6 and not got[7].kept and got[7].n_rows == 2
        assert got[9].component_id == 8 and got[8].kept
        assert len({got[i].component_id for i in (1, 2, 3)}) == 3
        assert len(got) == 14
    assert o.near_duplicates(empty).count() == 0


def test_components_of_paths_and_stars(spark):
    rng = random.Random(2)
    ids = rng.sample(range(1000), 120)
    edges = list(zip(ids[:60], ids[1:61])) + [(ids[70], x) for x in ids[71:110]] + [(5000, 5000)]
    root = {x: min(ids[:61]) for x in ids[:61]} | {x: min(ids[70:110]) for x in ids[70:110]}
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: v for k, v in root.items() if k != v}
