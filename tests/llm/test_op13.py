import zlib
from hashlib import sha256

import pytest

from martcraft.llm import op13_merkle as o


def H(s):
    return sha256(s.encode()).hexdigest()


def leaf(row):
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def levels(digests):
    out = [digests]
    while len(out[-1]) > 1:
        out.append([H("".join(out[-1][i:i + 3])) for i in range(0, len(out[-1]), 3)])
    return out


def brute(rows):
    """Rows (doc_id, source, lang, n_chars, text) -> the contract's rows, by whole lists of digests."""
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        groups[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[s] = levels([leaf(r) for r in groups[s]])
    top = levels([trees[s][-1][0] for s in order])
    out = []
    for k, s in enumerate(order):
        for i, r in enumerate(groups[s]):
            now, proof = r, ""
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None:
                now = (*r[:4], r[4].replace("\n", ""))
            cur = leaf(now)
            for tree, at in ((trees[s], i), (top, k)):
                for nodes in tree[:-1]:
                    run = nodes[at // 3 * 3:at // 3 * 3 + 3]
                    proof += "".join(run[:at % 3] + run[at % 3 + 1:])
                    cur = H("".join(run[:at % 3] + [cur] + run[at % 3 + 1:]))
                    at //= 3
            out.append((r[0], leaf(r), trees[s][-1][0], top[-1][0], H(proof), cur, cur == top[-1][0]))
    return out


def same(got, want):
    key = lambda r: (r[0] is not None, r[0] or 0, *r[1:])
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def fields(df):
    return [tuple(r) for r in df.select(*o.FIELDS).collect()]


@pytest.mark.parametrize("span", [2, 7])
def test_many_levels_of_blocks(spark, span):
    sizes = {None: 1, "a": 40, "b": 3, "é": 10, "z": 82}
    rows, i = [], 0
    for source, n in sizes.items():
        for _ in range(n):
            rows.append((i * 7 % 1000, source, "en", i, f"line {i}\nend" if i % 3 else f"one line {i}"))
            i += 1
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(5)
    same(o.verify(df, levels=span).collect(), brute(rows))


def test_many_groups(spark):
    rows = [(i, f"s{i // 2}", None, None, "x\n") for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    same(o.verify(df, levels=1).collect(), brute(rows))


def test_edges(spark, edge, empty):
    same(o.verify(edge).collect(), brute(fields(edge)))
    nulls = spark.createDataFrame([(None,) * 5, (None,) * 5, (4, None, None, None, None)],
                                  "doc_id long, source string, lang string, n_chars long, text string")
    same(o.verify(nulls).collect(), brute([(None,) * 5, (None,) * 5, (4, None, None, None, None)]))
    assert o.verify(empty).count() == 0
    one = edge.where("doc_id = 4")
    got = o.verify(one).first()
    assert got.leaf == got.subroot == got.root and got.proof_sha256 == H("") and got.verified


def test_clashing_names(edge, spark):
    from pyspark.sql import functions as F
    extra = edge.select("*", *(F.lit(9).alias(c) for c in ("id", "grp", "pos", "n", "digest", "forged", "block", "path",
                                                            "leaf", "root", "grp_key", "up", "above")))
    same(o.verify(extra).collect(), brute(fields(edge)))


def test_versions_share_untouched_nodes():
    n = 25
    old = o.grow([H(str(i)) for i in range(n)], o.height(n))
    new = o.put(old, 13, 3, "f" * 64)
    seen, copied = {id(x) for x in walk(old)}, 0
    for node in walk(new):
        copied += id(node) not in seen
    assert copied == o.height(n) + 1 and new.digest != old.digest
    assert o.climb("f" * 64, o.steps(old, 13, 3)) == new.digest
    assert o.put(old, 13, 3, H("13")).digest == old.digest


def walk(node):
    yield node
    for k in node.kids:
        yield from walk(k)


def test_proofs_and_manifest(edge):
    tree = o.build(edge, **o.without_line_breaks(edge))
    for r in o.audit(tree, with_proof=True).collect():
        assert H("".join(r.proof)) == r.proof_sha256 and all(len(d) == 64 for d in r.proof)
    assert sum(r.n for r in tree.groups.collect()) == edge.count()
    assert {r.subroot for r in tree.groups.collect()} == {r[2] for r in brute(fields(edge))}
