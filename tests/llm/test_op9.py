import collections
import hashlib
import math
import random
import re
import struct

import pytest
import xxhash

from martcraft.llm import op9_imatch as o


def check(df, rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""), reverse=True)
    want = []
    for k, (i, t) in enumerate(order):
        t, nxt = t or "", order[(k + 1) % len(order)][1] or ""
        n = len(t) // 3
        want.append((i, len(t), hashlib.sha256((t[:len(t) - n] + nxt[:n]).encode()).hexdigest()))
    got = o.compare_with_edits(df, o.lexicon(df)).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    assert sorted((tuple(r)[:3] for r in got), key=key) == sorted(want, key=key)
    text = {}
    for r in got:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert (r.near_edited == 1) >= (r.fingerprint == r.edited_fingerprint)
        text[r.doc_id] = r
    return text


def test_sample_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = check(df, [(r.doc_id, r.text) for r in df.collect()])
    edited = sum(r.near_edited for r in got.values()) / len(got)
    assert edited > 0.25 and edited > 10 * sum(r.near_next for r in got.values()) / len(got)
    by_text = {}
    for r in df.collect():
        by_text.setdefault(r.text, set()).add(got[r.doc_id].fingerprint)
    assert max(map(len, by_text.values())) == 1


@pytest.mark.parametrize("ids", [[5], [3, 9], [-70, 0, 64, 10**7, 10**7 + 1, 10**12], list(range(300))])
def test_next_documents_over_sparse_and_dense_ids(spark, ids):
    rng = random.Random(1)
    rows = [(i, f"text {i} " + "é" * rng.randint(0, 5)) for i in ids]
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), rows)


def test_edges(edge, clash, empty):
    rows = [(r.doc_id, r.text) for r in edge.collect()]
    for df in (edge, clash):
        got = check(df, rows)
        assert got[6].fingerprint == got[7].fingerprint and got[7].near_next == 1
    assert o.compare_with_edits(empty, o.lexicon(empty)).count() == 0


def test_fingerprints_agree_and_no_python_in_the_plan(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    lex = o.lexicon(df)
    pairs = o.compare_with_edits(df, lex)
    one = {r.doc_id: r.fingerprint for r in o.fingerprints(df, lex).collect()}
    assert one == {r.doc_id: r.fingerprint for r in pairs.collect()}
    plan = pairs._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "ArrowEval", "Pandas"))


def test_copies_count_once_in_the_lexicon(spark):
    rng = random.Random(3)
    pool = [f"term{i}" for i in range(400)]
    texts = [" ".join(rng.sample(pool, 40)) for _ in range(200)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(1000 + 2 * i, texts[0]) for i in range(150)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    once = spark.createDataFrame(rows[:200], "doc_id long, text string")
    assert {r.term for r in o.lexicon(df).collect()} == {r.term for r in o.lexicon(once).collect()}
    got = o.compare_with_edits(df, o.lexicon(df)).where("doc_id = 0").first()
    assert not got.fingerprint.startswith("w:") and got.near_edited > 0


def test_every_lexicon_term_reaches_the_fingerprint(spark):
    rng = random.Random(4)
    pool = [f"term{i}" for i in range(6000)]
    long = rng.sample(pool, 3000)
    rest = sorted(set(pool) - set(long))
    docs = [(0, " ".join(long))]
    for k in range(1, 13):                                     # one term changed in each
        w = list(long)
        w[k * 200] = rest[k]
        docs.append((k, " ".join(w)))
    # every term is in two of 20 other texts, well inside the band
    for i in range(20):
        docs.append((100 + i, " ".join(pool[(i % 10) * 600:(i % 10 + 1) * 600] + [f"own{i}"])))
    lex = o.lexicon(spark.createDataFrame(docs, "doc_id long, text string"), hi=1.0)
    got = {r.doc_id: r.fingerprint for r in o.fingerprints(spark.createDataFrame(docs[:13], "doc_id long, text string"), lex).collect()}
    assert len(set(got.values())) == 13
    wide = {i: [f.split(":")[1][:16], *(f.split(":")[1][16 + 4 * j:20 + 4 * j] for j in range(o.WIDE))] for i, f in got.items()}
    assert all(a != b for i in range(1, 13) for a, b in [(wide[0][0], wide[i][0])])
    assert any(wide[0][j] == wide[i][j] for i in range(1, 13) for j in range(1, o.WIDE + 1))
    pairs = o.compare_with_edits(spark.createDataFrame(docs[:13], "doc_id long, text string"), lex).collect()
    assert all(0.5 < r.near_next < 1 for r in pairs)


# ------------------------------------------------------------ plain recomputation
def xx(data, seed):
    return xxhash.xxh64_intdigest(data, seed % 2**64)


def signed(v):
    return v - 2**64 if v >= 2**63 else v


def plain_words(text):
    return list(dict.fromkeys(w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").lower()) if w))


def plain_print(text, lex):
    ws = plain_words(text)
    base = min(40, int(math.log2(len(ws) + 1.0)) + 1)
    near, far, wide, whole = [0] * 64, [0] * 64, [0] * (o.WIDE + 1), 42
    held = [t for t in (xx(w.encode(), 42) for w in ws) if t in lex]
    for t in held:
        u = xx(struct.pack("<i", 9), xx(struct.pack("<Q", t), 42))
        for places, bits in ((near, base), (far, base + 1)):
            if u % 2**bits < 64:
                places[u % 2**bits] ^= t & 0xFFFF
        wide[0] ^= t
        for i in range(o.WIDE):
            if u >> (48 + 2 * i) & 3:
                wide[i + 1] ^= t >> 16 * (i % 4) & 0xFFFF
    for w in ws:
        whole = xx(w.encode(), whole)
    return {"base": base, "near": near, "far": far, "wide": wide, "terms": len(held), "whole": whole}


def plain_text(p):
    if not p["terms"]:
        return f"w:{p['whole']:X}"
    four = lambda xs: "".join(f"{x:04X}" for x in xs)
    return f"{p['base']:02d}:{p['wide'][0]:016X}{four(p['wide'][1:])}:{four(p['near'])}{four(p['far'])}"


def plain_likeness(a, b):
    if not a["terms"] or not b["terms"]:
        return float(a["whole"] == b["whole"])
    if abs(a["base"] - b["base"]) > 1:
        return 0.0
    x = a["far"] if a["base"] < b["base"] else a["near"]
    y = b["far"] if b["base"] < a["base"] else b["near"]
    used = [(p, q) for p, q in zip(x, y) if p or q]
    every = a["wide"][0] == b["wide"][0]
    wide = sum(p == q for p, q in zip(a["wide"][1:], b["wide"][1:]))
    return max((sum(p == q for p, q in used) + every) / (len(used) + 1), (wide + every) / (o.WIDE + 1.0))


def test_fingerprints_and_likeness_equal_a_plain_recomputation(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = sorted(((r.doc_id, r.text or "") for r in df.collect()), reverse=True)
    distinct = {t for _, t in rows}
    df_of = collections.Counter(xx(w.encode(), 42) for t in distinct for w in plain_words(t))
    lex = {t for t, n in df_of.items() if max(2.0, o.LO * len(distinct)) <= n <= max(2.0, o.HI * len(distinct))}
    found = o.lexicon(df)
    assert {r.term % 2**64 for r in found.collect()} == lex
    got = {r.doc_id: r for r in o.compare_with_edits(df, found).collect()}
    for k, (i, t) in enumerate(rows):
        nxt = rows[(k + 1) % len(rows)][1]
        n = len(t) // 3
        own, edit, after = (plain_print(x, lex) for x in (t, t[:len(t) - n] + nxt[:n], nxt))
        r = got[i]
        assert r.fingerprint == plain_text(own) and r.edited_fingerprint == plain_text(edit)
        assert r.near_edited == pytest.approx(plain_likeness(own, edit), abs=1e-12)
        assert r.near_next == pytest.approx(plain_likeness(own, after), abs=1e-12)


def test_many_rows_without_an_id_do_not_share_a_block(spark):
    rows = [(None, f"nameless text {i}") for i in range(300)] + [(i, f"named {i}") for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    seq = o.with_next(df, "doc_id", "text")
    assert max(r["count"] for r in seq.groupBy("block").count().collect()) < 130
    follows = {r.text: r.after for r in seq.where("not extra").collect()}
    # one cycle through all rows, ids first in descending order
    assert [follows[f"named {i}"] for i in range(19, 0, -1)] == [f"named {i}" for i in range(18, -1, -1)]
    seen, at = [], "named 19"
    for _ in rows:
        seen.append(at)
        at = follows[at] or "named 19"
    assert len(set(seen)) == len(rows)
