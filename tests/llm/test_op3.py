import collections
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from martcraft.llm import op3_packing as o

PATH = public_tokenizers.path("word_bpe_49k.json")


def check(df, size=4096, **more):
    tok = Tokenizer.from_file(PATH)
    rows = o.pack(df, PATH, size=size, with_ids=True, **more).collect()
    want = collections.Counter()
    for r in df.select("doc_id", "text").collect():
        want[(r.doc_id, tuple([*tok.encode(r.text or "", add_special_tokens=False).ids, 2]))] += 1
    windows, pieces = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        assert r.length == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        windows[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append((r.start, r.doc_tokens, r.ids))
    unused = 0
    for w in windows.values():
        at = 0
        for offset, n in sorted(w):
            assert offset == at
            at += n
        assert at <= size
        unused += 0 if at & (at - 1) == 0 else size - at
    counts = collections.Counter(k for k, n in want.items() for _ in range(n))
    for (doc, ids), n in counts.items():
        total = sum(len(p[2]) for p in pieces[doc])
        assert total == sum(len(i) * m for (d, i), m in counts.items() if d == doc)
        if sum(m for (d, _), m in counts.items() if d == doc) == 1:
            assert [x for p in sorted(pieces[doc]) for x in p[2]] == list(ids)
            assert all(p[1] == len(ids) for p in pieces[doc])
    return unused, rows


def test_sample_table_is_packed_without_padding(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert check(df)[0] == 0
    assert check(df, size=64, max_open=4)[0] == 0


def test_edges(edge, clash, empty):
    for df in (edge, clash):
        unused, rows = check(df)
        assert unused == 0 and {r.doc_tokens for r in rows if r.doc_id in (1, 2, 3)} == {1}
    assert o.pack(empty, PATH).count() == 0


def test_level_choice_minimises_the_sum_of_squares():
    rng = np.random.default_rng(0)
    p = o.SumOfSquares(16, 1000)
    counts = [0] * 17
    for n in rng.integers(1, 17, 300).tolist():
        best = None
        for h in range(17 - n):
            if h and not counts[h]:
                continue
            c = list(counts)
            if h:
                c[h] -= 1
            if h + n < 16:
                c[h + n] += 1
            cost = sum(x * x for x in c)
            best = min(best or (cost, c), (cost, c), key=lambda x: x[0])
        p.add(0, 0, b"\0" * 4 * n)
        counts = [len(b) for b in p.bins]
        assert sum(x * x for x in counts[1:16]) == best[0]
