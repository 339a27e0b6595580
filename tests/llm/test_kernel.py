import random
import re

from martcraft.llm import kernel
from martcraft.llm.linestats import analyse

W = re.compile(r"[^\x20\x09-\x0D]+")


def texts():
    rng = random.Random(3)
    words = ["a", "b", "É", "x|", "#1", "\u00a0", "zz!"]
    out = [None, "", " \n ", "a b\na b\r\na b\n\na b", "a" * 3_000_000 + "\nb b\nb b", "w " * 1_500_000]
    for _ in range(200):
        out.append("".join(rng.choice(words) + rng.choice([" ", "\n", "  ", "\t"]) for _ in range(rng.randint(0, 60))))
    return out


def test_word_hashes_agree_exactly_when_words_do():
    seen, back = {}, {}
    for k, h in kernel.word_hashes(texts()):
        found = W.findall(texts()[k] or "") if k > 5 else None
        if found is None:
            continue
        assert len(found) == len(h)
        for w, x in zip(found, h.tolist()):
            assert seen.setdefault(w, x) == x and back.setdefault(x, w) == w


def test_shingles_short_and_long():
    rows = dict(kernel.word_hashes(["a", "a b", "a b a b", "b a", ""], lower=True))
    assert len(kernel.shingles(rows[0], 2)) == 1 and len(kernel.shingles(rows[4], 2)) == 0
    ab = kernel.shingles(rows[1], 2)[0]
    assert kernel.shingles(rows[2], 2).tolist()[0] == kernel.shingles(rows[2], 2).tolist()[2]
    assert kernel.shingles(rows[3], 2)[0] != ab


def test_line_counts_match_plain_python():
    ts = texts()
    got = []
    for _, s in analyse(ts):
        got += list(zip(s.n_words.tolist(), s.total["chars"].tolist(), s.total["symbols"].tolist(),
                        s.n_dup_lines.tolist(), s.n_repeat_words.tolist(), s.n_distinct.tolist()))
    for t, g in zip(ts, got):
        t = t or ""
        w = W.findall(t)
        seen, dup = set(), 0
        for line in t.split("\n"):
            if W.search(line):
                dup += line in seen
                seen.add(line)
        at = {}
        for i in range(len(w) - 7):
            at.setdefault(tuple(w[i:i + 8]), []).append(i)
        cover = {j for v in at.values() if len(v) > 1 for i in v for j in range(i, i + 8)}
        assert g == (len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), dup, len(cover), len(set(w)))
