import pickle

import numpy as np

from martcraft.llm import op8_toxicity as o


def sample(n, seed):
    rng = np.random.default_rng(seed)
    common = ["the", "of", "and", "der", "die", "und", "le", "les", "et", "el", "que", "y"]
    texts, y = [], []
    for _ in range(n):
        k = rng.integers(0, 4) * 3
        words = [common[k + rng.integers(0, 3)] if rng.random() < 0.4 else
                 "".join(rng.choice(list("abcdefghij"), rng.integers(3, 9))) for _ in range(rng.integers(20, 60))]
        bad = rng.random() < 0.25
        if bad:
            for _ in range(rng.integers(1, 4)):
                words[rng.integers(0, len(words))] = ["zqvo", "xkwu", "qqzy", "wvxi"][k // 3] + rng.choice(["", "s", "en", "ed,"])
        texts.append(" ".join(words))
        y.append(int(bad))
    return texts, np.array(y)


def test_held_out_accuracy():
    texts, y = sample(900, 1)
    rows = [None] * len(texts)
    for k, b in o.split_words(texts):
        rows[k] = b
    model = pickle.loads(pickle.dumps(o.fit(rows, y)))
    texts, y = sample(500, 2)
    hit = o.scores(model, texts) >= o.CUT
    assert 2 * (hit & (y == 1)).sum() / (hit.sum() + y.sum()) > 0.95


def test_edges(edge, clash, empty, labels):
    for df in (edge, clash):
        model = o.train(df, labels.withColumn("toxic", labels.quality))
        rows = o.score(df, model).collect()
        assert len(rows) == 15 and all(0 <= r.score <= 1 for r in rows)
        assert len({r.score for r in rows if r.doc_id in (6, 7)}) == 1
        clean = o.train(df, labels)          # one class only
        assert o.keep(df, clean).count() == 15 and o.keep(df, clean).schema == df.schema
    assert o.score(empty, o.train(empty, labels)).count() == 0
