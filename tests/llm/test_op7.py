import numpy as np

from martcraft.llm import op7_quality as o


def sample(n=400, seed=1):
    rng = np.random.default_rng(seed)
    texts, y = [], []
    for _ in range(n):
        words = ["".join(rng.choice(list("abcdef"), rng.integers(2, 8))) for _ in range(rng.integers(30, 90))]
        bad = rng.random() < 0.3
        texts.append(" ".join(w + "###" if bad and rng.random() < 0.8 else w for w in words))
        y.append(not bad)
    return texts, np.array(y, float)


def test_rules_learn_and_the_column_equals_numpy(spark):
    texts, y = sample()
    model = o.fit(o.statistics(texts[:300]), y[:300])
    assert 0 < len(model.rules) < 100
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = np.array([r.score for r in sorted(o.score(df, model).collect())])
    assert ((got >= o.CUT) == (y == 1))[300:].mean() > 0.97
    x = o.statistics(texts)
    raw = model.base + sum(r.weight * o._holds(x, r.parts) for r in model.rules)
    p = 1 / (1 + np.exp(-raw))
    want = np.where(p < model.cut, o.CUT * p / model.cut, o.CUT + (1 - o.CUT) * (p - model.cut) / (1 - model.cut))
    assert np.allclose(got, want)


def test_edges(edge, clash, empty, labels):
    for df in (edge, clash):
        rows = o.score(df, o.train(df, labels)).collect()
        assert len(rows) == 15 and all(0 <= r.score <= 1 for r in rows)
        assert len({r.score for r in rows if r.doc_id in (6, 7)}) == 1
        one = o.train(df, labels.where("quality = 1"))
        assert {r.score for r in o.score(df, one).collect()} != set() and not one.rules
    assert o.score(empty, o.train(empty, labels)).count() == 0
