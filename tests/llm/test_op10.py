import itertools

import numpy as np

from martcraft.llm import op10_lines as o
from martcraft.llm.linestats import analyse


def test_viterbi_is_the_best_labelling():
    rng = np.random.default_rng(0)
    field = o.Field(rng.normal(size=(3, 2)).astype(np.float32), rng.normal(size=(2, 2)))
    of = np.repeat([0, 2, 3], [4, 1, 6])
    x = rng.normal(size=(len(of), 3)).astype(np.float32)
    got = o.viterbi(field, x, of, 5)
    for t in (0, 2, 3):
        rows = np.flatnonzero(of == t)
        score = x[rows] @ field.emit
        best = max(itertools.product((0, 1), repeat=len(rows)), key=lambda y: sum(
            score[i, y[i]] for i in range(len(rows))) + sum(field.move[a, b] for a, b in zip(y, y[1:])))
        assert tuple(got[rows].tolist()) == best


def test_field_learns_junk_lines():
    good = "The plain words of a text go on in a line.\nAnd one more line of it."
    bad = "A### b%%% c$$$ d*** e&&&\nx### y%%% z$$$"
    texts, y = [good, bad, good + "\n" + good, bad + "\n" + bad] * 10, np.array([1, 0, 1, 0] * 10)
    (_, s), = analyse(texts)
    field = o.fit(o.line_features(s), s.line_of, y[s.line_of])
    label = o.viterbi(field, o.line_features(s), s.line_of, len(texts))
    assert (label == y[s.line_of]).all()


def test_judge_and_keep_over_edges(edge, clash, empty, labels):
    for df in (edge, clash):
        field = o.train(df, labels)
        rows = o.judge(df, field).collect()
        assert len(rows) == 15
        by = {r.doc_id: r for r in rows}
        assert by[1].n_words == by[2].n_words == by[3].n_words == 0 and by[1].base_failed and not by[1].kept
        assert by[5].n_repeat_words == 30_000 and by[5].base_failed
        assert by[6].n_dup_lines == 0 and by[6].n_words == 6
        kept = o.keep(df, field)
        assert kept.schema == df.schema
        assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in rows if r.kept)
    assert o.judge(empty, o.train(empty, labels)).count() == 0
