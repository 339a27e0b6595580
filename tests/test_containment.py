"""Containment by grams and lengths (JN11, JN12)."""

import random
import time

from martcraft.operators.containment import candidate_parts, word_index
from martcraft.plans import cost as CO


def _pairs(spark, texts, words):
    t = spark.createDataFrame([(x,) for x in texts], "t string")
    w = spark.createDataFrame([(x,) for x in words], "w string")
    return {(r.t, r.part) for r in candidate_parts(t, "t", word_index(w, "w")).collect()}


def test_every_contained_word_is_found(spark):
    rng = random.Random(1)
    make = lambda chars, lo, hi: "".join(rng.choice(chars) for _ in range(rng.randint(lo, hi)))
    words = {make("ab가", 1, 6) for _ in range(60)} | {"", "🙂a"}
    texts = {make("ab가🙂", 0, 30) for _ in range(200)} | {None}
    got = _pairs(spark, texts, words)
    want = {(t, w) for t in texts if t for w in words if w and w in t}
    assert {(t, p) for t, p in got if p in words} == want


def test_scopes_are_kept_apart(spark):
    texts = spark.createDataFrame([(1, "red wine"), (2, "red wine")], "g int, t string")
    words = spark.createDataFrame([(1, "red"), (2, "wine")], "g int, w string")
    got = {(r.g, r.part) for r in candidate_parts(texts, "t", word_index(words, "w", ("g",)), ("g",)).collect()}
    assert got == {(1, "red"), (2, "wine")}


def test_a_very_long_name(spark):
    rng = random.Random(2)
    name = "".join(rng.choice("abcdefgh") for _ in range(20_000))
    rows = [(name[i * 37:i * 37 + 5 + i % 20], i) for i in range(300)]
    groups = CO.product_groups(spark.createDataFrame(rows, "grp string, row_no int"), CO.CostConfig())
    names = spark.createDataFrame([(name,), ("abc",)], "pn string")
    CO.group_of(names, groups).collect()
    began = time.time()
    got = CO.group_of(names, groups).collect()
    longest = max((r for r in rows), key=lambda r: (len(r[0]), -r[1]))[0]
    assert [(r.pn, r.grp) for r in got] == [(name, longest)]
    assert time.time() - began < 20         # every substring of it would be 200 million rows
