import collections
import hashlib
import random

from martcraft.llm import op5_suffix as o
from tests.llm.conftest import PASSAGE


def brute(rows, size):
    data = [(i, (t or "").encode()) for i, t in rows]
    seen = collections.Counter(b[k:k + size] for _, b in data for k in range(len(b) - size + 1))
    out = collections.Counter()
    for i, b in data:
        runs = []
        for k in range(len(b) - size + 1):
            if seen[b[k:k + size]] > 1:
                if runs and runs[-1][1] >= k:
                    runs[-1][1] = k + size
                else:
                    runs.append([k, k + size])
        kept, at = b"", 0
        for s, e in runs:
            kept, at = kept + b[at:s], e
        kept += b[at:]
        out[(i, len(b), len(b) - len(kept), len(runs), hashlib.sha256(kept).hexdigest())] += 1
    return out


def check(df, rows, size=200, **more):
    got = collections.Counter(tuple(r) for r in o.digest(df, size, **more).collect())
    assert got == brute(rows, size)


def test_repeated_matches_brute_force():
    rng = random.Random(1)
    for _ in range(80):
        size = rng.choice([3, 5, 8])
        parts = [bytes(rng.choice(b"ab\x00\xff") for _ in range(rng.randint(0, 40))) for _ in range(rng.randint(1, 8))]
        seen = collections.Counter(p[i:i + size] for p in parts for i in range(len(p) - size + 1))
        assert [x.tolist() for x in o.repeated(parts, size)] == [
            [i for i in range(len(p) - size + 1) if seen[p[i:i + size]] > 1] for p in parts]


def test_sample_table_with_and_without_split_keys(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in df.collect()]
    check(df, rows)
    check(df, rows, max_group=1500, max_text=20_000)


def test_a_hot_line_in_changing_context_is_split(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdef") for _ in range(9))
    line = " ".join(word() for _ in range(17))
    rows = [(i, " ".join([*(word() for _ in range(30)), line, rng.choice(["x", "yy", "zzz"]) * 20, *(word() for _ in range(30))]))
            for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    check(df, rows, max_group=3000)


def test_edges(edge, clash, empty):
    ids = [(r.doc_id, r.text) for r in edge.collect()]
    for df in (edge, clash):
        check(df, ids)
    assert o.digest(empty).count() == 0


def test_remove_keeps_columns_and_whole_characters(edge, clash):
    for df in (edge, clash):
        got = o.remove(df)
        assert got.schema == df.schema
        texts = {r.doc_id: r.text for r in got.collect()}
        assert texts[1] is None and texts[5] == "" and texts[8] != "" and texts[4] == "one"
        assert texts[10].startswith("before") and texts[10].endswith("after") and PASSAGE not in texts[10]


def test_cuts_do_not_break_characters(spark):
    body = "é" * 150
    df = spark.createDataFrame([(1, "a" + body), (2, "b" + body)], "doc_id long, text string")
    assert {r.text for r in o.remove(df, 201 // 2 * 2 + 1).collect()} <= {"a", "b", "aé", "bé"}


def long_passage(seed, n=90):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(8)) for _ in range(n))


def test_rows_with_null_and_repeated_ids_are_documents_of_their_own(spark):
    shared, own = long_passage(1), long_passage(2, 100)
    rows = [(None, "start " + shared), (None, shared + " end"), (1, "one " + shared), (2, shared + " two"),
            (1, own), (3, long_passage(3)), (3, None), (None, None), (None, own[:150])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    check(df, rows)
    got = o.digest(df).where("n_removed > 0").collect()
    assert len(got) == 4 and {r.n_removed for r in got} <= set(range(len(shared) - 1, len(shared) + 3))
    # the second text of id 1 occurs nowhere else and keeps every character
    kept = sorted((r.text or "") for r in o.remove(df).collect())
    assert own in kept and sum(shared[10:-10] in t for t in kept) == 0


def test_ids_of_any_type(spark):
    shared = long_passage(4)
    rows = [("a/1", shared), ("b:2", "x" + shared), (None, "other")]
    df = spark.createDataFrame(rows, "doc_id string, text string")
    check(df, rows)
    assert o.digest(df).schema["doc_id"].dataType.simpleString() == "string"
