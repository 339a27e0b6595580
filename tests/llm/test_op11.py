import os
from collections import Counter
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from martcraft.llm import op11_linededup as o

WS = " \t\n\x0b\x0c\r"
AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key(line):
    return line.strip(WS).translate(AZ)


def brute(rows, min_docs, min_chars=1):
    seen = Counter(k for _, t in rows for k in {key(x) for x in (t or "").split("\n")} if len(k) >= min_chars)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (len(key(x)) >= min_chars and seen[key(x)] >= min_docs)]
        out.append((i, len(lines), len(lines) - len(kept), sha256("\n".join(kept).encode()).hexdigest()))
    return out


def same(got, want):
    order = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(map(tuple, got), key=order) == sorted(want, key=order)


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def planted(n=60):
    rows = []
    for i in range(n):
        lines = [f"own line {i}", "Everywhere" if i % 2 else " EVERYWHERE\t", f"pair {i // 2}", "", "Ünï\x0b", f"ten {i % 6}"]
        rows.append((i, "\n".join(lines[i % 3:])))
    return rows


@pytest.mark.parametrize("min_docs, batches", [(10, 3), (1, 1)])
def test_shared_lines_go_however_the_table_is_batched(spark, min_docs, batches):
    rows = planted()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    same(o.digest(df, min_docs=min_docs, batches=batches).collect(), brute(rows, min_docs))


def test_edges(edge, clash, empty):
    for df in (edge, clash):
        same(o.digest(df, min_docs=2, batches=1).collect(), brute(rows_of(df), 2))
    same(o.digest(edge, min_docs=2, min_chars=4, batches=1).collect(), brute(rows_of(edge), 2, 4))
    assert o.digest(empty, batches=1).count() == 0


def test_remove_keeps_columns_and_nulls(clash):
    got = o.remove(clash, min_docs=2, batches=1)
    assert got.schema.names == clash.schema.names and got.count() == clash.count()
    want = Counter((i, n - d, h) for i, n, d, h in brute(rows_of(clash), 2))
    have = Counter()
    for r in got.collect():
        assert (r.text is None) == (r.doc_id == 1) and r.spans == "x"
        text = r.text or ""
        have[r.doc_id, sha256(text.encode()).hexdigest()] += 1
    assert have == Counter((i, h) for i, _, h in want.elements())


def test_copies_of_one_text_are_documents_of_their_own(spark):
    rows = [(i, "same text\nother line") for i in range(9)] + [(100, "same text")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.n_dropped for r in o.digest(df).collect()}
    assert got[0] == 1 and got[100] == 1


def keys(spark, *counts):
    """A batch of keys (k, k) in as many documents as given."""
    return spark.createDataFrame([(k, k) for k, n in counts for _ in range(n)], "h1 long, h2 long")


def test_levels_settled_keys_and_restart(spark, tmp_path):
    path = str(tmp_path / "runs")
    runs = o.LineRuns(spark, path, min_docs=4, buckets=3)
    runs.add(0, keys(spark, (1, 4), (2, 1)))
    assert sorted(runs.runs) == [(0, 0)]
    runs.add(1, keys(spark, (1, 9), (2, 2)))
    # key 1 was settled by the first run: its own run has no row of it
    assert {tuple(r) for r in spark.read.parquet(f"{path}/run-1-1").collect()} == {(2, 2, 2)}
    assert sorted(runs.runs) == [(0, 1)]
    assert {(r.h1, r.n) for r in runs.runs[0, 1].collect()} == {(1, 4), (2, 3)}
    runs.add(2, keys(spark, (2, 1), (3, 3)))
    # another driver goes on in the same folder; a batch added twice counts once
    again = o.LineRuns(spark, path, min_docs=4, buckets=3)
    assert sorted(again.runs) == [(0, 1), (2, 2)]
    again.add(2, keys(spark, (2, 1), (3, 3)))
    again.add(1, keys(spark, (3, 9)))
    assert {r.h1 for r in again.frequent().collect()} == {1, 2}
    again.add(3, keys(spark, (3, 1)))
    assert sorted(again.runs) == [(0, 3)]
    assert {r.h1 for r in again.frequent().collect()} == {1, 2, 3}
    # one file a bucket, sorted by key
    files = [f for f in os.listdir(f"{path}/run-0-3") if f.endswith(".parquet")]
    assert len(files) <= 3


def test_a_batch_joins_the_runs_without_shuffling_them(spark, tmp_path):
    runs = o.LineRuns(spark, str(tmp_path / "r"), min_docs=2, buckets=4)
    runs.add(0, keys(spark, (1, 2), (2, 1)))
    fresh = keys(spark, (1, 1), (5, 2)).groupBy(*o.KEY).agg(F.count(F.lit(1)).alias("n")).repartition(4, *o.KEY)
    plan = fresh.join(runs.runs[0, 0].select(*o.KEY).hint("merge"), o.KEY, "left_anti")._jdf.queryExecution().toString()
    plan = plan[plan.index("Physical Plan"):]
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan and plan.count("Exchange hashpartitioning") <= 2
    assert spark.catalog.listTables() == [] or not any(t.name.startswith("line_run") for t in spark.catalog.listTables())
