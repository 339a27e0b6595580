import corpus_pipeline
from martcraft.llm import op2_minhash, op5_suffix
from tests.llm.test_op2 import brute as near_brute
from tests.llm.test_op3 import check as packed
from tests.llm.test_op5 import brute as span_brute

SF = "/root/testdata/sf0.001"


def test_stages_in_a_row(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r.doc_id: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality_rules", "near_dedup", "suffix_dedup", "packing"]
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, SF)
        assert after.schema == docs.schema
        rows = [(r.doc_id, r.text) for r in before.collect()]
        got = {r.doc_id: r.text for r in after.collect()}
        if name in ("toxicity", "quality_rules"):
            clean = [i for i, _ in rows if i in labels and labels[i].quality == 1 and labels[i].toxic == 0]
            assert sum(i in got for i in clean) >= 0.9 * len(clean)
        elif name == "near_dedup":
            assert set(got) == {i for i, (_, c) in near_brute(rows, 5).items() if i == c}
        else:
            want = {r[0]: r[2] for r in span_brute(rows, 200)}
            for i, t in rows:
                assert 0 <= want[i] - (len(t.encode()) - len(got[i].encode())) <= 6 * t.count(" ") + 6
        before = spark.createDataFrame(after.collect(), docs.schema)
    assert packed(before)[0] == 0


def test_run_gives_every_kept_document(spark):
    pieces = corpus_pipeline.run(spark, SF)
    assert pieces.count() > 0 and {"doc_id", "start", "length", "sequence_id", "offset"} <= set(pieces.columns)


def test_empty_and_edge_rows_pass_every_stage(spark, edge, empty):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0, name
        if name not in ("toxicity", "quality_rules"):
            assert stage(spark, edge, SF).count() > 0, name


def test_operators_used_are_the_dealt_ones():
    assert corpus_pipeline.op2_minhash is op2_minhash and corpus_pipeline.op5_suffix is op5_suffix
