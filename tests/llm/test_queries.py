"""The registered queries: contract columns over the smallest tables, SQL where there is any."""

import pytest
from conftest import SMALL

import __spark_entry__ as E
from martcraft.llm.queries import ORACLES, QUERIES

COLUMNS = {
    "op1_html": ["page_id", "url", "text", "n_chars"],
    "op2_minhash": ["doc_id", "n_shingles", "component_id", "kept"],
    "op3_packing": ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
    "op4_sentencepiece": ["doc_id", "n_tokens", "ids_crc32", "round_trip"],
    "op5_suffix": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    "op6_urls": ["page_id", "host", "path", "rule", "verdict"],
    "op7_quality": ["doc_id", "held_out", "score", "predicted"],
    "op8_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op9_imatch": ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    "op10_lines": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    "op11_linededup": ["doc_id", "n_lines", "n_dropped", "kept_sha256"],
    "op12_search": ["item_id", "rank", "doc_id", "score"],
    "op13_merkle": ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
}


def test_all_operators_and_the_pipeline_are_registered():
    assert set(COLUMNS) == set(QUERIES) and {*COLUMNS, "pipeline"} <= set(E.queries())


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_contract_columns_and_rows(spark, name):
    df = E.queries()[name](spark, SMALL)
    assert set(COLUMNS[name]) <= set(df.columns)
    rows = df.count()
    table = "pages" if name in ("op1_html", "op6_urls") else "documents"
    whole = spark.read.parquet(f"{SMALL}/{table}.parquet").count()
    if name == "op12_search":
        items = spark.read.parquet(f"{SMALL}/benchmark.parquet").count()
        assert rows == 10 * items
    else:
        assert rows >= whole if name == "op3_packing" else rows == whole


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql_gives_the_same_rows(spark, duck, name):
    df = E.queries()[name](spark, SMALL)
    cur = duck.execute(ORACLES[name])
    cols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(df.columns)
    assert sorted(map(tuple, df.select(*cols).collect()), key=str) == sorted(cur.fetchall(), key=str)
