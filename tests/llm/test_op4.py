import numpy as np
import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from martcraft.llm import op4_sentencepiece as o

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIB = sentencepiece.SentencePieceProcessor(model_file=PATH)


def ids(b):
    return np.frombuffer(b, "<u4").tolist()


def test_sample_table_equals_the_library(spark):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    assert [ids(b) for b in o.model(PATH).encode(texts)] == LIB.encode(texts)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from("abcetinor  \n\t▁éß日🙂\x00<>0x1"), max_size=40))
def test_any_text_equals_the_library_and_comes_back(text):
    m = o.model(PATH)
    got = m.encode([text])[0]
    assert ids(got) == LIB.encode(text)
    assert m.decode(got) == text.replace("▁", " ")


def test_edges(edge, clash, empty):
    for df in (edge, clash):
        for r in o.encode_digest(df, PATH).collect():
            assert (r.round_trip is None) == (r.doc_id == 1) and r.round_trip is not False
        both = o.decode(o.encode(df, PATH), PATH).collect()
        for r in both:
            if r.text is None:
                assert r.ids is None and r.decoded is None
            else:
                assert r.ids == LIB.encode(r.text) and r.decoded == r.text.replace("▁", " ")
    assert o.encode(empty, PATH).count() == 0 and o.encode_digest(empty, PATH).count() == 0
