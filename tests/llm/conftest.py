import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# columns whose names the operators use inside
CLASH = "doc_id long, text string, id long, key long, doc long, h long, n long, spans string, part int, rep int, y int, score double"
PASSAGE = " ".join(f"shared{i} passage{i}" for i in range(40))


def edge_rows():
    near = [f"word{i}" for i in range(200)]
    other = near[:-2] + ["changed", "tail"]
    return [
        (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "echo " * 30_000), (6, "Twin text. Über all.\nTwin text."),
        (7, "Twin text. Über all.\nTwin text."), (7, "Twin text. Über all.\nTwin text."), (8, " ".join(near)),
        (9, " ".join(other)), (10, "before " + PASSAGE + " after"), (11, "start " + PASSAGE + " end"),
        (12, "日本語 ▁ x́ 🙂🙂 ÀÉ\x1cq 'don't #1 <|x|>"), (None, "no id here"), (13, "y" * 40_000),
    ]


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in edge_rows()], DOCS).coalesce(3)


@pytest.fixture(scope="session")
def clash(spark):
    return spark.createDataFrame([(i, t, 1, 2, 3, 4, 5, "x", 6, 7, 0, 0.5) for i, t in edge_rows()], CLASH).coalesce(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(i, 1 if i % 2 else 0, 0) for i in range(1, 14)] + [(None, 1, 1), (3, None, None)],
                                 "doc_id long, quality int, toxic int")
