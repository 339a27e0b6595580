"""Option-text grammar of the cost model on hand-written options."""

from pyspark.sql import functions as F

from martcraft.plans import cost as CO


def _groups(spark, names):
    rows = [(i, 1.0, False, g, None, "") for i, g in enumerate(names)]
    return CO.product_groups(spark.createDataFrame(
        rows, "row_no long, price double, pet boolean, grp string, ml long, flav string"), CO.CostConfig())


def _pieces(spark, pn, on, groups):
    df = spark.createDataFrame([("k", pn, on)], "pkey_base string, pn string, on string")
    return [(r.fl, r.cnt) for r in CO.pieces(df, _groups(spark, groups)).orderBy("pos").collect()]


def test_labels_prices_and_plus_pieces(spark):
    got = _pieces(spark, "콜라 500ml", "[특가] 사과 6개입 + 포도 6개입 (개당 1,200원)", ["콜라"])
    assert got == [("사과", 6), ("포도", 6)]


def test_flavour_choice_breaks_pieces_and_defaults_count(spark):
    got = _pieces(spark, "콜라", "맛 선택 ①: 레몬 / 맛 선택 ②: 라임 (12개입)", ["콜라"])
    assert got == [("레몬", 1), ("라임", 12)]


def test_single_piece_takes_pack_size_from_product_name(spark):
    assert _pieces(spark, "콜라 24개입", "레몬", ["콜라"]) == [("레몬", 24)]


def test_unit_words_follow_ascii_word_boundaries(spark):
    # '종' is not an ASCII word character, so '6종' before a space is not a unit
    assert _pieces(spark, "콜라", "6종 세트", ["콜라"]) == [("종", 6)]
    # 'ml' at an ASCII word end is a unit and is removed
    assert _pieces(spark, "콜라", "레몬 500ml", ["콜라"]) == [("레몬", 500)]


def test_group_names_removed_from_flavours(spark):
    assert _pieces(spark, "제로콜라", "콜라 레몬 6", ["콜라"]) == [("레몬", 6)]


def test_groups_leave_in_list_order_even_when_a_cut_reveals_one(spark):
    groups = _groups(spark, ["ab", "xy", "b"])
    texts = spark.createDataFrame([("xaby",), ("xxyy",), ("babb",), ("q",)], "raw string")
    got = {r.raw: r.fl for r in CO.without_groups(texts, groups).collect()}
    want = {}
    for t in got:
        f = t
        for g in ("ab", "xy", "b"):
            f = f.replace(g, "")
        want[t] = f
    assert got == want


def test_more_than_5000_groups_longest_first(spark):
    names = [f"g{i}x" for i in range(6000)] + ["g12", "g1234xyz"]
    df = spark.createDataFrame([("a g1234 xyz b",), ("g12x",), ("none",)], "pn string")
    got = {r.pn: r.grp for r in CO.group_of(df, _groups(spark, names)).collect()}
    assert got == {"a g1234 xyz b": "g1234xyz", "g12x": "g12x"}


def test_tokens_and_performance_line(spark):
    cfg = CO.CostConfig(collab_tokens=("사과", "배"), perf_marker="파워", perf_line="P", perf_products=("퍼폼",),
                        perf_aliases={"파워배": "배"}, collab_order_500=("A", "E"), collab_line_250="E")
    df = spark.createDataFrame([("구성=사과48+배 (24개) / 파워 배6",)], "on string")
    toks = df.select(CO.tokens(F.col("on"), cfg).alias("t")).first()["t"]
    assert [(t["fl"], t["cnt"]) for t in toks] == [("사과", 48), ("배", 24), ("파워배", 6)]
    collab = spark.createDataFrame([("P", "배", 250, 7.0), ("A", "사과", 500, 1.0), ("E", "사과", 500, 2.0),
                                    ("E", "배", 500, 3.0), ("E", "배", 250, 4.0), ("P", "사과", 500, 9.0), ("P", "사과", 250, 8.0)],
                                   "line string, flav string, size long, price double")
    rows = spark.createDataFrame([(1, "x", "x", "사과"), (2, "x", "x", "배"), (3, "x", "x 250ml", "배"), (4, "x", "x", "파워배"),
                                  (5, "퍼폼 x", "x", "사과"), (6, "x", "x", "없음")], "k int, pn string, ctx string, fl string")
    got = {r.k: r.unit_cost for r in CO.collab_costs(rows, collab, cfg).collect()}
    assert got == {1: 1.0, 2: 3.0, 3: 4.0, 4: 7.0, 5: 9.0, 6: 0.0}


def test_collab_name_without_a_comma_has_no_flavour(spark):
    sheet = spark.createDataFrame([(1, "energy 500ml", 10.0)], "row_no long, name string, price double")
    got = CO.parse_collab_prices(sheet, CO.CostConfig(collab_markers=("energy",))).collect()
    assert [(r.flav, r["size"]) for r in got] == [("", 500)]
