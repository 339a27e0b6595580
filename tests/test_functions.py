"""Column functions on hand-made rows (the traps of the reference's semantics)."""

import datetime as dt
import hashlib
import hmac

import pytest
from pyspark.sql import functions as F

from martcraft.functions import actions as A
from martcraft.functions import classify as C
from martcraft.functions import numeric as N
from martcraft.functions import privacy as P
from martcraft.functions.dates import normalise_date


def one(spark, expr, rows, schema="x string"):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_safe_double_rejects_java_suffix(spark):
    got = one(spark, N.safe_double("x"), [("1.5",), ("1d",), ("",), (None,), ("abc",), (" 2 ",), ("1e3",)])
    assert got == [1.5, None, None, None, None, 2.0, 1000.0]


def test_strict_double_fails_on_bad_text(spark):
    assert one(spark, N.strict_double("x"), [("3",), (None,)]) == [3.0, None]
    with pytest.raises(Exception):
        one(spark, N.strict_double("x"), [("x1",)])


def test_clean_money(spark):
    rows = [("1,234",), ("₩5,000",), ("12%",), ("",), ("1d",), ("3.9",)]
    assert one(spark, N.clean_money("x"), rows) == [1234.0, 5000.0, 12.0, None, None, 3.9]


def test_first_nonempty_no_fall_through(spark):
    df = spark.createDataFrame([("", "5"), ("bad", "5"), (None, None)], "a string, b string")
    got = [r[0] for r in df.select(N.safe_double(N.first_nonempty("a", "b"))).collect()]
    assert got == [5.0, None, None]


def test_js_round_vs_sql_round(spark):
    got = spark.createDataFrame([(-2.5,), (2.5,)], "x double").select(
        N.js_round("x"), F.round("x")).collect()
    assert [tuple(r) for r in got] == [(-2, -3.0), (3, 3.0)]


def test_normalise_date(spark):
    rows = [("20240702",), ("2024.07.02",), ("2024-07-02",), ("2024-07-02T10:00:00",), ("(not set)",)]
    d = dt.date(2024, 7, 2)
    assert one(spark, normalise_date("x"), rows) == [d, d, d, d, None]


def test_hmac_matches_python(spark):
    for key in ["secret", "k" * 100]:
        got = one(spark, P.hmac_sha256_hex("x", key), [("01012345678",)])[0]
        assert got == hmac.new(key.encode(), b"01012345678", hashlib.sha256).hexdigest()


def test_phone_hash_fallback_and_digits(spark):
    df = spark.createDataFrame([("", "02-123", None, None), (None, None, "010 9", None), ("", "", "", "")],
                               "a string, b string, c string, d string")
    got = [r[0] for r in df.select(P.phone_hash("a", "b", "c", "d", "s")).collect()]
    assert got[0] == hmac.new(b"s", b"02123", hashlib.sha256).hexdigest()
    assert got[1] == hmac.new(b"s", b"0109", hashlib.sha256).hexdigest()
    assert got[2] is None


def test_strip_personal(spark):
    j = '{"order_id":"1","buyer":{"cellphone":"010"},"receivers":[{"phone":"1"}],"amt":2.50}'
    out = one(spark, P.strip_personal("x"), [(j,)])[0]
    assert "buyer" not in out and "receivers" not in out and '"order_id":"1"' in out


ACTS = ('[{"action_type":"purchase","value":"1"},{"action_type":"omni_purchase","value":"7"},'
        '{"action_type":"purchase","value":"3","1d_ev":"2"}]')


def test_action_pick_priority_last_duplicate_wins(spark):
    df = spark.createDataFrame([(ACTS,), ("[]",), (None,), ('[{"action_type":"lead","value":"x"}]',)], "a string")
    arr = A.parse_actions("a")
    got = df.select(A.action_value(arr, A.PURCHASE_TYPES, strict=False),
                    A.action_pick(arr, A.PURCHASE_TYPES)["1d_ev"]).collect()
    assert [tuple(r) for r in got] == [(3.0, "2"), (None, None), (None, None), (None, None)]


def test_sum_types_adds_all_purchase_entries(spark):
    df = spark.createDataFrame([(ACTS,), (None,)], "a string")
    assert [r[0] for r in df.select(A.sum_types(A.parse_actions("a"))).collect()] == [11.0, 0.0]


def test_classifications(spark):
    df = spark.createDataFrame([("T", "F"), ("T", "M"), (None, "T"), ("F", "F"), (None, None)], "p string, c string")
    got = [r[0] for r in df.select(C.order_status_label("p", "c")).collect()]
    assert got == [C.STATUS_PAID, C.STATUS_PARTIAL, C.STATUS_CANCELLED, C.STATUS_UNPAID, C.STATUS_OTHER]
    names = [("x_파워링크",), ("신규_SA_몰",), ("abc",), (None,), ("x스토어",)]
    assert one(spark, C.keyword_ad_type("x"), names) == [C.AD_POWERLINK, C.AD_SHOPPING, C.AD_OTHER,
                                                         C.AD_OTHER, C.AD_SHOPPING]
    assert one(spark, C.creative_class("x"), [("Image_Banner",), ("MESSAGE",), (None,)]) == \
        ["DISPLAY", "MESSAGE", "OTHER"]
    assert one(spark, C.landing_type(F.lit("SA"), F.col("x")), [("brand_ssa",), ("main",)]) == \
        [C.LANDING_SMARTSTORE, C.LANDING_OWN_MALL]


def test_consent(spark):
    df = spark.createDataFrame([("y", "F"), ("F", "true"), ("", "")], "s string, m string")
    assert [r[0] for r in df.select(C.consented("s", "m")).collect()] == [True, True, False]
    assert [r[0] for r in df.select(C.consented("s", "m", "sms")).collect()] == [True, False, False]


def test_size_ml(spark):
    rows = [("Drink 500ml",), ("Big 1.5L",), ("2 리터 pack",), ("none",)]
    assert one(spark, C.size_ml("x"), rows) == [500, 1500, 2000, None]


GOLDEN = [(6, False, "", 2563), (6, False, "1.5L", 2843), (15, False, "", 3233), (24, False, "", 3562),
          (24, True, "", 4047), (7, False, "", 5126), (18, False, "", 5800), (30, False, "", 6125),
          (36, False, "", 6799), (0, False, "", 0)]


def test_ship_rate_golden_vectors(spark):
    df = spark.createDataFrame([g[:3] for g in GOLDEN], "cans long, mixed boolean, pn string")
    got = [r[0] for r in df.select(C.ship_rate("cans", "mixed", "pn")).collect()]
    assert got == [g[3] for g in GOLDEN]


def test_strip_personal_text_keeps_every_other_character(spark):
    cases = {
        '{"a":2.50,"buyer":{"x":[1,{"buyer":2}]},"b":1e3}': '{"a":2.50,"b":1e3}',
        '{ "buyer" : 1 , "receivers":[{}] }': "{  }",
        '{"a":"x,} \\u00e9","receivers":"q\\"}","buyer":null , "c" : {"buyer":3}}': '{"a":"x,} \\u00e9","c" : {"buyer":3}}',
        '{"buyer":1,"a": 2.0,"buyer":3}': '{"a": 2.0}', '{"a":1}': '{"a":1}', "{}": "{}",
        "[1]": None, '{"a":1': None, '{"a":1} x': None, '{"a":1,}': None, "": None, None: None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "x string")
    got = {r.x: r.y for r in df.select("x", P.strip_personal_text("x").alias("y")).collect()}
    assert got == cases
