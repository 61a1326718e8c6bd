import hashlib

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hearthlake import functions as H


def one(spark, value, kind, fn):
    return spark.createDataFrame([(value,)], f"v {kind}").select(fn(F.col("v")).alias("r")).first().r


@pytest.mark.parametrize(
    "text, want",
    [
        ("CASA-nova/vista (centro)", "Casa-Nova/Vista (Centro)"),
        ("o'neil élan", "O'neil Élan"),
        ("a_b.c:d;e", "A_B.C:D;E"),
        ("  two  spaces ", "  Two  Spaces "),
        ("", ""),
        (None, None),
        ("unknown", "Unknown"),
    ],
)
def test_initcap_words(spark, text, want):
    assert one(spark, text, "string", H.initcap_words) == want


DELIMITERS = set(" \t\n[](){}/|\\<>!?@\"^#$&~_,.:;*%+-")


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="aBc é-/.'(", max_size=12), min_size=1, max_size=30))
def test_initcap_words_against_brute_force(spark, texts):
    def brute(text):
        low, out = text.lower(), []
        for i, c in enumerate(low):
            out.append(c.upper() if i == 0 or low[i - 1] in DELIMITERS else c)
        return "".join(out)

    df = spark.createDataFrame([(t,) for t in texts], "v string").select("v", H.initcap_words(F.col("v")).alias("r"))
    assert all(r.r == brute(r.v) for r in df.collect())


def test_regexp_without_match_is_null(spark):
    get = lambda text, pattern: one(spark, text, "string", lambda c: H.regexp_extract_or_null(c, pattern))
    assert get("BRL/month", "^([A-Za-z]+)") == "BRL"
    assert get("BRL/month", "/([A-Za-z]+)$") == "month"
    assert get("123", "^([A-Za-z]+)") is None
    assert get(None, "^([A-Za-z]+)") is None


@pytest.mark.parametrize("number, want", [(2.5, 3), (-2.5, -3), (2.4, 2), (2.7, 3), (None, None), (0.49999999999999994, 0)])
def test_round_to_long(spark, number, want):
    assert one(spark, number, "double", H.round_to_long) == want


def test_surrogate_key(spark):
    df = spark.createDataFrame([("a", None, 3, ["x/y", "é"])], "a string, b string, c int, d array<string>")
    row = df.select(
        H.surrogate_key("a", "b", "c").alias("plain"),
        H.surrogate_key("b").alias("null"),
        H.surrogate_key(arrays=("d",)).alias("array"),
    ).first()
    md5 = lambda text: hashlib.md5(text.encode()).hexdigest()
    assert row.plain == md5("a||||3")
    assert row.null == md5("")
    assert row.array == md5('["x/y","é"]')


def test_key_separator_is_not_escaped(spark):
    df = spark.createDataFrame([("a||b", "c"), ("a", "b||c")], "x string, y string")
    assert df.select(H.surrogate_key("x", "y")).distinct().count() == 1


def test_site_rank(spark):
    df = spark.createDataFrame([("vivareal",), ("zapimoveis",), ("x",), (None,)], "s string")
    assert [r[0] for r in df.select(H.site_rank(F.col("s"))).collect()] == [1, 2, 3, 3]


def test_parse_stem(spark):
    get = lambda t: one(spark, t, "string", lambda c: H.parse_stem_ts(c).cast("string"))
    assert get("2026-01-05T12:34:56Z") == "2026-01-05 12:34:56"
    assert get("latest") is None


@pytest.mark.parametrize(
    "text, valid",
    [
        ('{"a": 1}', True),
        ("[1, 2]", True),
        ('{"a": 1, "a": 2}', True),
        ('{"a": 1} x', False),
        ('{"a": 1}{"b": 2}', False),
        ('{"a": 1}, {"b": 2}', False),
        ("{'a': 1}", False),
        ("   ", False),
        ('{"a": "x\ny"}', False),
    ],
)
def test_parse_json_strict(spark, text, valid):
    row = spark.createDataFrame([([text],)], "t array<string>").select(
        F.get(H.parse_json_strict(F.col("t")), F.lit(0)).isNotNull().alias("ok")
    )
    assert row.first().ok is valid


def test_member_reads_numbers_leniently(spark):
    raw = '{"i": 2.0, "d": "2000", "s": 5, "n": null, "o": {}, "f": {"x": 1}, "b": true}'
    v = spark.createDataFrame([(raw,)], "t string").select(F.parse_json("t").alias("v"))
    row = v.select(
        H.member(F.col("v"), "$.i", "bigint").alias("i"),
        H.member(F.col("v"), "$.d", "double").alias("d"),
        H.member(F.col("v"), "$.s", "string").alias("s"),
        H.member(F.col("v"), "$.n", "string").alias("n"),
        H.member(F.col("v"), "$.b", "string").alias("b"),
        H.non_empty_object(F.col("v"), "$.o").alias("o"),
        H.non_empty_object(F.col("v"), "$.f").alias("f"),
        H.non_empty_object(F.col("v"), "$.n").alias("null_object"),
        H.non_empty_object(F.col("v"), "$.zz").alias("absent"),
    ).first()
    assert (row.i, row.d, row.s, row.n, row.b) == (2, 2000.0, "5", None, "true")
    assert (row.o, row.f, row.null_object, row.absent) == (False, True, False, False)
