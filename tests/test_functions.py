"""Scalar helpers: trimming, cleaning, tokenising, banding, parsing, rounding."""

from __future__ import annotations

import pytest
from quarry_test_helpers import rows
from pyspark.sql import functions as F

from quarry.functions import scalar as S


def one_col(spark, values, typ="string"):
    return spark.createDataFrame([(v,) for v in values], f"x {typ}")


def test_java_trim_strips_control_characters(spark):
    df = one_col(spark, ["\t a b \n", "\x01x\x00", None, "   "])
    got = [r[0] for r in df.select(S.java_trim("x")).collect()]
    assert got == ["a b", "x", None, ""]


def test_normalize_label(spark):
    df = one_col(spark, [" Positive ", "NEGATIVE\t", "positive"])
    assert [r[0] for r in df.select(S.normalize_label("x")).collect()] == ["positive", "negative", "positive"]


def test_fused_tokenizer_equals_three_passes(spark):
    texts = [
        "Hello, World! It's 10% off -- e-mail me@x.org (now)*",
        "tab\tinside\nnewline \"quoted\" a/b&c:d~e<f>g=h+i?j^k",
        "",
        "   ",
        None,
        "ÉCOLE Été über",
    ]
    df = one_col(spark, texts)
    cleaned = F.regexp_replace(F.lower("x"), S.REVIEW_PUNCT_CLASS, " ")
    cleaned = F.regexp_replace(cleaned, S.REVIEW_DIGIT_CLASS, " ")
    staged = df.select(F.explode(F.split(cleaned, S.TOKEN_SEPARATORS)).alias("w")).filter(F.col("w") != "")
    fused = df.select(F.explode(S.review_tokens("x")).alias("w")).filter(F.col("w") != "")
    assert rows(staged) == rows(fused)
    assert ("tab\tinside\nnewline",) in rows(fused)  # newline and tab are not separators


@pytest.mark.parametrize(
    "closed,expected",
    [
        ("right", ["0-18", "0-18", "18-35", "18-35", "35-50", "35-50", "50+", None]),
        ("left", ["0 - 18", "18 - 35", "18 - 35", "35 -50", "35 -50", "50+", "50+", None]),
    ],
)
def test_age_band_boundaries(spark, closed, expected):
    df = one_col(spark, [17, 18, 19, 35, 36, 50, 51, None], "int")
    assert [r[0] for r in df.select(S.age_band("x", closed)).collect()] == expected


def test_parse_int_modes(spark):
    df = one_col(spark, ["4", " 5 ", "4.6", "n/a", "", None])
    assert [r[0] for r in df.select(S.parse_int("x")).collect()] == [4, 5, None, None, None, None]
    with pytest.raises(Exception):
        df.select(S.parse_int("x", on_bad="fail")).collect()


def test_parse_double_plain_only(spark):
    df = one_col(spark, ["4.5", "1e3", "NaN", "4d", " 3 ", ".5", "abc"])
    assert [r[0] for r in df.select(S.parse_double("x")).collect()] == [4.5, None, None, None, 3.0, 0.5, None]


def test_round_half_up_on_shortest_decimal(spark):
    df = one_col(spark, [2.675, 3.125, 0.575, 23 / 40, 1.005], "double")
    assert [r[0] for r in df.select(S.round_half_up("x", 2)).collect()] == [2.68, 3.13, 0.58, 0.58, 1.01]
    # `%.2f` agrees with the rounding
    assert [r[0] for r in df.select(S.fmt2("x")).collect()] == ["2.68", "3.13", "0.58", "0.58", "1.01"]


def test_epoch_year_is_utc_and_zone_free(spark):
    df = one_col(spark, [0, 1577836799, 1577836800, -1], "bigint")
    prev = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        got = [r[0] for r in df.select(S.epoch_utc_year("x")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)
    assert got == [1970, 2019, 2020, 1969]


def test_to_epoch_seconds_roundtrip(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2020-01-01 00:00:10' AS t UNION ALL SELECT TIMESTAMP_NTZ'1969-12-31 23:59:59'")
    got = sorted(r[0] for r in df.select(S.to_epoch_seconds("t")).collect())
    assert got == [-1, 1577836810]


def test_year_range_matches_year(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (TIMESTAMP_NTZ'1997-12-31 23:59:59'), (TIMESTAMP_NTZ'1998-01-01 00:00:00'), "
        "(TIMESTAMP_NTZ'1998-12-31 23:59:59'), (TIMESTAMP_NTZ'1999-01-01 00:00:00') AS t(ts)"
    )
    assert df.filter(S.year_range("ts", 1998)).count() == 2


def test_split_list_trim(spark):
    df = one_col(spark, ["Action| Sci-Fi |Drama", "", None])
    assert [r[0] for r in df.select(S.split_list("x")).collect()] == [["Action", "Sci-Fi", "Drama"], [""], None]
    assert df.select(S.split_list("x", trim=False)).first()[0] == ["Action", " Sci-Fi ", "Drama"]


def test_split_list_trailing_empty(spark):
    df = one_col(spark, ["A|B|", "A||B||", "||", "", None, "|A"])
    kept = [r[0] for r in df.select(S.split_list("x")).collect()]
    assert kept == [["A", "B", ""], ["A", "", "B", "", ""], ["", "", ""], [""], None, ["", "A"]]
    cut = [r[0] for r in df.select(S.split_list("x", trailing_empty=False)).collect()]
    assert cut == [["A", "B"], ["A", "", "B"], [], [""], None, ["", "A"]]


def test_bag_to_string(spark):
    df = spark.sql("SELECT array(named_struct('w', 'a', 'n', 2), named_struct('w', 'b', 'n', 1)) AS bag")
    assert df.select(S.bag_to_string("bag", ["w", "n"])).first()[0] == "{(a,2),(b,1)}"
    empty = spark.sql("SELECT CAST(NULL AS ARRAY<STRUCT<w: STRING, n: INT>>) AS bag")
    assert empty.select(S.bag_to_string("bag", ["w", "n"])).first()[0] == "{}"


def test_pad_right_never_truncates(spark):
    df = one_col(spark, ["ab", "abcdef"])
    assert [r[0] for r in df.select(S.pad_right("x", 4)).collect()] == ["ab  ", "abcdef"]


def test_days_between(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2020-01-03 01:00:00' AS a, TIMESTAMP_NTZ'2020-01-01 23:00:00' AS b")
    assert df.select(S.days_between("a", "b"), S.days_between("b", "a")).first() == (2, -2)


def test_parse_double_fail_mode(spark):
    ok = one_col(spark, ["1.5", None, " 2 "])
    assert [r[0] for r in ok.select(S.parse_double("x", on_bad="fail")).collect()] == [1.5, None, 2.0]
    with pytest.raises(Exception):
        one_col(spark, ["1e3"]).select(S.parse_double("x", on_bad="fail")).collect()
