from datetime import date

import pytest
from pyspark.sql import functions as F

from rollkeeper.functions import codes, compare, dates, text


def values(spark, inputs, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], "i int, c string")
    return [r[1] for r in df.select("i", expression(F.col("c"))).orderBy("i").collect()]


@pytest.mark.parametrize(
    "given, wanted",
    [
        ("(262) 555-0100", "262-555-0100"),
        ("262-555-0100", "262-555-0100"),
        ("2625550100", "262-555-0100"),
        ("123", "123--"),
        ("26255501009", "262-555-0100"),
        ("", ""),
        (None, ""),
        (" ", "--"),
    ],
)
def test_phone(spark, given, wanted):
    assert values(spark, [given], text.phone) == [wanted]


def test_phone_twice_is_once(spark):
    given = ["(262) 555-0100", "123", "", "--"]
    once = values(spark, given, text.phone)
    assert values(spark, once, text.phone) == once


def test_feed_date(spark):
    given = ["", "1/2/2020", "01/02/2020", "02/29/2000", "02/30/2020", "13/01/2020", "01/02/20"]
    given += ["2020-01-02", " 01/02/2020", "001/2/2020"]
    wanted = [None, date(2020, 1, 2), date(2020, 1, 2), date(2000, 2, 29)] + [None] * 6
    assert values(spark, given, dates.feed_date) == wanted
    bad = [False] * 4 + [True] * 6
    assert values(spark, given, dates.bad_feed_date) == bad


def test_date_text(spark):
    assert values(spark, ["1/2/2020", ""], dates.normal_us_text) == ["01/02/2020", None]
    assert values(spark, ["1/2/2020", ""], lambda c: dates.us_text(dates.feed_date(c))) == ["01/02/2020", ""]
    assert values(spark, ["1/2/2020", ""], lambda c: dates.iso_text(dates.feed_date(c))) == ["2020-01-02", ""]


def test_zero_pad(spark):
    given = ["", "7", "007", "1234", "-5", "+5", "-512"]
    assert values(spark, given, lambda c: text.zero_pad(c, 3)) == [g.zfill(3) for g in given]


def test_cut_counts_characters(spark):
    assert values(spark, ["abc", "abcd", "éàüö", ""], lambda c: text.cut(c, 3)) == ["abc", "abc", "éàü", ""]


def test_code_maps(spark):
    assert values(spark, ["1", "9", "3", "", None], codes.race_code) == ["WH", "MU", "", "", ""]
    given = ["Not Hispanic or Latino", "Hispanic or Latino", "other", None]
    assert values(spark, given, codes.hispanic_flag) == ["N", "Y", "", ""]
    assert values(spark, ["11", "5", "12", None], codes.building) == ["MADR", "JAC", None, None]
    assert values(spark, ["Asian (United States of America)", "Asian"], codes.race_text_code) == ["AS", ""]


def test_flags(spark):
    assert values(spark, ["Yes", "No", "", None], codes.primary_rank) == [1, 2, None, None]
    assert values(spark, ["T", "TE", "X", None], codes.is_tenured) == ["Y", "N", "N", "N"]
    assert values(spark, ["T", "TE", "X", None], codes.is_tenure_track) == ["N", "Y", "N", "N"]


def test_position_key(spark):
    df = spark.createDataFrame([("DPR", "00123", "4567", "T-1")], "p string, u string, d string, t string")
    made = text.position_key(*[F.col(c) for c in "pudt"])
    assert df.select(made).first()[0] == "DPR-0012-456-T-1"
    given = ["DPR-0012-456-T-1", "a-b-c", "", "a-b-c-d-e-f"]
    parts = values(spark, given, text.split_position_key)
    assert tuple(parts[0]) == ("DPR", "0012", "456", "T-1")
    assert parts[1] is None and parts[2] is None
    assert tuple(parts[3]) == ("a", "b", "c", "d-e-f")


def test_small_text(spark):
    assert values(spark, ["ABC1234567XX", "AB"], text.supervisor_number) == ["1234567", ""]
    assert values(spark, ["Dr.", "mr"], text.title_key) == ["DR", "MR"]
    assert values(spark, ["", "x"], text.blank_to_null) == [None, "x"]
    assert values(spark, ["LH", None], lambda c: text.location(c, F.lit("444"))) == ["LH 444", "444"]


@pytest.mark.parametrize(
    "born, day, age",
    [
        ("2000-05-10", "2024-05-10", 24),
        ("2000-05-10", "2024-05-09", 23),
        ("2000-05-10", "2024-05-11", 24),
        ("2000-02-29", "2023-02-28", 22),
        ("2000-02-29", "2023-03-01", 23),
    ],
)
def test_age(spark, born, day, age):
    df = spark.createDataFrame([(born, day)], "b string, d string")
    assert df.select(dates.age_years(F.col("b").cast("date"), F.col("d").cast("date"))).first()[0] == age


def test_null_rules(spark):
    df = spark.createDataFrame([(None, "")], "a string, b string")
    a, b = F.col("a"), F.col("b")
    row = df.select(
        compare.same_or_both_blank(a, b),
        compare.stored_equals(a, b),
        compare.stored_equals(a, F.lit(None).cast("string"), is_date=True),
        compare.differs(a, b),
    ).first()
    assert tuple(row) == (True, None, True, True)


def test_number_key(spark):
    assert values(spark, ["007", "7", "A7", None], compare.number_key) == ["7", "7", "A7", None]


def test_fingerprint_keeps_rows_apart(spark):
    rows = [("a", "b,"), ("a,", "b"), ("a", None), (None, "a"), ("", "a"), ("-", "a"), ("a", "b,")]
    df = spark.createDataFrame(rows, "a string, b string")
    assert df.select(compare.fingerprint(F.col("a"), F.col("b"))).distinct().count() == 6


def test_joined_key_tells_rows_apart(spark):
    mark = compare.BETWEEN
    texts = [("a", "b"), ("ab", ""), ("", "ab"), (f"a{mark}", "b"), ("a", f"{mark}b"), (mark, ""), ("", mark), ("", ""), (f"{mark}2,0{mark}", "")]
    df = spark.createDataFrame([*texts, *texts, (None, "b")], "a string, b string")
    found = df.select("a", compare.joined_key([F.col("a"), F.col("b")]).alias("k"))
    assert found.filter("k is not null").distinct().count() == len(texts)
    assert found.filter("k is null").count() == 1
